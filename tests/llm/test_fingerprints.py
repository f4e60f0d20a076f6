import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from beaconry.llm import fingerprints as fp
from tests.llm.helpers import ODD, documents, prose

TEXT = st.text(st.sampled_from("ab"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT, st.integers(0, 40), st.integers(0, 40))
def test_common_extension(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    x, y = fp.Prefixes(fp.codes(a)), fp.Prefixes(fp.codes(b))
    assert fp.common_extension(x, i, y, j) == n
    for k in range(min(len(a) - i, len(b) - j) + 1):
        assert fp.equal(x, i, y, j, k) == (a[i:i + k] == b[j:j + k])


def test_span_hashes_are_places_independent():
    text = prose(3, 200)
    spans = fp.Prefixes(fp.codes(text)).spans(5)
    by = {}
    for i, h in enumerate(spans):
        assert by.setdefault(text[i:i + 5], h) == h
    assert len(set(by.values())) == len(by)


def test_long_text_grows_powers():
    text = "ab" * 30_000
    a = fp.Prefixes(fp.codes(text + "x"))
    assert fp.common_extension(a, 0, a, 2) == 59_998


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        out.append((doc, len(text), hashlib.sha256((text[:len(text) - third] + nxt[:third]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark):
    rows = ODD + [(100 + i, prose(i, 120)) for i in range(50)] + [(300, prose(1, 120))]
    got = fp.fingerprint_documents(documents(spark, rows).withColumnRenamed("lang", "range").repartition(5)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == expected(rows)
    prints = {}
    for r in got:
        prints.setdefault(r["fingerprint"], []).append(r["doc_id"])
    assert sorted(prints[next(p for p in prints if 300 in prints[p])]) == [101, 300]
    long = [r for r in got if r["n_chars"] > 300 and r["doc_id"] != 9]
    assert np.mean([r["near_edited"] for r in long]) > 0.4 and max(r["near_next"] for r in long) < 0.2
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_one_and_none(spark):
    assert fp.fingerprint_documents(documents(spark, [])).count() == 0
    only = fp.fingerprint_documents(documents(spark, [(7, "abcdef")])).first()
    assert only["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and only["near_next"] == 1.0
