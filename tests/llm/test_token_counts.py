import numpy as np

from beaconry.llm import packing, token_counts
from tests.llm.helpers import ODD, documents, prose

ENCODING = packing.tokenizer_path("byte_bpe_50k.tiktoken")


def brute(text, rule):
    encoder = token_counts.load_encoding(ENCODING)
    raw = (text or "").encode()
    owner_of, line = [], 0
    for b in raw:
        owner_of.append(line)
        line += b == 10
    n = (owner_of[-1] + 1) if owner_of else 1
    tokens, crossing, at = [0] * n, [0] * n, 0
    for i in encoder.encode_ordinary(text or ""):
        own = owner_of[at:at + len(encoder.decode_single_token_bytes(i))]
        at += len(own)
        touched = sorted(set(own))
        choice = {"first": own[0], "last": own[-1], "largest": max(touched, key=lambda s: (own.count(s), -s))}[rule]
        tokens[choice] += 1
        if len(touched) > 1:
            for s in touched:
                crossing[s] += 1
    return list(zip(tokens, crossing))


def test_rules(spark):
    rows = [r for r in ODD if r[0] is not None][:9] + [(20, "a\n\n\n b\n"), (21, "\n\n\n\n"), (22, "x\r\n  \n\n  y" * 20), (23, prose(1, 50) + "\n\n\n" + prose(2, 30))]
    for rule in token_counts.RULES:
        got = {}
        for r in token_counts.count_sections(documents(spark, rows).withColumnRenamed("lang", "section"), ENCODING, rule).collect():
            got.setdefault(r["doc_id"], {})[r["section"]] = (r["n_tokens"], r["n_crossing"])
        for doc, text in rows:
            assert [got[doc][i] for i in range(len(got[doc]))] == brute(text, rule), (doc, rule)
    assert any(c for _, c in brute("a\n\n\n b\n", "first"))


def test_characters(spark):
    got = token_counts.count_sections(documents(spark, [(1, "é漢\nab\n😀")]), ENCODING).orderBy("section").collect()
    assert [(r["start_char"], r["n_chars"]) for r in got] == [(0, 3), (3, 3), (6, 1)]


def test_empty(spark):
    assert token_counts.count_sections(documents(spark, []), ENCODING).count() == 0
    assert np.array_equal(token_counts.line_bounds(b""), [0, 0])
