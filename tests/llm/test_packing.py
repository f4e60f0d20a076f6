import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from beaconry.llm import packing
from tests.llm.helpers import ODD, documents, prose

TOKENIZER = packing.tokenizer_path()


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_sweep_is_best_fit(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan, filled = packing.sweep(counts, 40), {}
    for length, n in counts.items():
        runs = [r for r in plan if r[0] == length]
        for rank in range(n):
            _, first, sequence, each, offset = [r for r in runs if r[1] <= rank][-1]
            at = offset + (rank - first) % each * length
            filled.setdefault(sequence + (rank - first) // each, []).append((at, at + length))
    for spans in filled.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 40 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(filled) == best_fit_decreasing(lengths, 40)


TEXT = st.text(st.sampled_from("aZ9'.,!|<>\x1c\x85\xa0 \n\t²é́ÀßΣİÅﬁ漢😀½_-st"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_tokenizer_is_the_librarys(text):
    encode = test_tokenizer_is_the_librarys.__dict__.setdefault("encode", packing.WordTokenizer(TOKENIZER, limit=50))
    assert np.frombuffer(encode(text), "<u4").tolist() == encode.whole.encode(text, add_special_tokens=False).ids


def check(spark, rows):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(TOKENIZER)
    expected = []
    for doc, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        expected += [(doc, k, at, len(ids[at:at + 4096]), zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes()))
                     for k, at in enumerate(range(0, len(ids), 4096))]
    got = packing.pack_documents(documents(spark, rows).withColumnRenamed("lang", "part").repartition(3)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["offset"] + r["length"]))
    for spans in filled.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 4096 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(filled) == best_fit_decreasing([e[3] for e in expected], 4096)


def test_documents(spark):
    rng = random.Random(1)
    check(spark, ODD + [(20, prose(1, 9000)), (21, "x<|endoftext|>y <|")] + [(100 + i, prose(i, rng.randrange(900))) for i in range(60)])


def test_empty(spark):
    check(spark, [])
