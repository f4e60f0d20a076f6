import collections
import math
import zlib

import numpy as np
import pytest

from beaconry.llm import brown
from tests.llm.helpers import ODD, documents, prose, stored, words


def likelihood(bigrams, of):
    table = collections.Counter()
    for (a, b), n in np.ndenumerate(bigrams):
        table[of[a], of[b]] += n
    rows, cols = collections.Counter(), collections.Counter()
    for (a, b), n in table.items():
        rows[a] += n
        cols[b] += n
    x = lambda n: n * math.log(n) if n else 0
    return sum(map(x, table.values())) - sum(map(x, rows.values())) - sum(map(x, cols.values()))


def test_exchange_climbs():
    rng = np.random.default_rng(1)
    n = 12
    bigrams = np.zeros((n + 2, n + 2))
    groups = np.array([0, 1, 2, 2, 0, 1, 1, 0, 2, 0, 1, 2])
    for _ in range(6000):  # words of group g are followed by words of group g + 1
        a = rng.integers(n)
        b = rng.choice(np.flatnonzero(groups == (groups[a] + 1) % 3))
        bigrams[a, b] += 1
    of = brown.exchange(bigrams, n, classes=4, sweeps=20)
    start = np.concatenate([np.arange(n) % 4, [4, 5]])
    assert likelihood(bigrams, of) > likelihood(bigrams, start)
    for w in range(n):  # no single move is better
        for c in range(4):
            moved = of.copy()
            moved[w] = c
            assert likelihood(bigrams, moved) <= likelihood(bigrams, of) + 1e-6


def check(spark, rows, folder):
    df = stored(spark, documents(spark, rows).withColumnRenamed("lang", "h").repartition(3), folder)
    got = brown.score_documents(df).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts, docs = collections.Counter(), 0
    for d, t in rows:
        if not held(d):
            counts.update(words(t))
            docs += 1
    tokens, distinct = sum(counts.values()) + docs, len(counts) + (docs > 0)
    expected = []
    for d, t in rows:
        own = words(t)
        base = sum(math.log10((c + 1) / (tokens + distinct + 1)) for c in [*(counts[w] for w in own), docs])
        expected.append((d, held(d), len(own) + 1, sum(w in counts for w in own) + (docs > 0), tokens, pytest.approx(base)))
    order = lambda r: (str(r[0]), r[2], r[3])
    assert [tuple(r)[:6] for r in sorted(got, key=order)] == sorted(expected, key=order)
    return got


def test_counts_and_gain(spark, tmp_path):
    # Two languages that never mix: classes learn which one a text is in.
    rows = [(i, " ".join(f"{'ab'[i % 2]}{w}" for w in prose(i, 150, 200).split())) for i in range(200)]
    got = check(spark, rows + [(500, "never seen words"), (501, None), (502, "")], tmp_path)
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 5]
    assert len(held) > 10
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.2 * sum(r["n_tokens"] for r in held)


def test_odd(spark, tmp_path):
    assert all(np.isfinite(r["score"]) for r in check(spark, ODD, tmp_path))


def test_probabilities_sum_to_one(spark, tmp_path):
    """Of all texts of one word, unknown included."""
    ids = [d for d in range(10, 300) if zlib.crc32(str(d).encode()) % 7 != 2]
    rows = list(zip(ids, ["a a b a", "b a c", "a b", "b b a a"]))
    probes = [d for d in range(10, 300) if zlib.crc32(str(d).encode()) % 7 == 2][:5]
    got = {r["doc_id"]: r["score"] for r in check(spark, rows + list(zip(probes, ["", "a", "b", "c", "zzz"])), tmp_path)}
    p = {w: 10 ** got[d] for d, w in zip(probes, ["", "a", "b", "c", "zzz"])}
    # P(text of one word w) = P(w | start) * P(end | class of w); all of them and the empty text stay below one.
    assert 0 < p[""] < 1 and sum(p.values()) < 1 and p["a"] > p["zzz"]


def test_empty(spark, tmp_path):
    assert check(spark, [], tmp_path) == []


def test_head_counts_every_word(spark, monkeypatch):
    """A word that many tasks see, but that none has among its most frequent."""
    monkeypatch.setattr(brown, "HEAD", 2)
    rows = [(i == 3, " ".join([f"w{i}x{j}" for j in range(30)] * 10 + ["steady"] * 9)) for i in range(4)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "held_out boolean, text string")
    for partial in (5, 200_000):
        monkeypatch.setattr(brown, "PARTIAL", partial, raising=False)
        head, tokens = brown.head_words(docs)
        assert head == [b"steady", b"w0x0"] and tokens == 3 * (309 + 1)
    assert brown.head_words(docs.where("held_out")) == ([], 0)
