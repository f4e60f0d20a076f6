import random

import pytest

from beaconry.llm import repeats
from tests.llm.helpers import ODD, documents, prose, words


def brute(rows):
    seen = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - repeats.LEAST + 1):
            seen.setdefault(tuple(w[i:i + repeats.LEAST]), set()).add(doc)
    covered = set()
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - repeats.LEAST + 1):
            if len(seen[tuple(w[i:i + repeats.LEAST])]) > 1:
                covered |= {(doc, j) for j in range(i, i + repeats.LEAST)}
    return covered


def check(spark, rows, parts=4):
    got = repeats.repeated_passages(documents(spark, rows).withColumnRenamed("lang", "key").repartition(parts)).collect()
    assert {(r["doc_id"], j) for r in got for j in range(r["begin"], r["begin"] + r["n_words"])} == brute(rows)
    assert all(r["n_words"] >= repeats.LEAST and r["other_id"] != r["doc_id"] for r in got)
    return got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages(spark, seed):
    rng = random.Random(seed)
    passages = [prose(seed * 100 + i, rng.randrange(45, 90)) for i in range(8)]
    rows = []
    for i in range(70):
        parts = [prose(seed * 7919 + i * 31 + j, rng.randrange(60)) for j in range(3)]
        parts.insert(1, rng.choice(passages))
        if i % 5 == 0:
            parts.insert(2, passages[0])
        rows.append((i, " ".join(parts)))
    check(spark, rows + [(200, rows[3][1]), (201, rows[3][1])])


def test_exact_length(spark):
    for n in (49, 50, 51):
        shared = prose(5, n)
        got = check(spark, [(1, prose(6, 30) + " " + shared + " " + prose(7, 30)), (2, prose(8, 30) + " " + shared + " " + prose(9, 30))])
        assert bool(got) == (n >= 50)


def test_only_across_documents(spark):
    twice = prose(11, 60)
    check(spark, [(1, twice + " x " + twice), (2, prose(12, 100))])
    check(spark, [(1, "ther " * 500), (2, "ther " * 300), (3, prose(1, 100))])


def test_odd(spark):
    got = check(spark, ODD + [(30, prose(1, 70)), (30, prose(1, 70)), (None, prose(1, 70)), (-1, prose(1, 70))])
    assert {(r["doc_id"], r["other_id"]) for r in got} == {(30, None), (-1, None), (None, -1)}
    check(spark, [])


@pytest.mark.parametrize("held", [50_000, 40])
def test_long_runs(spark, monkeypatch, held):
    """A document repeats a passage more often than a task holds or a range has; others have it once, in other surroundings."""
    monkeypatch.setattr(repeats, "HELD", held, raising=False)
    passage = prose(21, 50)
    many = lambda seed, n: " ".join(prose(seed * 1000 + i, 9) + " " + passage for i in range(n))
    rows = [(5, many(5, 300)), (1, prose(1, 20) + " " + passage + " " + prose(2, 20)), (7, passage)]
    ranges = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in ranges}
    try:
        for k, v in ranges.items():
            spark.conf.set(k, v)
        got = check(spark, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["other_id"] for r in got if r["doc_id"] != 1} == {1} and {r["other_id"] for r in got if r["doc_id"] == 1} == {5}


@pytest.mark.parametrize("seed", [1, 2])
def test_template(spark, seed):
    """Many documents share a block in varying surroundings: the best partner stands next in neither order."""
    rng = random.Random(seed)
    rows = []
    for t in range(6):
        block = prose(seed * 50 + t, 41)
        for i in range(50):
            left, right = ([f"{side}{t}v{rng.randrange(10) // 8}p{j}" for j in range(11)] for side in "lr")
            for side, cut in ((left, range(rng.randrange(12))), (right, range(rng.randrange(12), 11))):
                for j in cut:
                    side[j] = f"u{t}x{i}x{rng.random()}"
            rows.append((t * 100 + i, " ".join([prose(t * 999 + i, 20), *left, block, *right, prose(t * 77 + i + 5000, 20)])))
    check(spark, rows)
