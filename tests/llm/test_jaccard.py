import random

import pytest

from beaconry.llm import jaccard
from beaconry.llm.components import components
from tests.llm.helpers import ODD, documents, edited, prose, words


def brute(rows, k, percent):
    sets = []
    for doc, text in rows:
        w = words(text)
        sets.append((doc, frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()))
    group = list(range(len(sets)))
    for i, (_, s) in enumerate(sets):
        for j in range(i):
            t = sets[j][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, sets):
        least[g] = min((d for d in (doc, least.get(g)) if d is not None), default=None)
    return sorted(((doc, len(s), least[g] if s else doc) for g, (doc, s) in zip(group, sets)), key=str)


def check(spark, rows, k=4, percent=85):
    got = jaccard.link_documents(documents(spark, rows).withColumnRenamed("lang", "n").repartition(4), jaccard.Rule(k, percent)).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == brute(rows, k, percent)


def crowd(seed, n, length):
    """Near copies of a text, of copies of it, of longer and shorter versions; texts that share a passage."""
    rng, base, rows = random.Random(seed), prose(seed, length), []
    passage = prose(seed + 1, 60)
    for i in range(n):
        kind = rng.randrange(6)
        text = edited(base, seed * 1000 + i, rng.randrange(8))
        if kind == 1:
            text = edited(rows[-1][1] if rows else base, i, 2)
        elif kind == 2:
            text = " ".join(base.split()[:length - rng.randrange(30)])
        elif kind == 3:
            text = base + " " + prose(seed * 77 + i, rng.randrange(25))
        elif kind == 4:
            text = prose(seed * 99 + i, 80) + " " + passage
        elif kind == 5:
            text = passage + " " + edited(prose(seed + 2, 30), i, rng.randrange(3))
        rows.append((seed * 10_000 + i, text))
    return rows


@pytest.mark.parametrize("short, levels", [(12, 4), (2, 4), (3, 2)])
def test_crowds(spark, monkeypatch, short, levels):
    """Long lists at every level; the last level must be as whole as the first."""
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "LEVELS", levels)
    check(spark, crowd(short, 90, 120) + crowd(short + 50, 60, 60) + [(5, prose(short, 120))])


def test_crowd_in_few_pairs(spark, monkeypatch):
    """Edited copies of one text are compared with the text, not with each other."""
    compared, whole = [], jaccard.overlaps
    monkeypatch.setattr(jaccard, "overlaps", lambda pairs, *rest: compared.append(pairs.count()) or whole(pairs, *rest))
    base = prose(7, 150)
    rows = [(0, base)] + [(i, edited(base, i, i % 13)) for i in range(1, 200)]
    check(spark, rows)
    assert sum(compared) < 2 * len(rows)


def test_five_words(spark):
    check(spark, crowd(9, 60, 100) + ODD, 5, 80)


def test_odd(spark):
    check(spark, ODD)
    check(spark, [])


def test_bound_is_inclusive(spark):
    # 20 shingles each, 17 of 20 and 23 shared: 17 / 20 is exactly 0.85.
    base = [f"u{i}" for i in range(23)]
    check(spark, [(1, " ".join(base[:23])), (2, " ".join(base[:20]))])


def test_full_bit_table(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BITS", 64)  # every bit set: only the order is worse
    check(spark, crowd(4, 40, 80))


def test_one_per_group(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "other words"), (4, ""), (5, None), (2, "other words")]
    out = jaccard.one_per_group(documents(spark, rows))
    assert out.columns == documents(spark, []).columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2, 4, 5]


def test_one_per_group_by_row(spark):
    """Rows without an id, and different texts under one id, are documents of their own."""
    a, b, c, d = (prose(i, 60) for i in range(4))
    rows = [(7, a), (7, b), (7, a), (8, edited(a, 1, 1)), (None, c), (None, edited(c, 2, 1)), (None, d), (None, "some words"),
            (None, b + " tail"), (None, None), (None, ""), (9, ""), (9, None)]
    out = jaccard.one_per_group(documents(spark, rows).repartition(3)).collect()
    got = [(r["doc_id"], r["text"]) for r in out]
    assert {t for i, t in got if i is not None and t} == {a, b}
    assert len(got) == 2 + 3 + 2 + 1
    nameless = [t for i, t in got if i is None and t]
    assert len(nameless) == 3 and {d, "some words"} < set(nameless) and set(nameless) & {c, rows[5][1]}


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (250, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 200, 250: 200, 300: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
