import random
import re
from collections import Counter, defaultdict

import pytest

from beaconry.llm import phrases
from tests.llm.helpers import DOCS, ODD


def brute(rows, least, top, share=100):
    """rows (doc_id, text, lang, ...)"""
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und" if lang is None else lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, own in counts.items():
        n, found = totals[lang], []
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            score, k, left, right = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * f >= share * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, f in candidates.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def result(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def corpus(n, seed=3):
    rng, rows = random.Random(seed), []
    fixed = ["of the", "New york city hall", "a a a a a a a", "\x00 \x1f x", "é È ß", "p q. p q"]
    for i in range(n):
        words = [f"w{int(40 * rng.random() ** 3)}" for _ in range(rng.randrange(60))]
        for _ in range(3):
            words.insert(rng.randrange(len(words) + 1), rng.choice(fixed))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ? "] if rng.random() < 0.3 else [" "]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "en", None, "und", "zß"]), None, 1))
    return rows


@pytest.mark.parametrize("least, share, cells, chunk", [(3, 100, 1 << 25, 10**6), (4, 80, 64, 50), (25, 100, 1 << 12, 300)])
def test_against_brute_force(spark, monkeypatch, least, share, cells, chunk):
    monkeypatch.setattr(phrases, "CELLS", cells)  # shared bits make windows longer, never the result another
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    rows = corpus(200)
    docs = spark.createDataFrame(rows, DOCS).repartition(5).selectExpr("*", "1 AS w1", "2 AS n", "3 AS phrase")
    want = brute(rows, least, 50, share)
    assert result(phrases.collocations(docs, least, 50, share)) == want and len(want) > 20
    assert len(result(phrases.collocations(docs, least, None, share))) == len(brute(rows, least, 10**6, share))


def test_rollup_counts_every_length(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", None, 1), (2, "a b. c", "en", None, 1)], DOCS)
    counts = {r["phrase"]: (r["size"], r["a"]) for r in _counts(docs).collect()}
    assert counts["a b"] == (2, 2) and counts["a b c d e"] == (5, 1) and counts["f"] == (1, 1) and counts["c"] == (1, 2)
    assert "b c" in counts and "a b c d e f" not in counts and len(counts) == 6 + 5 + 4 + 3 + 2


def _counts(docs):
    coded = phrases.persist_table(phrases.code_words(docs), "words")
    short = phrases.bit_table(phrases.short_cells(coded), 1)
    return phrases.phrase_counts(phrases.windows(coded, short, phrases.bit_table(phrases.triple_cells(coded, short), 1)), 1)


def test_odd(spark):
    rows = [(d, t, None if d == 4 else "en", None, None) for d, t in ODD]
    assert result(phrases.collocations(spark.createDataFrame(rows, DOCS), 2, 100)) == brute(rows, 2, 100)
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None, None)], DOCS)).count() == 0


def test_large_products(spark):
    """1000 * a * n passes 64 bits."""
    big = 4 * 10**15
    counts = spark.createDataFrame([("en", 1, "x", big), ("en", 1, "y", big + 1), ("en", 2, "x y", big - 1)], "lang string, size int, phrase string, a long")
    totals = spark.createDataFrame([("en", 9 * 10**15)], "lang string, n long")
    row = phrases.scored(counts, totals).first()
    assert row["score"] == 1000 * (big - 1) * 9 * 10**15 // (big * (big + 1))
