import random
import zlib

import numpy as np

from beaconry.llm import language
from tests.llm.helpers import DOCS, ODD

SOUNDS = {"aa": ["ka", "to", "mi", "ne", "ru"], "bb": ["sch", "ung", "eit", "ver", "ä"], "cc": ["eau", "oi", "é", "que", "ment"],
          "dd": ["яна", "бор", "ёл", "ки", "ту"]}


def corpus(n, seed=4):
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(["aa", "aa", "aa", "bb", "cc", "dd"])
        words = ["".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(2, 60))]
        rows.append((i, " ".join(words).title(), lang, "s", 1))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    rows = corpus(500)
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS score", "2 AS place", "3 AS calibrates")
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert len(got) == len(rows) and all(got[i]["held_out"] == held(i) and 0 <= got[i]["score"] <= 1 for i in got)
    unseen = [r for r in rows if held(r[0])]
    assert len(unseen) > 90 and sum(got[r[0]]["lang_pred"] == r[2] for r in unseen) >= 0.98 * len(unseen)
    kept = [r for r in rows if not got[r[0]]["rejected"]]
    assert len(kept) > 0.9 * len(rows) and sum(got[r[0]]["lang_pred"] != r[2] for r in kept) <= 0.02 * len(kept)
    # Labels of held-out documents are not read, nor are source and the order of rows.
    turned = [(i, t, "dd" if held(i) else lang, "x", 2) for i, t, lang, *_ in reversed(rows)]
    again = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(turned, DOCS).repartition(3)).collect()}
    assert {i: (r["lang_pred"], round(r["score"], 6)) for i, r in again.items()} == {i: (r["lang_pred"], round(r["score"], 6)) for i, r in got.items()}


def test_scores_are_calibrated(spark):
    """Texts of two languages half and half: the scores are near the share of right answers."""
    rng, rows = random.Random(8), []
    for i in range(600):
        lang, other = rng.sample(["aa", "bb"], 2)
        words = ["".join(rng.choice(SOUNDS[lang if rng.random() < 0.6 else other]) for _ in range(2)) for _ in range(5)]
        rows.append((i, " ".join(words), lang, None, None))
    got = [r for r in language.identify(spark.createDataFrame(rows, DOCS)).collect() if r["held_out"]]
    langs = {r[0]: r[2] for r in rows}
    right = np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in got])
    assert abs(np.mean([r["score"] for r in got]) - right) < 0.12
    assert np.mean([r["rejected"] for r in got]) > 0.2


def test_gradient():
    """A step follows the gradient of the loss of its batch."""
    rng = np.random.default_rng(0)
    at, flat = np.array([0, 3, 5]), np.array([4, 9, 77, 9, 500], np.int32)
    weights, label = np.array([0.5, 0.25, 0.25, 0.5, 0.5], np.float32), np.array([0, 2])

    def model():
        m = language.Model(["a", "b", "c"])
        m.out[:] = np.random.default_rng(3).normal(size=m.out.shape)
        return m

    def loss(m):
        return -np.log(m.probabilities(language._means(m.table, flat, weights, at, np.arange(2))[2])[np.arange(2), label]).sum()

    old = language.EPOCHS, language.RATE
    try:
        language.EPOCHS, language.RATE = 1, 1e-2
        base, moved = model(), model()
        language.train(moved, flat, weights, at, label, np.arange(2))
        for row, d in [(9, 1), (500, 0), (4, 7)]:
            eps, up, down = 1e-2, model(), model()
            up.table[row, d] += eps
            down.table[row, d] -= eps
            slope = (loss(up) - loss(down)) / (2 * eps)
            assert abs((base.table[row, d] - moved.table[row, d]) / 1e-2 - slope) < 2e-2
        assert (moved.table[5] == base.table[5]).all() and loss(moved) < loss(base)
    finally:
        language.EPOCHS, language.RATE = old
    del rng


def plain_rows(word):
    """Rows of a word, one n-gram at a time."""
    def row(text, kind):
        value = 0
        for c in text:
            value = (value * int(language.BASE) + ord(c)) % 2**64
        return int(language._row(np.array([value], np.uint64), kind)[0])

    marked = f"<{word}>"
    whole = sum(ord(c) * pow(int(language.BASE), i, 2**64) for i, c in enumerate(marked)) % 2**64
    out = [row(c, 1) for c in word] + [row(marked[i:i + n], n) for n in language.LENGTHS for i in range(len(marked) - n + 1)]
    return sorted([*out, int(language._row(np.array([whole], np.uint64), 0)[0])])


def test_word_sums_agree_with_plain_means():
    model = language.Model(["a"])
    texts = ["one two three", "x", "ab " * 3000, "y" * 500 + " z é", "one " + "q" * 70, "\U0001d400 ёл " + "w" * 120_000]
    words = language.Words(model.table, limit=5)
    means = np.concatenate([words.means([language.words_of(t)]) for t in texts[:4]] + [words.means([language.words_of(t) for t in texts[4:]])])
    for text, mean in zip(texts, means):
        own = language.words_of(text)
        rows = [b for w in own for b in plain_rows(w)]
        assert sorted(language.rows_of(own)) == sorted(rows)
        assert np.allclose(mean, model.table[rows].mean(axis=0, dtype=np.float64), atol=1e-6)


def test_odd(spark):
    rows = corpus(150) + [(None if d is None else d + 1000, t, "aa", None, None) for d, t in ODD] + [(2000, "² 12 -- _", "bb", None, None)]
    got = language.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    none = {r["doc_id"]: tuple(r)[2:] for r in got if r["doc_id"] in (1001, 1002, 1003, 2000)}
    assert set(none.values()) == {("und", 0.0, True)} and len(none) == 4
    assert all(r["lang_pred"] in SOUNDS for r in got if r["doc_id"] in (1004, 1008))


def test_without_labels(spark):
    rows = [(i, t, None, s, n) for i, t, _, s, n in corpus(20)]
    assert {r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, DOCS)).collect()} == {"und"}
    assert language.identify(spark.createDataFrame([], DOCS)).count() == 0
    one = [(1, "only one", "aa", None, None), (3, None, "bb", None, None)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(one, DOCS)).collect()}
    assert got == {1: "aa" if not held(1) else "und", 3: "und"}


def test_bounded_sample(spark):
    rows = corpus(300) + [(7, "copy", "aa", None, None)] * 200
    chosen = language.learning_rows(spark.createDataFrame(rows, DOCS).select("doc_id", "lang", "text"), 40)
    assert 20 <= chosen.count() <= 40
