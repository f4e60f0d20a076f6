"""Language identification by averaged hashed subword embeddings and a linear softmax.

A word gives its letter n-grams (with marks for its ends) and itself, each hashed to a row of an
embedding table. A text is the mean of all its rows, and a linear layer with a softmax turns that
into probabilities. Both layers are learned together by stochastic gradient descent in numpy, from
whole documents and short windows of them, so that short texts are seen too. A part of the sample
is kept back: it sets the temperature of the softmax, and the score below which an answer is
rejected, so that the answers that stay are wrong no more often than asked for.
"""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.text import crc, mixed, small_batches
from beaconry.session import persist_table

FOLDS, HELD_OUT = 4, 2
SAMPLE = 4_000  # most documents the model is fitted on, spread evenly over the languages
ERRORS = 0.01  # share of wrong answers among those not rejected
BITS, DIM, LENGTHS = 16, 16, (2, 3, 4)  # rows of the table, their width, n-grams besides single letters
BUCKETS, BASE = 1 << BITS, np.uint64(0x100000001B3)
WINDOWS = (1, 2, 4, 8, 32)  # words of the short examples of a document
EPOCHS, BATCH, RATE = 4, 32, 0.5
GROUP = 500  # texts judged together
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return LETTERS.findall(text.lower()) if text else []


def grams(words: list[str]):
    """Hashed n-grams of words that each stand between marks: (first place of each word, per kind (row, which places count)).

    Letters, n-grams and whole words are polynomials of code points, worked out for all places at once.
    """
    code = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(length) - length
    left = np.repeat(start + length, length) - np.arange(len(code))  # places from here to the word's end
    inside = (left > 1) & (left < np.repeat(length, length))
    kinds, value = [(_row(code, 1), inside)], code
    for n in range(2, max(LENGTHS) + 1):
        value = value * BASE
        value[:1 - n] += code[n - 1:]
        if n in LENGTHS:
            kinds.append((_row(value, n), left >= n))
    power = np.cumprod(np.append(np.ones(1, np.uint64), np.full(length.max() - 1, BASE)))
    whole = np.zeros(len(code), np.int64)
    whole[start] = _row(np.add.reduceat(code * power[np.repeat(length, length) - left], start), 0)
    first = np.zeros(len(code), bool)
    first[start] = True
    return start, [*kinds, (whole, first)]


def _row(value: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(value + np.uint64(kind << 56)) >> np.uint64(64 - BITS)).astype(np.int64)


def rows_of(words: list[str]) -> np.ndarray:
    """Rows of all n-grams of some words."""
    return np.concatenate([row[counts] for part in _slices(words) for row, counts in grams(part)[1]])


def _slices(words: list[str], letters: int = 100_000):
    """Runs of words of about so many letters."""
    lo, size = 0, 0
    for i, w in enumerate(words):
        if size and size + len(w) > letters:
            yield words[lo:i]
            lo, size = i, 0
        size += len(w) + 2
    yield words[lo:]


def word_sums(table: np.ndarray, words: list[str]) -> np.ndarray:
    """Sum of the rows of each word, and their number."""
    width, lo = table.shape[1], 0
    out = np.zeros((len(words), width + 1))
    for part in _slices(words):
        if len(part) == 1:  # of any length
            times = np.bincount(rows_of(part), minlength=BUCKETS)
            out[lo] = np.append(times @ table.astype(np.float64), times.sum())
        else:
            start, kinds = grams(part)
            picked, number = np.zeros((len(kinds[0][0]), width), np.float32), np.zeros(len(kinds[0][0]), np.int64)
            for row, counts in kinds:
                picked += table[row] * counts[:, None]
                number += counts
            out[lo:lo + len(part), :width] = np.add.reduceat(picked, start, axis=0)
            out[lo:lo + len(part), width] = np.add.reduceat(number, start)
        lo += len(part)
    return out


def has_letter(words: list[str]) -> bool:
    """Runs may be of numerals such as superscripts only."""
    return any(c.isalpha() for w in words for c in w)


def learning_rows(docs: DataFrame, sample: int) -> DataFrame | None:
    """(lang, doc_id, text, calibrates): one text per language and id, evenly over the languages.

    At most ``sample`` documents of at most ``sample`` languages, the most frequent ones. Ids are
    chosen by their hash, so that copies of an id or the order of rows change nothing.
    """
    known = docs.where(F.col("lang").isNotNull() & (crc(F.col("doc_id")) % FOLDS != HELD_OUT))
    langs = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()]
    if not langs:
        return None
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (known.where(F.col("lang").isin(langs)).select("lang", "doc_id").distinct().withColumn("_place", F.row_number().over(by_hash))
           .where(F.col("_place") <= max(sample // len(langs), 1)))
    ids = ids.select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id"), "_place")
    joined = known.join(F.broadcast(ids), F.expr("lang = _lang AND doc_id <=> _id"))  # at most `sample` ids
    return joined.groupBy("lang", "doc_id").agg(F.min("text").alias("text"), (F.min("_place") % 4 == 0).alias("calibrates"))


def examples(rows: DataFrame) -> DataFrame:
    """Rows and weights of each whole text, and of one window of each length in it."""
    def run(batches):
        for batch in batches:
            for lang, doc, text, calibrates in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own, out = words_of(text), []
                rng = random.Random(zlib.crc32(str(doc).encode()))
                parts = [own] + [own[(at := rng.randrange(len(own))):at + n] for n in WINDOWS if n < len(own)]
                for place, part in enumerate(parts):
                    if part:
                        row, times = np.unique(rows_of(part), return_counts=True)
                        out.append((lang, doc, place, calibrates, row.astype(np.int32), (times / times.sum()).astype(np.float32)))
                if out:
                    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.float32())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                     ["lang", "doc_id", "place", "calibrates", "rows", "weights"])

    return rows.select("lang", "doc_id", "text", "calibrates").mapInArrow(
        run, "lang string, doc_id long, place int, calibrates boolean, rows array<int>, weights array<float>")


class Model:
    """Languages, embeddings, linear layer, temperature and the least score that is not rejected."""

    def __init__(self, langs: list[str], seed: int = 1):
        self.langs = langs
        self.table = np.random.default_rng(seed).uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
        self.out, self.bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
        self.temperature, self.least = 1.0, 0.0

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        return self.of_logits(means @ self.out + self.bias)

    def of_logits(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def projected(self) -> np.ndarray:
        """The linear layer applied to each row: the mean of these is the layer applied to the mean."""
        return self.table @ self.out


def _means(table: np.ndarray, flat: np.ndarray, weights: np.ndarray, at: np.ndarray, some: np.ndarray):
    """Means of some examples, with the distinct rows they use and the weights of these per example."""
    spans = [slice(at[e], at[e + 1]) for e in some]
    rows = np.concatenate([flat[s] for s in spans])
    seen = np.zeros(BUCKETS, bool)
    seen[rows] = True
    used = np.flatnonzero(seen)
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    x = np.zeros((len(some), len(used)), np.float32)
    x[np.repeat(np.arange(len(some)), [s.stop - s.start for s in spans]), place[rows]] = np.concatenate([weights[s] for s in spans])
    return used, x, x @ table[used]


def train(model: Model, flat, weights, at, label: np.ndarray, chosen: np.ndarray, seed: int = 2) -> None:
    """Gradient steps over batches of the chosen examples, with a rate that falls to zero."""
    rng, step = np.random.default_rng(seed), 0
    steps = EPOCHS * -(-len(chosen) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(chosen)
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            used, x, means = _means(model.table, flat, weights, at, some)
            wrong = model.probabilities(means)
            wrong[np.arange(len(some)), label[some]] -= 1
            rate = np.float32(RATE * (1 - step / steps))
            back = x.T @ (wrong @ model.out.T)
            model.out -= rate * (means.T @ wrong)
            model.bias -= rate * wrong.sum(axis=0)
            model.table[used] -= rate * back
            step += 1


def calibrate(model: Model, means: np.ndarray, label: np.ndarray, share: np.ndarray, errors: float) -> None:
    """Temperature of least loss, then the least score at which the answers kept are wrong at most ``errors`` of the time."""
    def loss(temperature: float) -> float:
        model.temperature = temperature
        p = model.probabilities(means)[np.arange(len(label)), label]
        return -(share * np.log(np.maximum(p, 1e-12))).sum()

    model.temperature = min(2.0 ** (np.arange(-24, 25) / 4), key=loss)
    p = model.probabilities(means)
    score, wrong = p.max(axis=1), p.argmax(axis=1) != label
    order = np.argsort(-score, kind="stable")
    kept = np.cumsum((share * wrong)[order]) <= errors * np.cumsum(share[order])
    model.least = float(score[order][np.flatnonzero(kept)[-1]]) if kept.any() else 1.0


def fit(docs: DataFrame, sample: int = SAMPLE, errors: float = ERRORS) -> Model | None:
    """The model, or None without a labelled document. What leaves Spark is bounded by ``sample``."""
    with small_batches(docs.sparkSession, 200):
        rows = learning_rows(docs.select("doc_id", "lang", "text"), sample)
        if rows is None:
            return None
        got = persist_table(examples(persist_table(rows, "language-sample")), "language-examples").toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by([("lang", "ascending"), ("doc_id", "ascending"), ("place", "ascending")]).combine_chunks()
    names = got.column("lang").to_pylist()
    model = Model(sorted(set(names)))
    label = np.searchsorted(model.langs, names)
    lists = got.column("rows").combine_chunks()
    flat, weights = lists.flatten().to_numpy(), got.column("weights").combine_chunks().flatten().to_numpy()
    at = np.append([0], np.cumsum(lists.value_lengths().to_numpy()))
    back = got.column("calibrates").to_numpy()
    if back.all() or not back.any():  # too few documents to keep some back
        back = np.zeros(len(label), bool)
    train(model, flat, weights, at, label, np.flatnonzero(~back))
    whole = got.column("place").to_numpy() == 0  # scores are for whole texts
    some = np.flatnonzero(whole & back if back.any() else whole)
    means = np.concatenate([_means(model.table, flat, weights, at, some[lo:lo + 256])[2] for lo in range(0, len(some), 256)])
    calibrate(model, means, label[some], 1 / np.bincount(label[some], minlength=len(model.langs))[label[some]], errors)
    return model


class Words(dict):
    """Numbers words in order of appearance, with the sums of their rows; starts anew beyond ``limit`` words."""

    def __init__(self, table: np.ndarray, limit: int = 200_000):
        super().__init__()
        self.table, self.limit, self.fresh = table, limit, []
        self.sums = np.zeros((0, table.shape[1] + 1))

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.fresh.append(word)
        return place

    def means(self, texts: list[list[str]]) -> np.ndarray:
        """Mean row of each text of at least one word; a word of many texts is worked out once."""
        if len(self) > self.limit:
            self.clear()
            self.sums = self.sums[:0]
        codes = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in texts]
        if self.fresh:
            self.sums = np.concatenate([self.sums, word_sums(self.table, self.fresh)])
            self.fresh = []
        total = np.array([self.sums[c].sum(axis=0) for c in codes])
        return total[:, :-1] / total[:, -1:]


def identify(docs: DataFrame, sample: int = SAMPLE, errors: float = ERRORS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    `lang_pred` is the likeliest learned language and `score` its calibrated probability. `rejected` is
    true where the score is below the one that keeps wrong answers at ``errors``. A text that is null
    or has no letter is `und`, with score 0, rejected; so is every text if no document has a language. A
    null id counts as a training document. Rows repeated or of equal ids are judged alike; the model
    takes one text per language and id. Further columns are never read.
    """
    model = fit(docs, sample, errors)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        words = Words(model.projected()) if model else None
        for batch in (b.slice(at, GROUP) for b in batches for at in range(0, b.num_rows, GROUP)):
            ids = batch.column(0)
            own = [words_of(t) for t in batch.column(1).to_pylist()] if model else []
            judged = np.array([has_letter(w) for w in own], bool) if model else np.zeros(batch.num_rows, bool)
            p = np.zeros((batch.num_rows, len(model.langs) if model else 1))
            if judged.any():
                p[judged] = model.of_logits(words.means([w for w, j in zip(own, judged) if j]) + model.bias)
            langs, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            if judged.any():
                best = p.argmax(axis=1)
                score = np.where(judged, p.max(axis=1), 0.0)
                langs = [model.langs[b] if j else "und" for b, j in zip(best, judged)]
            rejected = ~judged | (score < (model.least if model else 1.0))
            yield pa.RecordBatch.from_arrays([ids, pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)],
                                             ["doc_id", "lang_pred", "score", "rejected"])

    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")
    return judged.select("doc_id", (crc(F.col("doc_id")) % FOLDS == HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")
