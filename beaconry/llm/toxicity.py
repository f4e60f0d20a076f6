"""Toxicity by two class-conditional Kneser-Ney models.

One bigram model is learned from toxic and one from ordinary documents. Each counts in how many
documents an n-gram stands, takes an absolute discount off, and gives the discounted mass to the
next lower order; the lowest order is shared by both: in how many contexts a word was seen at all.
So an expression too rare to tell the classes apart has nearly the same probability in both. A
document is judged by its log-likelihood ratio per word, by the ratio of its most telling words,
and by its length, weighed by a logistic regression fitted on ratios from models that had not
seen the document.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.text import WordHashes, crc, mixed, small_batches, words
from beaconry.session import persist_table

SAMPLE = 10_000  # most labelled documents the models are fitted on
DISCOUNT = 3.0
FOLDS = 5
MARKS = string.punctuation.encode()
CELLS = ("o0", "o1", "t0", "t1")  # ordinary or toxic documents of either half


def features_of_words(text: str | None, hashes: WordHashes) -> np.ndarray:
    return hashes.array([w for w in (w.strip(MARKS) for w in words(text)) if w])


def pair_keys(h: np.ndarray) -> np.ndarray:
    return mixed(mixed(h[:-1]) + h[1:])


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic, half) of at most ``sample`` labelled documents outside the held-out fold."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(crc(F.col("doc_id")) % FOLDS != 0)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = chosen.select(F.col("doc_id").alias("_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.expr("doc_id = _id"))  # at most `sample` ids
    return joined.select("text", "toxic", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)).cast("int").alias("half"))


def count_grams(sample: DataFrame) -> DataFrame:
    """Documents per n-gram and cell: (v, w, key, o0, o1, t0, t1); v is null for single words."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            out = []
            for text, toxic, half in zip(*(batch.column(i).to_pylist() for i in range(3))):
                h = features_of_words(text, hashes)
                cell = 2 * toxic + half
                single = np.unique(h)
                out.append((np.zeros(len(single), bool), np.zeros(len(single), np.uint64), single, single, np.full(len(single), cell, "i4")))
                if len(h) > 1:
                    key, at = np.unique(pair_keys(h), return_index=True)
                    out.append((np.ones(len(key), bool), h[:-1][at], h[1:][at], key, np.full(len(key), cell, "i4")))
            if out:
                pair, v, w, key, cell = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64), mask=~pair), pa.array(w.view(np.int64)),
                                                  pa.array(key.view(np.int64)), pa.array(cell)], ["v", "w", "key", "cell"])

    rows = sample.mapInArrow(run, "v long, w long, key long, cell int")
    each = [F.sum((F.col("cell") == i).cast("int")).cast("long").alias(c) for i, c in enumerate(CELLS)]
    return rows.groupBy("v", "w", "key").agg(*each)


def place_of(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key; the length of the table for an unknown one."""
    at = np.searchsorted(table, keys)
    hit = table[np.minimum(at, len(table) - 1)] == keys if len(table) else np.zeros(len(keys), bool)
    return np.where(hit, at, len(table))


def features(tables: dict, h: np.ndarray, halves: tuple[int, ...]) -> np.ndarray:
    """Ratio per word by single words and by pairs, mean of the three largest, largest, log length.

    Averaged over the models of the given halves. A document of the sample takes the one that had not
    seen it; any other takes both, so its ratios are on the scale the weights were fitted on.
    """
    if not len(h):
        return np.zeros(5)
    place = place_of(tables["words"], h)
    known = place_of(tables["pairs"], pair_keys(h)) if len(h) > 1 else np.zeros(0, np.int64)
    rows = []
    for half in halves:
        single = tables["single"][half][place]
        later = np.where(known < len(tables["pairs"]), np.append(tables["pair"][half], 0)[known], tables["back"][half][place[:-1]] + single[1:])
        pair = (single[0] + later.sum()) / len(h)
        top = np.partition(single, len(single) - 3)[-3:] if len(single) > 3 else single
        rows.append((single.mean(), pair, top.mean(), top.max(), np.log(len(h) + 1)))
    return np.mean(rows, axis=0)


def ratio_tables(totals: dict, single, pairs) -> dict:
    """Log-likelihood ratios of words and word pairs, learned without half 0 or without half 1."""
    known_words = np.sort(single["w"].to_numpy().astype(np.int64).view(np.uint64))
    order = np.argsort(single["w"].to_numpy().astype(np.int64).view(np.uint64))
    single = single.iloc[order]
    pair_keys_ = pairs["key"].to_numpy().astype(np.int64).view(np.uint64)
    pairs = pairs.iloc[np.argsort(pair_keys_)]
    known_pairs = np.sort(pair_keys_)
    place_v, place_w = (place_of(known_words, pairs[c].to_numpy().astype(np.int64).view(np.uint64)) for c in ("v", "w"))
    shared = (single["contexts"].to_numpy() + 0.5) / (totals["pair_types"] + 0.5 * (totals["types"] + 1))
    singles, backs, both_ = [], [], []
    for without in (0, 1):
        cells = {c: f"{c}{1 - without}" for c in "ot"}
        ratio = {}
        for c in "ot":
            name = cells[c]
            n = max(totals["n_" + name], 1)
            count = single[name].to_numpy()
            left = totals["free_" + name] + 0.5  # never nothing, even for a half without documents of the class
            p = (np.maximum(count - DISCOUNT, 0) + left * shared) / (n + 0.5)
            p = np.append(p, left / (n + 0.5))  # the shared factor of an unknown word cancels out
            seen, free = single["n_" + name].to_numpy(), single["free_" + name].to_numpy()
            back = np.append(np.where(seen > 0, free / np.maximum(seen, 1), 1.0), 1.0)
            n_pair = pairs[name].to_numpy()
            of = np.append(np.maximum(seen, 1), 1)[place_v]
            both = np.maximum(n_pair - DISCOUNT, 0) / of + back[place_v] * p[place_w]
            ratio[c] = [np.log(np.maximum(x, 1e-300)) for x in (p, back, both)]
        for kept, t, o in zip((singles, backs, both_), ratio["t"], ratio["o"]):
            kept.append((t - o).astype(np.float32))
    return {"words": known_words, "pairs": known_pairs, "single": singles, "back": backs, "pair": both_}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the last one constant, of a ridge logistic regression by Newton steps on standardised columns."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, a.T @ (y - p) - ridge * w)
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(ratios, weights), or (None, share of toxic) when a class has no labelled document.

    The fitted tables are bounded by ``sample``: only n-grams of more than DISCOUNT documents of a
    class carry mass of their own, so only these leave Spark.
    """
    with small_batches(docs.sparkSession, 500):
        return _fit(docs, labels, sample)


def _fit(docs: DataFrame, labels: DataFrame, sample: int):
    chosen = persist_table(labelled(docs, labels, sample), "toxicity-sample")
    n, toxic = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:
        return None, (toxic + 1) / (n + 4)
    grams = persist_table(count_grams(chosen), "toxicity-grams")
    sums = [F.expr(f"CAST(coalesce(sum({c}), 0) AS DOUBLE)").alias("n_" + c) for c in CELLS]
    sums += [F.expr(f"CAST(coalesce(sum(least({c}, {DISCOUNT})), 0) AS DOUBLE)").alias("free_" + c) for c in CELLS]
    single, pairs = grams.where("v IS NULL").drop("v", "key"), grams.where("v IS NOT NULL")
    totals = single.agg(*sums, F.count(F.lit(1)).alias("types")).first().asDict() | {"pair_types": pairs.count()}
    telling = f"greatest(o0, o1, t0, t1) > {DISCOUNT}"
    contexts = pairs.groupBy("w").agg(F.count(F.lit(1)).alias("contexts"))
    heads = pairs.groupBy(F.col("v").alias("w")).agg(*sums)
    table = single.where(telling).join(contexts, "w", "left").join(heads, "w", "left").na.fill(0).toPandas()
    ratios = ratio_tables(totals, table, pairs.where(telling).select("v", "w", "key", *CELLS).toPandas())
    seen = _features(chosen.select("text", "toxic", "half"), ratios).toPandas()
    x = np.array(seen["f"].tolist(), np.float64)
    return ratios, logistic(x, seen["toxic"].to_numpy(np.float64))


def _features(sample: DataFrame, ratios: dict) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            rows = [features(shared.value, features_of_words(t, hashes), (h,))
                    for t, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "f"])

    return sample.mapInArrow(run, "toxic int, f array<double>")


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have the features of no words and get the score that follows from them.
    Without labels of both classes every document gets the smoothed share of toxic labels. Null
    labels are ignored; a document labelled twice is toxic if one label says so. Further columns
    are never read.
    """
    ratios, weights = fit(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast((ratios, weights))

    def run(batches):
        model, w = shared.value
        hashes = WordHashes()
        for batch in batches:
            if model is None:
                scores = np.full(batch.num_rows, w)
            else:
                x = np.array([features(model, features_of_words(t.as_py(), hashes), (0, 1)) for t in batch.column(1)]).reshape(-1, 5)
                scores = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    scored = docs.select(F.col(key).cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc(F.col("doc_id")) % FOLDS == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are not rejected, all columns."""
    ratios, weights = fit(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast((ratios, weights))

    def run(batches):
        model, w = shared.value
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                if model is not None:
                    texts = part.column(batch.schema.get_field_index("text")).to_pylist()
                    x = np.array([features(model, features_of_words(t, hashes), (0, 1)) for t in texts]).reshape(-1, 5)
                    part = part.filter(pa.array(x @ w[:-1] + w[-1] < 0))
                elif w >= 0.5:
                    part = part.slice(0, 0)
                yield part

    return docs.mapInArrow(run, docs.schema)
