"""Fingerprints from prefix polynomial hashes.

A text's prefix array holds sum(code[j] * base**j) modulo the prime 2**31 - 1 for every prefix. The
hash of any span is one subtraction and one multiplication, so equality of two spans costs a
constant (two bases are compared) and the longest common extension of two places is a binary
search. The fingerprint of a text keeps the smallest mixed hashes of all its spans of 24, 6 and 2
characters; likeness is the share of common spans estimated from them, at the largest scale that
the shorter text fills four times.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.text import mixed

PRIME = np.int64(2**31 - 1)
BASES = (1_210_458_731, 998_244_353)
SCALES, KEPT = (24, 6, 2), 32


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME for 0 <= x < 2**62, by folding the high bits down."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


class Powers:
    """Powers of the bases and of the first one's inverse, grown as texts need."""

    def __init__(self):
        self.n = 0
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        self.n = max(n, 2 * self.n)
        self.tables = [self._table(b) for b in BASES]
        self.inverse = self._table(pow(BASES[0], -1, int(PRIME)))

    def _table(self, base: int) -> np.ndarray:
        out = np.ones(1, np.int64)
        while len(out) < self.n:
            step = np.int64(pow(base, len(out), int(PRIME)))
            out = np.concatenate([out, _mod(out * step)])
        return out[:self.n]


POWERS = Powers()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class Prefixes:
    """Prefix hashes of a text."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        if self.n + 1 > POWERS.n:
            POWERS.grow(self.n + 1)
        # Below 2**31 terms, each under 2**31, sum up within 62 bits.
        self.sums = [_mod(np.concatenate([[0], np.cumsum(_mod((text + 1) * t[:self.n]))])) for t in POWERS.tables]

    def spans(self, k: int) -> np.ndarray:
        """Hash of each span of k characters, comparable between places and texts."""
        sums = self.sums[0]
        return _mod(_mod(sums[k:] - sums[:self.n + 1 - k] + PRIME) * POWERS.inverse[:self.n + 1 - k])

    def whole(self) -> str:
        return "".join(f"{int(s[-1]):08x}" for s in self.sums)


def equal(a: Prefixes, i: int, b: Prefixes, j: int, k: int) -> bool:
    """Whether a[i:i+k] and b[j:j+k] are the same."""
    for s, t, base in zip(a.sums, b.sums, BASES):
        x, y, p = int(s[i + k] - s[i]), int(t[j + k] - t[j]), int(PRIME)
        x, y = (x * pow(base, j - i, p), y) if j >= i else (x, y * pow(base, i - j, p))
        if (x - y) % p:
            return False
    return True


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common span that starts at a[i] and b[j]."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if equal(a, i, b, j, middle) else (low, middle - 1)
    return low


def _smallest(values: np.ndarray) -> np.ndarray:
    """The KEPT smallest distinct mixed values."""
    h = (mixed(values.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    some = 4 * KEPT
    if len(h) > 2 * some:
        low = np.unique(np.partition(h, some)[:some])
        if len(low) >= KEPT:
            return low[:KEPT]
    return np.unique(h)[:KEPT]


class Fingerprint:
    def __init__(self, text: np.ndarray):
        self.prefixes = Prefixes(text)
        self.sketches = [_smallest(self.prefixes.spans(k)) if len(text) >= k else np.zeros(0, np.uint32) for k in SCALES]

    def __str__(self) -> str:
        parts = ["".join(f"{int(v):08x}" for v in s) for s in self.sketches]
        return f"{self.prefixes.n}:{self.prefixes.whole()}:{'.'.join(parts)}"


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Estimated share of common spans, 0 to 1; equal texts give 1, an empty and another text 0."""
    x, y = a.prefixes, b.prefixes
    if x.n == y.n and all(s[-1] == t[-1] for s, t in zip(x.sums, y.sums)):
        return 1.0
    n = min(x.n, y.n)
    level = next((i for i, k in enumerate(SCALES) if n >= 4 * k), len(SCALES) - 1)
    s, t = a.sketches[level], b.sketches[level]
    union = np.union1d(s, t)[:KEPT]
    if not len(s) or not len(t):
        return 0.0
    return float(len(np.intersect1d(np.intersect1d(s, t, True), union, True)) / len(union))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_prefix long")


def _row(doc, own, nxt):
    """One result row from (text, codes, fingerprint) of a document and of the next."""
    (text, code, print_), (_, code_next, print_next) = own, nxt
    third = len(code) // 3
    edited = np.concatenate([code[:len(code) - third], code_next[:third]])
    edited_text = edited.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    edited_print = Fingerprint(edited)
    return (doc, len(code), hashlib.sha256(edited_text.encode("utf-8", "surrogatepass")).hexdigest(), str(print_),
            str(edited_print), likeness(print_, edited_print), likeness(print_, print_next),
            common_extension(print_.prefixes, 0, edited_print.prefixes, 0))


def fingerprint_documents(docs: DataFrame, per_task: int = 4) -> DataFrame:
    """Fingerprint of each text and of its edited text; see RESULT.

    The next document is the next smaller doc_id (null ids last, ties by text; after the last, the
    first). Texts move once: into ranges of doc_id, several to a task, each with one guest, the
    document that follows the range. Null and empty texts are alike and unlike any other.
    ``common_prefix`` is where a text and its edited text part. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(parts * per_task, 2)
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / n) for i in range(1, n)]), 10 * n)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(cuts, ids.fillna(0).astype("int64"), side="left")
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, len(cuts) - place), index=ids.index)  # descending ids

    ranged = rows.withColumn("range", range_of("doc_id"))
    firsts = {r["range"]: r["id"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("id")).collect()}  # one per range
    order = sorted(firsts)
    guests = spark.createDataFrame([(firsts[b], a) for a, b in zip(order, order[1:] + order[:1])], "guest_id long, range int")
    lent = rows.join(F.broadcast(guests), F.expr("doc_id <=> guest_id")).select("doc_id", "text", "range", F.lit(True).alias("guest"))
    lined = (ranged.withColumn("guest", F.lit(False)).unionByName(lent).repartition(parts, "range")
             .sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), "text"))

    def run(batches):
        waiting = None  # (range, doc, own) that still lacks its next
        for batch in batches:
            done = []
            for doc, text, range_, guest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if guest and (waiting is None or waiting[0] != range_):
                    continue  # a tie of the guest
                code = codes(text)
                own = text, code, Fingerprint(code)
                if waiting is not None:
                    done.append(_row(waiting[1], waiting[2], own))
                waiting = None if guest else (range_, doc, own)
            if done:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)],
                                                 [f.split()[0] for f in RESULT.split(", ")])

    return lined.select("doc_id", "text", "range", "guest").mapInArrow(run, RESULT)
