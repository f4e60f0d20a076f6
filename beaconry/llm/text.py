"""Word and row helpers that several operators of this folder share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z lower-cased, as UTF-8. Null gives none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Jobs run inside hand at most ``rows`` rows at a time to Python, where rows may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def crc(column: Column) -> Column:
    """CRC-32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


class WordHashes(dict):
    """64-bit hash of a word, remembered for up to ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


ODD = np.uint64(0x9E3779B97F4A7C15)  # 2**64 over the golden ratio
THREE = np.uint64(3)  # makes a sum of two hashes depend on their order


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; a bijection."""
    x = values * ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; the whole sequence as one run when it is shorter.

    Runs of 1, 2, 4, ... words are hashed from their halves, and those that make up ``k`` are combined.
    """
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    out, at = np.full(n, k, np.uint64), 0
    run, span = hashes, 1
    while True:
        if k & span:
            out = mixed(out * THREE + run[at:at + n])
            at += span
        if at == k:
            return out
        run = mixed(run[:-span] * THREE + run[span:])
        span *= 2


def per_process(key: tuple, make: Callable):
    """What ``make`` returns, kept for the life of this Python worker, which serves many tasks."""
    kept = sys.modules.setdefault("beaconry_worker_state", types.ModuleType("beaconry_worker_state")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
