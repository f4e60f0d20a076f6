"""Passages that repeat across documents, by a sparse suffix array.

Of all suffixes (from a word to the end of its text) only those at minimisers are kept: the smallest
5-word hash of each 12 neighbouring ones, so equal passages keep equal suffixes. A passage of 50 words
holds a kept suffix with 39 of its words from there on and at most 11 before. Suffixes whose first
39 words occur once are left out; the others are sorted across the cluster by these words, their block.
Around a block stand at most 12 windows of 50 words, by how many of these precede it. A window
that two documents have is a passage, whatever the order of the suffixes, and longer passages are
the union of their windows. Every task decides the blocks it holds; those that lie in several are decided
again by their distinct surroundings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beaconry.llm.jaccard import BITS, bit_table
from beaconry.llm.text import WordHashes, mixed, shingle_hashes, small_batches, words
from beaconry.session import persist_table

LEAST = 50  # words of a passage
GRAM, NEAR = 5, 12  # words that choose a minimiser; neighbouring starts it is chosen among
BLOCK = LEAST - NEAR + 1  # words that a kept suffix must share
SIDE = NEAR - 1  # words a passage may have beyond the blocks of its kept suffixes
ANCHOR = "key long, doc_id long, at long, before binary, after binary"
FOUND = "doc_id long, begin long, end long, other long, at long, key long, pattern long, chunk long, before binary, after binary, a long, b long"
HELD = 50_000  # rows of a block that a task decides by itself
NONE = np.iinfo(np.int64).max
NO_ID = np.iinfo(np.int64).min  # stands for a null id, which sorts first


def minimisers(h: np.ndarray) -> np.ndarray:
    """Starts of kept suffixes that have a whole block; ties go to the right."""
    grams = shingle_hashes(h, GRAM)
    if len(h) < LEAST:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams[::-1], NEAR)
    chosen = len(grams) - 1 - np.unique(np.argmin(view, axis=1) + np.arange(len(view)))
    return np.sort(chosen[chosen + BLOCK <= len(h)])


def block_keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    return shingle_hashes(h, BLOCK)[at] if len(at) else np.zeros(0, np.uint64)


def shared_keys(docs: DataFrame) -> np.ndarray:
    """Bit table of blocks that stand at two kept suffixes or more."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            keys = [block_keys(h, minimisers(h)) for h in (hashes.array(words(t)) for t in batch.column(0).to_pylist())]
            if keys:
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    counts = docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return bit_table(counts.where("n > 1").select(F.expr(f"pmod(key, {BITS})").alias("place")))


def anchors(docs: DataFrame, bits) -> DataFrame:
    """Stored kept suffixes of shared blocks with the words around, nearest first, 0 beyond the text."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = hashes.array(words(text))
                at = minimisers(h)
                key = block_keys(h, at)
                place = key % np.uint64(BITS)
                hit = (bits.value[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0
                at, key = at[hit], key[hit]
                if len(at):
                    low = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                    pad = np.concatenate([np.zeros(SIDE, np.uint32), low, np.zeros(SIDE, np.uint32)])
                    steps = np.arange(SIDE)
                    before = pad[at[:, None] + SIDE - 1 - steps]
                    after = pad[at[:, None] + SIDE + BLOCK + steps]
                    out.append((key.view(np.int64), np.full(len(at), NO_ID if doc is None else doc, np.int64), at, before, after))
            if out:
                key, doc, at, before, after = (np.concatenate(c) for c in zip(*out))
                pack = lambda a: pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(4 * SIDE), len(a), [None, pa.py_buffer(np.ascontiguousarray(a).tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(at), pack(before), pack(after)],
                                                 [f.split()[0] for f in ANCHOR.split(", ")])

    return persist_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ANCHOR), "anchors")


def _hashes(key: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each suffix a hash of its block with all the words around, and per number of words before the
    block the hash of that window of LEAST words, and whether the text has it; 0 marks the end of a text."""
    def sums(words_):
        out = [np.zeros(len(words_), np.uint64)]
        for column in words_.T:
            out.append(mixed(out[-1] + column + np.uint64(1)))
        return out

    left, right, block = sums(before), sums(after), mixed(key.view(np.uint64))
    there = lambda n, words_: words_[:, n - 1] != 0 if n else np.ones(len(words_), bool)
    window = [mixed(mixed(block + left[n]) + right[SIDE - n] + np.uint64(n)) for n in range(SIDE + 1)]
    whole = [there(n, before) & there(SIDE - n, after) for n in range(SIDE + 1)]
    return mixed(mixed(block + left[SIDE]) + right[SIDE]), np.stack(window, 1), np.stack(whole, 1)


def _two_smallest(ids: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, place of each entry's id among them, and the two smallest documents of each; NONE if one."""
    order = np.lexsort((docs, ids))
    i, d = ids[order], docs[order]
    new = np.append([True], i[1:] != i[:-1])[:len(i)]
    start = np.flatnonzero(new)
    place = np.empty(len(ids), np.int64)
    place[order] = np.cumsum(new) - 1
    other = np.where(d != d[start][np.cumsum(new) - 1], d, NONE)
    return i[start], place, d[start], np.minimum.reduceat(other, start) if len(start) else other


def match_blocks(rows: DataFrame) -> DataFrame:
    """Suffixes sorted by block -> the span of each that another document has too.

    A chunk of a task's range is decided at once. The rows of a block at its border, which may go on in
    another chunk, also name their chunk and the pattern of words around, and each pattern's words come
    with the two smallest documents met, once per chunk.
    """
    def decide(table, opened, chunk):
        key, doc, at = (table.column(i).to_numpy() for i in range(3))
        before, after = (np.frombuffer(b"".join(table.column(i).to_pylist()), np.uint32).reshape(-1, SIDE) for i in (3, 4))
        left = np.isin(key, np.array(opened, np.int64))
        pattern, window, whole = _hashes(key, before, after)
        patterns, of_row, low, next_ = _two_smallest(pattern, doc)
        one = np.empty(len(patterns), np.int64)  # a row of each pattern
        one[of_row] = np.arange(len(key))
        # Windows of patterns, met in the documents of each.
        p, n = np.nonzero(whole[one])
        met, second = window[one][p, n], next_[p] != NONE
        _, place, least, more = _two_smallest(np.concatenate([met, met[second]]), np.concatenate([low[p], next_[p][second]]))
        place = place[:len(p)]
        ok = more[place] != NONE
        p, n, place = p[ok], n[ok], place[ok]
        longest, shortest = np.full(len(patterns), -1), np.full(len(patterns), SIDE + 1)
        np.maximum.at(longest, p, n)
        np.minimum.at(shortest, p, n)
        found, _, first, then = _two_smallest(np.concatenate([p, p]), np.concatenate([least[place], more[place]]))
        o1, o2 = np.full(len(patterns), NONE), np.full(len(patterns), NONE)
        o1[found], o2[found] = first, then
        hit = longest[of_row] >= 0
        begin, end = np.where(hit, at - longest[of_row], at), np.where(hit, at - shortest[of_row] + LEAST, at)
        other = np.where(doc == o1[of_row], o2[of_row], o1[of_row])
        keep = np.flatnonzero(hit | left)
        shown = np.zeros(len(key), bool)
        shown[one] = left[one]
        shown = shown[keep]
        words_ = [pa.array([v if s else None for v, s in zip(table.column(i).take(pa.array(keep)).to_pylist(), shown)], pa.binary()) for i in (3, 4)]
        two = [pa.array(v[of_row][keep], pa.int64(), mask=~shown | (v[of_row][keep] == NONE)) for v in (low, next_)]
        columns = [pa.array(v[keep]) for v in (doc, begin, end, other, at, key)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(pattern.view(np.int64)[keep]),
                                           pa.array(np.full(len(keep), chunk), mask=~left[keep]), *words_, *two],
                                          [f.split()[0] for f in FOUND.split(", ")])

    def run(batches):
        parts, held, hot = [], 0, None
        chunk = TaskContext.get().partitionId() << 32

        def flush(final):
            nonlocal parts, held, hot
            table = pa.Table.from_batches(parts).combine_chunks()
            key = table.column(0).to_numpy()
            if hot is None:
                hot = int(key[0])
            opened, last = [hot], int(key[-1])
            cut = len(key)
            if final:
                opened.append(last)
            elif last != hot:
                cut = int(np.searchsorted(key, last))
                if len(key) - cut >= HELD:
                    cut, hot = len(key), last
                    opened.append(last)
            rest = table.slice(cut)
            parts, held = rest.to_batches(), rest.num_rows
            return table.slice(0, cut) if cut else None, opened

        for batch in batches:
            if not batch.num_rows:
                continue
            parts.append(batch)
            held += batch.num_rows
            if held >= 2 * HELD:
                table, opened = flush(False)
                if table is not None:
                    yield decide(table, opened, chunk)
                    chunk += 1
        if held:
            yield decide(*flush(True), chunk)

    return rows.mapInArrow(run, FOUND)


def _two_smallest_rows(rows: DataFrame, key: str) -> DataFrame:
    """(key, a, b) repeated -> one row per key with the two smallest documents of all; b null if one."""
    docs = rows.select(key, F.explode(F.array("a", "b")).alias("doc")).where("doc IS NOT NULL").distinct()
    first = docs.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("doc"))).where("place <= 2")
    return first.groupBy(key).agg(F.min("doc").alias("a"), F.max(F.when(F.col("place") == 2, F.col("doc"))).alias("b"))


def open_patterns(found: DataFrame) -> DataFrame:
    """(pattern, longest, shortest, o1, o2): words before the block in the first and last window that two
    documents have, and the two smallest of these, for the patterns of blocks in several chunks."""
    def run(batches):
        for batch in batches:
            key, pattern = (batch.column(i).to_numpy() for i in (0, 1))
            before, after = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, SIDE) for i in (2, 3))
            _, window, whole = _hashes(key, before, after)
            p, n = np.nonzero(whole)
            at = pa.array(p)
            yield pa.RecordBatch.from_arrays([pa.array(pattern[p]), pa.array(window[p, n].view(np.int64)), pa.array(n), batch.column(4).take(at), batch.column(5).take(at)],
                                             ["pattern", "window", "n", "a", "b"])

    borders = found.where("before IS NOT NULL")
    cut = borders.groupBy("key").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).where("lo < hi")
    shown = borders.join(cut, "key", "left_semi").select("key", "pattern", "before", "after", "a", "b")
    windows = persist_table(shown.mapInArrow(run, "pattern long, window long, n long, a long, b long"), "open-windows")
    shared = persist_table(_two_smallest_rows(windows.select("window", "a", "b"), "window").where("b IS NOT NULL"), "shared-windows")
    met = windows.select("pattern", "window", "n").distinct().join(shared, "window")
    return persist_table(met.groupBy("pattern").agg(F.max("n").alias("longest"), F.min("n").alias("shortest")).join(
        _two_smallest_rows(met, "pattern"), "pattern").withColumnsRenamed({"a": "o1", "b": "o2"}), "open-patterns")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Maximal word spans of LEAST words or more that also stand in another document.

    Rows (doc_id, begin, n_words, other_id): ``begin`` counts words from 0, ``other_id`` is the smallest
    document met there. Repeats inside one document do not count. Words are runs of anything but
    ASCII white space, A-Z lower-cased. Null, empty and short texts give nothing; rows without an id
    are one document, whose null sorts first; repeated rows with one id are one document. Further columns are ignored.
    """
    with small_batches(docs.sparkSession, 1000):
        bits = docs.sparkSession.sparkContext.broadcast(shared_keys(docs))
        rows = anchors(docs, bits)
    order = ["key", "doc_id", "at"]
    found = persist_table(match_blocks(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*rows.columns)), "blocks")
    late = open_patterns(found)
    # One join for all rows: those that one chunk decided have no pattern there.
    spans = found.select("doc_id", "begin", "end", "other", "at", "pattern").join(late, "pattern", "left")
    late = lambda a, b: F.when(F.col("longest").isNotNull(), F.expr(a)).otherwise(F.col(b)).alias(b)
    spans = spans.select("doc_id", late("at - longest", "begin"), late(f"at - shortest + {LEAST}", "end"), late("if(doc_id = o1, o2, o1)", "other"))
    spans = spans.where(F.col("end") > F.col("begin"))
    spans = spans.groupBy("doc_id", "begin").agg(F.max("end").alias("end"), F.min("other").alias("other"))
    line = Window.partitionBy("doc_id").orderBy("begin", "end")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("begin") > reach, F.lit(True)).cast("int")
    islands = spans.withColumn("opens", opens).withColumn("island", F.sum("opens").over(line))
    whole = islands.groupBy("doc_id", "island").agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("other").alias("other_id"))
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return whole.select(named("doc_id"), "begin", (F.col("end") - F.col("begin")).alias("n_words"), named("other_id"))
