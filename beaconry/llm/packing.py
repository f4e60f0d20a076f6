"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents are ordered by length across the cluster and known afterwards by (length, rank). A
superstep takes all pieces of one length, longest first, and sweeps the open gaps upwards from
the smallest that fits (the successor): every sequence with that gap takes as many pieces as go
in, ranks decide which piece goes where, and the gap shrinks. What no gap takes opens new
sequences. As equal gaps are alike, a sweep moves whole runs of them, and the result is that of
best-fit-decreasing over single documents. Lengths and gaps have at most ``capacity`` values, so
the table of runs is bounded by the capacity however many documents there are.
"""

from __future__ import annotations

import unicodedata
import zlib
from bisect import bisect_left, insort
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beaconry.llm.text import per_process
from beaconry.session import persist_table

CAPACITY, END_ID = 4096, 1
PIECES = ("doc_id long, piece int, start long, length int, ids_crc32 long, part int, ordinal long")


def byte_letters() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordTokenizer:
    """Ids of whole texts by a `tokenizers` file that drops white space, remembered word by word.

    The file's steps, taken from it: NFC, lower case, its pattern, byte letters, its model. No step
    looks across white space, so each distinct stretch between white space is worked out once and
    remembered (up to ``limit`` of them). Texts that hold the opening of a special token go through
    the library whole.
    """

    def __init__(self, path: str, limit: int = 500_000):
        import json

        import regex
        from tokenizers import Tokenizer
        self.whole, self.limit, self.known, self.pieces = Tokenizer.from_file(path), limit, {}, {}
        self.model = self.whole.model
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        split, level = steps["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in steps["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or level["type"] != "ByteLevel":
            raise ValueError("this tokenizer file has other steps")
        # Unlike here, the file's white space leaves out the separators 1C to 1F.
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(
            r"\s", r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"))
        self.letters = dict(enumerate(byte_letters()))

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= self.limit:
                self.pieces = {}
            spelled = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        return ids

    def _learn(self, word: bytes) -> bytes:
        if len(self.known) >= self.limit:
            self.known = {}
        text = word.decode()
        if not text.isascii():
            text = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
        pieces = [text] if word.isalpha() else self.pattern.findall(text)
        ids = self.known[word] = b"".join(map(self._piece, pieces))
        return ids

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if "<|" in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        known, learn = self.known.get, self._learn
        return b"".join([known(w) or learn(w) for w in text.encode().lower().split()])


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of each document's ids and end id, stored. (part, length, ordinal) names a piece."""
    def run(batches):
        encode = per_process(("word tokenizer", tokenizer), lambda: WordTokenizer(tokenizer))
        part = TaskContext.get().partitionId()
        seen, end = np.zeros(capacity + 1, np.int64), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((doc, piece, at // 4, n, zlib.crc32(own), part, int(seen[n])))
                    seen[n] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 [f.split()[0] for f in PIECES.split(", ")])

    return persist_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES), "pieces")


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, first sequence, pieces per sequence, offset) from pieces per length."""
    gaps: list[int] = []  # gap sizes with open sequences, ascending
    runs: dict[int, deque] = {}  # gap -> runs (first sequence, number)
    plan, opened = [], 0

    def give(gap, first, n):
        if gap and n:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = deque()
            runs[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = runs[gap].popleft()
            else:
                gap, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = gap // length
            for full, per in ((min(n, left // each), each), (1, left % each)):
                if not (full and per and n):
                    continue
                if per < each and left >= each:
                    continue  # the sequences ran out before the pieces did
                plan.append((length, rank, first, per, capacity - gap))
                give(gap - per * length, first, full)
                rank, left, first, n = rank + full * per, left - full * per, first + full, n - full
            if at < len(gaps) or gap != capacity:
                if n:
                    runs[gap].appendleft((first, n))
                if gap in runs and not runs[gap]:
                    del runs[gap]
                    gaps.remove(gap)
    return np.array(sorted(plan), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place stored pieces: adds sequence_id and offset (gapless from 0 in each sequence).

    Ranks within a length are counted per task while cutting and made global by adding up the
    counts of the tasks before, so no task holds a length. Null and empty texts are one end token.
    Ties and repeated rows are pieces like others; an empty table packs into nothing.
    """
    spark = pieces.sparkSession
    per_task = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = persist_table(per_task.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                           "piece-ranks")
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    shared = spark.sparkContext.broadcast(sweep(counts, capacity))

    def place(batches):
        plan = shared.value
        keys = (plan[:, 0] << 44) + plan[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c)).to_numpy(), np.int64) for c in ("length", "rank"))
            run = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            within = rank - plan[run, 1]
            sequence, offset = plan[run, 2] + within // plan[run, 3], plan[run, 4] + within % plan[run, 3] * length
            kept = [batch.column(i) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*kept[:3], pa.array(length), batch.column(4), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(starts.select("part", "length", "before"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("ordinal")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Columns beyond doc_id and text are ignored."""
    return pack(cut(docs, tokenizer or tokenizer_path(), capacity), capacity)
