"""Brown class-based bigrams: P(word | previous word) = P(class | previous class) * P(word | class).

Classes come from exchange clustering. Sequential exchange, which moves one word at a time to the
class that raises the likelihood most, runs over the most frequent words (a fixed number, so their
bigram table is bounded). Every other word of the corpus is then exchanged once, against these
classes, by all its neighbours in the training text. Words seen once share a class with the words
never seen. Words are told apart by 64-bit hashes.

The corpus is cut into chunks of about a million words. Each chunk lists its distinct words with
their counts and neighbour classes; sorted by word, the lists give total counts and classes, which
go back to the chunks that asked. A chunk's documents meet only the words they use: the vocabulary
is never in one place.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.text import WordHashes, crc, small_batches, words
from beaconry.session import persist_table

FOLDS, HELD_OUT = 7, 2
CLASSES, HEAD, SWEEPS = 32, 1024, 8
RARE, END = CLASSES, CLASSES + 1  # of words seen once or never; of the end of a text
REST = CLASSES  # while clustering: a neighbour outside the head
CHUNK = 1_000_000  # words
PARTIAL = 200_000  # distinct words that a task counts before it hands their counts on
PACK = 1 << 24  # code * PACK + count


def head_words(docs: DataFrame) -> tuple[list[bytes], int]:
    """The most frequent training words, all of them counted, and the training tokens."""
    def run(batches):
        kinds = [pa.binary(), pa.int64()]
        counts, tokens = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = words(text)
                counts.update(own)
                tokens += len(own) + 1
                if len(counts) > PARTIAL:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((counts.keys(), counts.values()), kinds)], ["word", "n"])
                    counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([None, *counts], [tokens, *counts.values()]), kinds)], ["word", "n"])

    sums = docs.where("NOT held_out").select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = sums.orderBy(F.asc_nulls_first(F.when(F.col("word").isNotNull(), True)), F.desc("n"), "word").limit(HEAD + 1).collect()  # tokens first
    tokens = next((r["n"] for r in top if r["word"] is None), 0)
    return [bytes(r["word"]) for r in top if r["word"] is not None], tokens


def head_bigrams(docs: DataFrame, head: list[bytes]) -> np.ndarray:
    """Counts of neighbours among the head's words, the rest (HEAD) and the end (HEAD + 1)."""
    ids = {w: i for i, w in enumerate(head)}
    side = HEAD + 2

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            line = [HEAD + 1]
            for text in batch.column(0).to_pylist():
                line += [ids.get(w, HEAD) for w in words(text)]
                line.append(HEAD + 1)
            a = np.array(line, np.int64)
            total += np.bincount(a[:-1] * side + a[1:], minlength=side * side)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])

    rows = (docs.where("NOT held_out").select("text").mapInArrow(run, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())  # at most side * side rows
    out = np.zeros(side * side)
    out[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy()
    return out.reshape(side, side)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, n: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each of the first ``n`` words; the rest and the end keep classes of their own.

    Raises sum N(c,d) log N(c,d) - sum N(c) log N(c) - sum N(d) log N(d) with every move; stops when a
    sweep moves nothing.
    """
    size = classes + 2
    of = np.concatenate([np.arange(n) % classes, [classes, classes + 1]])
    keep = np.concatenate([np.arange(n), [len(bigrams) - 2, len(bigrams) - 1]])
    b = bigrams[np.ix_(keep, keep)]
    onehot = np.zeros((n + 2, size))
    onehot[np.arange(n + 2), of] = 1
    table = onehot.T @ b @ onehot
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            own = b[w, w]
            right, left = b[w] @ onehot, b[:, w] @ onehot
            a = of[w]
            right[a] -= own
            left[a] -= own
            base = table.copy()  # without w
            base[a] -= right
            base[:, a] -= left
            base[a, a] -= own
            rows, cols = base.sum(1), base.sum(0)
            # What row and column k gain when w joins class k; the cell (k, k) gains both and w's own pairs.
            k = np.arange(classes)
            gain = (_xlogx(base[:classes] + right) - _xlogx(base[:classes])).sum(1)
            gain += (_xlogx(base[:, :classes] + left[:, None]) - _xlogx(base[:, :classes])).sum(0)
            d = base[k, k]
            gain += (_xlogx(d + right[k] + left[k] + own) - _xlogx(d + right[k]) - _xlogx(d + left[k]) + _xlogx(d))
            gain -= _xlogx(rows[:classes] + right.sum() + own) - _xlogx(rows[:classes])
            gain -= _xlogx(cols[:classes] + left.sum() + own) - _xlogx(cols[:classes])
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            moved += best != a
            onehot[w] = 0
            onehot[w, best] = 1
            of[w] = best
            base[best] += right
            base[:, best] += left
            base[best, best] += own
            table = base
        if not moved:
            break
    return of


def context_scores(bigrams: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Log-likelihood of class k beside a neighbour: rows 2*c for a left, 2*c+1 for a right neighbour of class c."""
    keep = np.concatenate([np.arange(n), [len(bigrams) - 2, len(bigrams) - 1]])
    onehot = np.zeros((n + 2, CLASSES + 2))
    onehot[np.arange(n + 2), of] = 1
    table = onehot.T @ bigrams[np.ix_(keep, keep)] @ onehot + 0.1
    scores = np.zeros((2 * (CLASSES + 2), CLASSES), np.float32)
    of_left = np.log(table / table.sum(1, keepdims=True))  # log P(class | left class)
    scores[0::2] = of_left[:, :CLASSES] - np.log(table.sum(0) / table.sum())[:CLASSES]
    scores[1::2] = of_left[:CLASSES].T  # log P(right class | class)
    return scores


def _chunked(batches, hashes, text_at: int):
    """(chunk, row of the batch, word hashes): chunks follow the rows of a task, CHUNK words each."""
    part, seen = TaskContext.get().partitionId() << 24, 0
    for batch in batches:
        for i, text in enumerate(batch.column(text_at).to_pylist()):
            own = words(text)
            yield part + seen // CHUNK, batch, i, hashes.array(own) if hashes is not None else len(own)
            seen += len(own)


LISTS = "chunk long, h long, n int, codes array<int>"


def word_lists(docs: DataFrame, head: dict[int, int]) -> DataFrame:
    """Per chunk and distinct word: its training count and the classes around it."""
    known = np.array(sorted(head), np.uint64)
    class_of = np.array([head[int(k)] for k in known], np.int64)

    def listed(chunk, held, arrays):
        lengths = np.array([len(a) for a in arrays])
        h = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
        trained = np.repeat(~np.array(held), lengths)
        distinct, inverse = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
        distinct_class = np.where(known[at] == distinct, class_of[at], REST) if len(known) else np.full(len(distinct), REST)
        cls = distinct_class[inverse]
        ends = np.cumsum(lengths[lengths > 0])
        left, right = np.append([END], cls[:-1]), np.append(cls[1:], [END])
        left[ends[:-1]] = END
        right[ends - 1] = END
        inverse = inverse[trained]
        count = np.bincount(inverse, minlength=len(distinct))
        width = 2 * (CLASSES + 2)
        pair, times = np.unique(np.concatenate([inverse * width + 2 * left[trained], inverse * width + 2 * right[trained] + 1]),
                                return_counts=True)
        offsets = np.searchsorted(pair, np.arange(len(distinct) + 1) * width)
        codes = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array((pair % width * PACK + times).astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), chunk)), pa.array(distinct.view(np.int64)),
                                           pa.array(count.astype(np.int32)), codes], ["chunk", "h", "n", "codes"])

    def run(batches):
        hashes, now, held, arrays = WordHashes(), None, [], []
        for chunk, batch, i, h in _chunked(batches, hashes, 1):
            if chunk != now and sum(map(len, arrays)):
                yield listed(now, held, arrays)
            if chunk != now:
                now, held, arrays = chunk, [], []
            held.append(batch.column(0)[i].as_py())
            arrays.append(h)
        if sum(map(len, arrays)):
            yield listed(now, held, arrays)

    return docs.select("held_out", "text").mapInArrow(run, LISTS)


def word_classes(lists: DataFrame, scores: np.ndarray, head: dict[int, int]) -> DataFrame:
    """Each listed word with its total training count and class, for each chunk; plus sums per class.

    Rows of negative chunk are sums of one task: h the class, n its tokens, cls its distinct words.
    """
    def run(batches):
        part, sums, carry = TaskContext.get().partitionId(), np.zeros((CLASSES + 1, 2), np.int64), None

        def settle(h, n, chunks, rows_of, score):
            cls = np.where(n > 1, np.argmax(score, axis=1), RARE)
            for i in np.flatnonzero(n > 1):
                cls[i] = head.get(int(h[i]), cls[i])
            seen = n > 0
            np.add.at(sums[:, 0], cls[seen], n[seen])
            np.add.at(sums[:, 1], cls[seen], 1)
            return pa.RecordBatch.from_arrays([pa.array(chunks), pa.array(np.repeat(h, rows_of).view(np.int64)),
                                               pa.array(np.repeat(n, rows_of)), pa.array(np.repeat(cls, rows_of).astype(np.int64))],
                                              ["chunk", "h", "n", "cls"])

        for batch in batches:
            chunks = batch.column(0).to_numpy()
            h = batch.column(1).to_numpy().view(np.uint64)
            n = batch.column(2).to_numpy().astype(np.int64)
            lists_ = batch.column(3)
            flat, offsets = lists_.flatten().to_numpy(), lists_.offsets.to_numpy().astype(np.int64)
            offsets = offsets - offsets[0]
            score = np.zeros((len(h), CLASSES), np.float32)
            full = np.flatnonzero(np.diff(offsets) > 0)
            step = 200_000  # codes at a time
            for lo in range(0, len(full), step // 4):
                some = full[lo:lo + step // 4]
                own = flat[offsets[some[0]]:offsets[some[-1] + 1]]
                score[some] = np.add.reduceat(scores[own // PACK] * (own % PACK)[:, None].astype(np.float32),
                                              offsets[some] - offsets[some[0]], axis=0)
            if carry is not None:
                chunks, h, n, score = (np.concatenate([a, b]) for a, b in zip(carry, (chunks, h, n, score)))
            starts = np.flatnonzero(np.append([True], h[1:] != h[:-1]))
            last = starts[-1]
            carry = chunks[last:], h[last:], n[last:], score[last:]
            if last:
                starts = starts[:-1]
                yield settle(h[starts], np.add.reduceat(n[:last], starts), chunks[:last], np.diff(np.append(starts, last)),
                             np.add.reduceat(score[:last], starts, axis=0))
        if carry is not None:
            yield settle(carry[1][:1], carry[2].sum(keepdims=True), carry[0], np.array([len(carry[0])]), carry[3].sum(0, keepdims=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(CLASSES + 1, -1 - part % 16, np.int64)), pa.array(np.arange(CLASSES + 1)),
                                              pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["chunk", "h", "n", "cls"])

    return lists.repartition("h").sortWithinPartitions("h").mapInArrow(run, "chunk long, h long, n long, cls long")


CODED = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, classes binary, cls long, n long, types long"


def code_documents(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Per document its classes in order and the sum of log10(count + 1); sums per class pass through."""
    def tag(batches):
        now, rows = None, []
        for chunk, batch, i, _ in _chunked(batches, None, 2):
            if batch is not now:
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *now.columns], ["chunk", "doc_id", "held_out", "text"])
                now, rows = batch, []
            rows.append(chunk)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *now.columns], ["chunk", "doc_id", "held_out", "text"])

    tagged = docs.select("doc_id", "held_out", "text").mapInArrow(tag, "chunk long, doc_id long, held_out boolean, text string")
    none = lambda kind: F.lit(None).cast(kind)
    # The documents come first in the union, so their tasks have the numbers they had in word_lists.
    both = tagged.select("chunk", F.lit(True).alias("is_doc"), none("long").alias("h"), none("long").alias("n"), none("long").alias("cls"),
                         "doc_id", "held_out", "text").unionByName(
        classes.select("chunk", F.lit(False).alias("is_doc"), "h", "n", "cls", none("long").alias("doc_id"),
                       none("boolean").alias("held_out"), none("string").alias("text")))

    def run(batches):
        hashes, now = WordHashes(), None
        parts, table = [], None
        for batch in batches:
            chunk, is_doc = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            sums, out = [], []
            edges = np.flatnonzero((chunk[1:] != chunk[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
            for lo, hi in zip(np.append([0], edges), np.append(edges, [len(chunk)])):
                own = batch.slice(lo, hi - lo)
                if chunk[lo] < 0:
                    sums += zip(*(own.column(i).to_pylist() for i in (2, 3, 4)))
                    continue
                if chunk[lo] != now:
                    now, parts, table = chunk[lo], [], None
                if not is_doc[lo]:
                    parts.append([own.column(i).to_numpy() for i in (2, 3, 4)])
                    continue
                if table is None:
                    h, n, cls = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
                    order = np.argsort(h.view(np.uint64))
                    table, parts = (h.view(np.uint64)[order], n[order], cls[order].astype(np.uint8)), []
                for doc, held, text in zip(*(own.column(i).to_pylist() for i in (5, 6, 7))):
                    h = hashes.array(words(text))
                    at = np.searchsorted(table[0], h)
                    if len(h) and (not len(table[0]) or (table[0][np.minimum(at, len(table[0]) - 1)] != h).any()):
                        raise RuntimeError("the documents were read in another order the second time: store them first")
                    n = table[1][at]
                    out.append((doc, held, len(h) + 1, int((n > 0).sum()), float(np.log10(n + 1.0).sum()), table[2][at].tobytes()))
            rows = [(*o, None, None, None) for o in out] + [(None, None, None, None, None, None, *map(int, s)) for s in sums]
            if rows:
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 [f.split()[0] for f in CODED.split(", ")])

    return both.repartition("chunk").sortWithinPartitions("chunk", "is_doc").mapInArrow(run, CODED)


def transitions(coded: DataFrame) -> np.ndarray:
    """Class pairs of the training documents, each beginning and ending with END."""
    side = CLASSES + 2

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            line = np.frombuffer(bytes([END]) + b"".join(c + bytes([END]) for c in batch.column(0).to_pylist()), np.uint8).astype(np.int64)
            total += np.bincount(line[:-1] * side + line[1:], minlength=side * side)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(side * side)), pa.array(total)], ["cell", "n"])

    rows = (coded.where("NOT held_out").select("classes").mapInArrow(run, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(side * side)
    out[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy()
    return out.reshape(side, side)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` is a stored table: it is read several times in the same order (checked). Null and
    empty texts are one end token. A null id counts as a training document. Ties in frequency are
    broken by the word. Without training documents every word is unknown. Further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc(F.col("doc_id")) % FOLDS == HELD_OUT).alias("held_out"), "text")
    with small_batches(docs.sparkSession, 1000):
        return _score(docs)


def _score(docs: DataFrame) -> DataFrame:
    head, tokens = head_words(docs)
    bigrams = head_bigrams(docs, head)
    of = exchange(bigrams, len(head))
    hashes = WordHashes()
    head_class = {hashes[w]: int(c) for w, c in zip(head, of)}
    classes = word_classes(word_lists(docs, head_class), context_scores(bigrams, of, len(head)), head_class)
    coded = persist_table(code_documents(docs, classes), "brown-coded")

    sums = np.zeros((CLASSES + 2, 2))
    for r in coded.where("cls IS NOT NULL").groupBy("cls").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).collect():
        sums[r["cls"]] = r["n"], r["types"]
    texts = coded.where("cls IS NULL")
    pairs = transitions(texts)
    ends = texts.where("NOT held_out").count()
    vocabulary = int(sums[:, 1].sum()) + (ends > 0)
    base_log = np.log10(tokens + 1.0 * (vocabulary + 1))
    prior = (pairs.sum(0) + 1) / (pairs.sum() + CLASSES + 2)
    move = np.log10((pairs + CLASSES * prior) / (pairs.sum(1, keepdims=True) + CLASSES)).ravel()
    size = np.maximum(sums.sum(1) + (np.arange(CLASSES + 2) == RARE), 1)  # add one to each word, and one unknown word
    emit = np.log10(size)
    emit[END] = 0

    def run(batches):
        side = CLASSES + 2
        for batch in batches:
            doc, held, n, known, logs, classes_ = (batch.column(i) for i in range(6))
            score = np.empty(batch.num_rows)
            for i, own in enumerate(classes_.to_pylist()):
                line = np.frombuffer(bytes([END]) + own + bytes([END]), np.uint8).astype(np.int64)
                score[i] = move[line[:-1] * side + line[1:]].sum() - emit[line[1:]].sum()
            length, logs = n.to_numpy(), logs.to_numpy()
            base = logs + np.log10(ends + 1.0) - length * base_log
            known = known.to_numpy() + (ends > 0)
            yield pa.RecordBatch.from_arrays([doc, held, n, pa.array(known), pa.array(np.full(len(length), tokens, np.int64)),
                                              pa.array(base), pa.array(score + logs)],
                                             ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return texts.select("doc_id", "held_out", "n_tokens", "n_known", "logs", "classes").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
