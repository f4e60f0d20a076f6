"""Phrases whose words keep together: collocations of two to five words, per language.

Top-order marginalisation: each word occurrence gives one row, the window of itself and the words
after it in its piece (its lead columns, padded at the piece's end). Only these longest windows are
counted; a ROLLUP over their columns sums every shorter prefix, which is every shorter phrase.

A phrase of ``least`` occurrences has words, pairs and triples of at least as many. Two bit tables
of a fixed size hold the hashed words and pairs, and the triples of these, that are frequent enough;
a window is padded from the first one on that is not. What shares a bit only makes windows longer,
so the tables bound the work and never the result. Texts are cut into words once: a row of the stored table
has some hundred thousand of them, as a list of distinct words and their numbers in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.text import mixed, small_batches
from beaconry.session import persist_table

LONGEST = 5
LEAST = 100  # occurrences of a candidate
TOP = 2000  # phrases a language returns
SHARE = 100  # a candidate goes if a longer one has this percentage of its occurrences
CHUNK = 200_000  # words in a row of the stored table, about
CELLS = 1 << 25  # bits in a table of frequent words or pairs
BREAK = b"\xff"  # stands in no UTF-8 text
CUTS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")
COLUMNS = [f"w{i}" for i in range(1, LONGEST + 1)]


class Numbers(dict):
    """Numbers words in order of appearance; a break is 0."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def code_words(docs: DataFrame) -> DataFrame:
    """(lang, n, words, codes): consecutive texts of one language; n words, the distinct ones, their numbers in order."""
    def run(batches):
        held, size = {}, 0

        def flush():
            rows = [(lang, int(np.count_nonzero(codes := np.concatenate(parts))), b"\n".join(list(numbers)[1:]), codes.tobytes())
                    for lang, (numbers, parts) in held.items()]
            held.clear()
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["lang", "n", "words", "codes"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().translate(CUTS)
                tokens = raw.replace(BREAK, b" \xff ").split()
                if not tokens:
                    continue
                numbers, parts = held.setdefault(lang, (Numbers(), []))
                parts.append(np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens)))
                parts.append(np.zeros(1, np.int32))
                size += len(tokens)
                if size >= CHUNK:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(
        run, "lang string, n long, words binary, codes binary")


def _rows(batches):
    """(lang, distinct words, their hashes with the language, codes) of each stored row; number 0 is the break."""
    for batch in batches:
        for lang, words, codes in zip(*(batch.column(i) for i in range(3))):
            lang, words = lang.as_py(), words.as_py().split(b"\n")
            seed = xxhash.xxh3_64_intdigest(lang.encode())
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
            yield lang, words, np.append(np.zeros(1, np.uint64), hashes), np.frombuffer(codes.as_py(), np.int32)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.int64)


def _counted(cells: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cells.astype(np.uint32).view(np.int32)), pa.array(times.astype(np.int64))], ["cell", "n"])


def _set(table: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Whether the bit of each cell is set."""
    bit = cells % CELLS
    return (table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _pairs(codes: np.ndarray):
    """Places of words that another one follows, and the number of the pair there."""
    at = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
    return at, codes[at].astype(np.int64) << 32 | codes[at + 1]


def _pair_hash(hashes: np.ndarray, pair: np.ndarray) -> np.ndarray:
    return mixed(mixed(hashes[pair >> 32]) + hashes[pair & 0xFFFFFFFF])


def short_cells(coded: DataFrame) -> DataFrame:
    """Cells of words and of pairs, with what they count."""
    def run(batches):
        for _, _, hashes, codes in _rows(batches):
            yield _counted(_cells(hashes[1:]), np.bincount(codes, minlength=len(hashes))[1:])
            pair, times = np.unique(_pairs(codes)[1], return_counts=True)
            if len(pair):
                yield _counted(_cells(_pair_hash(hashes, pair)), times)

    return coded.select("lang", "words", "codes").mapInArrow(run, "cell int, n long")


def _marks(hashes: np.ndarray, codes: np.ndarray, frequent: np.ndarray):
    """Per place: is its word frequent, is the pair from here, and the hash of that pair."""
    word = _set(frequent, _cells(hashes))
    word[0] = False
    at, pair = _pairs(codes)
    pairs, value = np.zeros(len(codes) + LONGEST, bool), np.zeros(len(codes) + LONGEST, np.uint64)
    value[at] = _pair_hash(hashes, pair)
    pairs[at] = _set(frequent, _cells(value[at])) & word[codes[at]] & word[codes[at + 1]]
    return word[codes], pairs, value


def _triples(hashes: np.ndarray, codes: np.ndarray, pairs: np.ndarray, value: np.ndarray):
    """Places of three words of which both pairs are frequent, and their hash."""
    at = np.flatnonzero(pairs[:-1] & pairs[1:])
    return at, mixed(value[at] * np.uint64(3) + hashes[codes[at + 2]])


def triple_cells(coded: DataFrame, frequent) -> DataFrame:
    def run(batches):
        for _, _, hashes, codes in _rows(batches):
            _, pairs, value = _marks(hashes, codes, frequent.value)
            found, times = np.unique(_triples(hashes, codes, pairs, value)[1], return_counts=True)
            if len(found):
                yield _counted(_cells(found), times)

    return coded.select("lang", "words", "codes").mapInArrow(run, "cell int, n long")


def bit_table(cells: DataFrame, least: int):
    """Broadcast table of CELLS bits: those of the cells that count ``least`` or more. Bytes of it are made by Spark."""
    bits = (cells.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
            .select(F.expr(f"pmod(cell, {CELLS})").alias("bit")))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("bits"))
    got = words.toArrow()  # at most CELLS / 64 rows
    table = np.zeros(CELLS // 64, np.uint64)
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return cells.sparkSession.sparkContext.broadcast(table.view(np.uint8))


def windows(coded: DataFrame, frequent, frequent_triples) -> DataFrame:
    """(lang, w1..w5, n): the longest windows, padded with null, counted per stored row."""
    def run(batches):
        for lang, words, hashes, codes in _rows(batches):
            word, pairs, value = _marks(hashes, codes, frequent.value)
            starts = np.flatnonzero(word)
            if not len(starts):
                continue
            at, found = _triples(hashes, codes, pairs, value)
            triples = np.zeros(len(codes) + LONGEST, bool)
            triples[at] = _set(frequent_triples.value, _cells(found))
            padded = np.append(codes, np.zeros(LONGEST, np.int32))
            lead, alive = [codes[starts]], np.ones(len(starts), bool)
            for i in range(1, LONGEST):
                alive = alive & (pairs[starts] if i == 1 else triples[starts + i - 2])
                lead.append(np.where(alive, padded[starts + i], 0))
            group = lead[0].astype(np.int64)
            for column in lead[1:]:  # number the distinct prefixes, one word longer each time
                _, group = np.unique(group * len(hashes) + column, return_inverse=True)
            _, shown, times = np.unique(group, return_index=True, return_counts=True)
            spelled = pa.array([None, *words], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(shown)), *(spelled.take(pa.array(c[shown])).cast(pa.string()) for c in lead), pa.array(times.astype(np.int64))],
                ["lang", *COLUMNS, "n"])

    return coded.select("lang", "words", "codes").mapInArrow(run, f"lang string, {', '.join(c + ' string' for c in COLUMNS)}, n long")


def phrase_counts(longest: DataFrame, least: int) -> DataFrame:
    """(lang, size, phrase, a) of each phrase of one to five words that occurs ``least`` times."""
    whole = longest.groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    # The language is in the ROLLUP too, so a level is told by its grouping id: 2^(5-k) - 1 for k words.
    rolled = whole.rollup("lang", *COLUMNS).agg(F.sum("n").alias("a"), F.grouping_id().alias("level")).where(F.col("a") >= least)
    level = F.col("level")
    own = F.coalesce(*[F.when((level == (1 << (LONGEST - k)) - 1) & F.col(f"w{k}").isNotNull(), F.lit(k)) for k in range(1, LONGEST + 1)])
    return rolled.select("lang", own.alias("size"), F.concat_ws(" ", *COLUMNS).alias("phrase"), "a").where("size IS NOT NULL")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, size, phrase, a, l, r, n, score) by the lowest-scoring cut; decimals hold products up to 38 digits."""
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("times"))
    cuts = (counts.where("size > 1").withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
            .withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)")))
    cuts = (cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("times").alias("l")), ["lang", "first"])
            .join(parts.select("lang", F.col("part").alias("rest"), F.col("times").alias("r")), ["lang", "rest"]).join(totals, "lang"))
    cuts = cuts.withColumn("score", F.expr("CAST(1000 * a AS DECIMAL(38, 0)) * CAST(n AS DECIMAL(38, 0)) div (CAST(l AS DECIMAL(38, 0)) * CAST(r AS DECIMAL(38, 0)))"))
    best = cuts.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "size", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def uncovered(candidates: DataFrame, share: int) -> DataFrame:
    """Candidates inside no longer one that has ``share`` percent of their occurrences.

    If a longer phrase has that many, so has each phrase between the two, and that is a candidate: it is
    enough to look at those one word longer.
    """
    inside = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    covers = candidates.where("size > 2").select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("longer"))
    covers = covers.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return candidates.join(covers, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {share} * a").drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP, share: int = SHARE) -> DataFrame:
    """Per language the first ``top`` phrases (all if None): lang, rank, phrase, a, l, r, n, score.

    Null texts and texts without words count nothing; a null language is `und`, together with
    documents marked so. Repeated rows count as often as they stand. Phrases that tie in score and
    in a are ranked by their UTF-8 bytes. Further columns are never read. An empty table gives an
    empty result.
    """
    with small_batches(docs.sparkSession, 500):
        coded = persist_table(code_words(docs), "phrase-words")
    with small_batches(docs.sparkSession, 4):  # its rows are long
        frequent = bit_table(short_cells(coded), least)
        triples = bit_table(triple_cells(coded, frequent), least)
        counts = persist_table(phrase_counts(windows(coded, frequent, triples), least), "phrase-counts")
    totals = coded.groupBy("lang").agg(F.sum("n").alias("n"))
    found = uncovered(scored(counts, totals), share)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


_LEADS = ", ".join(f"lead(w1, {i}) OVER p AS w{i + 1}" for i in range(1, LONGEST))
_SIZES = " UNION ALL ".join(
    f"SELECT lang, {k} AS size, concat_ws(' ', {', '.join(COLUMNS[:k])}) AS phrase, count(*) AS a FROM leads "
    f"WHERE w{k} IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}" for k in range(1, LONGEST + 1))

SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, part FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[.,;:!?\\x0A-\\x0D]')) AS part FROM documents WHERE text IS NOT NULL)),
tokens AS (SELECT lang, piece, unnest(ws) AS w1, generate_subscripts(ws, 1) AS place FROM (
  SELECT lang, piece, list_filter(regexp_split_to_array(part, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces)),
leads AS (SELECT lang, w1, {_LEADS} FROM tokens WINDOW p AS (PARTITION BY piece ORDER BY place)),
totals AS (SELECT lang, count(*) AS n FROM tokens GROUP BY lang),
counts AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS ws, a FROM ({_SIZES})),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, t.n, k, l.a AS l, r.a AS r,
         (1000 * c.a::HUGEINT * t.n) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM counts WHERE size > 1) c JOIN totals t ON t.lang = c.lang
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, size, ' ' || phrase || ' ' AS padded, a FROM counts WHERE size > 2),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM longer g WHERE g.lang = b.lang AND g.size > b.size AND g.a * 100 >= {SHARE} * b.a AND contains(g.padded, ' ' || b.phrase || ' ')))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= {TOP}
"""
