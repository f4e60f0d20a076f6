"""Similarity join of documents by the Jaccard similarity of their word n-grams.

The global order puts n-grams that look frequent last (a fixed-size bit table, filled from counts)
and sorts the rest by hash; any order is exact, this one makes the prefixes of unlike documents
disjoint. Two sets that are similar enough share an n-gram in their prefixes and are of similar size.
Sets without such a partner are done. Of the others the n-grams are counted exactly: those that only
one of them has are dropped, as they are in no overlap, and a set that has too few others to be linked
goes with them. Counts among these sets order what is left anew, and its prefixes make the lists. This
order is cut into fragments; overlaps of a candidate pair are counted fragment by fragment and summed.

Only links between different sets matter, and of these only enough to connect what is connected,
so a crowd of near copies is not spelled out in pairs. A prefix n-gram in a short list gives all
pairs of the list. In a long list one set, the one whose n-grams are met most often, so near the middle
of a crowd, is compared with each other one. Two sets that are similar to it are connected already. For any
other pair x, y the overlap is at most min(|x & leader|, |y & leader|) plus what they share outside the
leader, so either they share an n-gram outside it (these residual n-grams make the lists of the next
level), or both are so close to the leader that the bound allows it by itself (a narrow band, which needs
a y smaller than the leader). A set that is in the leader's component by now only has to meet those that
are not. The last level lists all pairs that are left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.llm.components import components
from beaconry.llm.text import WordHashes, mixed, shingle_hashes, small_batches, words
from beaconry.session import persist_table, scratch

WORDS, PERCENT = 5, 80
SHORT = 12  # sets in a list whose pairs are all compared
BITS = 1 << 26
COMMON = (2, 8, 64)  # from so many sets on an n-gram is of the next rank of the order
LEVELS = 12
BATCH = 500  # texts or pairs of sets in memory at once


class Rule:
    """Sets of n-grams of ``words`` words are linked from ``percent`` per cent Jaccard on."""

    def __init__(self, words_: int = WORDS, percent: int = PERCENT):
        self.words, self.percent = words_, percent

    def least(self, n):
        """Smallest overlap that a set of n needs with any partner."""
        return -(-n * self.percent // 100)

    def prefix(self, n):
        """So many n-grams of a set of n hold one of any partner."""
        return n - self.least(n) + 1

    def need(self, n: str, m: str) -> Column:
        """Smallest overlap that links sets of n and m."""
        return F.expr(f"({self.percent} * ({n} + {m}) + {99 + self.percent}) div {100 + self.percent}")

    def close(self, n: str, m: str) -> Column:
        return F.expr(f"100 * least({n}, {m}) >= {self.percent} * greatest({n}, {m})")


def shingles(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct n-gram hashes; the whole text as one n-gram when it has fewer words."""
    return np.unique(shingle_hashes(hashes.array(words(text)), k))


def common_bits(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Bit table of n-grams met twice or more among the smallest hashes of the texts.

    Half as many again as a prefix has are counted, so that a prefix without common ones has counted ones in their place.
    """
    k = rule.words

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            low = [s[:-(-3 * rule.prefix(len(s)) // 2)] for s in (shingles(t, k, hashes) for t in batch.column(0).to_pylist()) if len(s)]
            if low:
                t, n = np.unique(np.concatenate(low), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n)], ["t", "n"])

    counts = docs.select("text").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    return bit_table(counts.where("n > 1").select(F.expr(f"pmod(t, {BITS})").alias("place")))


def bit_table(places: DataFrame) -> np.ndarray:
    """32-bit words with the bits at the given places set.

    Tasks build pieces of 2**16 bits, so the driver gets BITS / 8 bytes in a few rows, whatever the data.
    """
    span = min(BITS, 1 << 16)

    def run(batches):
        pieces = {}
        for batch in batches:
            place = batch.column(0).to_numpy()
            for at in np.unique(place // span):
                piece = pieces.setdefault(int(at), np.zeros(span, bool))
                piece[place[place // span == at] % span] = True
        if pieces:
            yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int64()),
                                              pa.array([np.packbits(p, bitorder="little").tobytes() for p in pieces.values()], pa.binary())],
                                             ["at", "bits"])

    spread = places.repartition(F.expr(f"place div {span}")).mapInArrow(run, "at long, bits binary")
    out = np.zeros(BITS // 8, np.uint8)
    for row in spread.toLocalIterator():
        out[row["at"] * span // 8:(row["at"] + 1) * span // 8] |= np.frombuffer(row["bits"], np.uint8)
    return out.view("<u4")


def is_common(bits: np.ndarray, t: np.ndarray) -> np.ndarray:
    place = t % np.uint64(BITS)
    return (bits[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def class_number(d: bytes) -> int:
    """Number of a class of equal sets: 64 bits of its digest, so texts and pairs agree on it without a join."""
    return int.from_bytes(d[:8], "little", signed=True)


def set_table(docs: DataFrame, bits, rule: Rule) -> DataFrame:
    """Per document its set's size, digest and prefix."""
    k = rule.words

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            n, digests, numbers, prefixes = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, k, hashes)
                n.append(len(s))
                digests.append(digest(s))
                numbers.append(class_number(digests[-1]))
                common = is_common(bits.value, s)
                ordered = np.concatenate([s[~common], s[common]])
                prefixes.append(ordered[:rule.prefix(len(s)) if len(s) else 0].view(np.int64))
            lengths = np.cumsum([0] + [len(p) for p in prefixes]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(digests, pa.binary()), pa.array(numbers, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))],
                                             ["doc_id", "n", "d", "c", "prefix"])

    return persist_table(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n int, d binary, c long, prefix array<long>"), "sets")


def with_partners(sets: DataFrame, rule: Rule) -> DataFrame:
    """Stored classes (c) that share a prefix n-gram with another class of a similar size.

    Sorted by size, the next one up or down in a list is the most similar in size.
    """
    def run(batches):
        last = None
        for batch in batches:
            key, n, c = (batch.column(i).to_numpy() for i in range(3))
            if last is not None:
                key, n, c = (np.concatenate([x, y]) for x, y in zip(last, (key, n, c)))
            last = [x[-1:] for x in (key, n, c)]
            near = (key[1:] == key[:-1]) & (c[1:] != c[:-1]) & (100 * n[:-1].astype(np.int64) >= rule.percent * n[1:].astype(np.int64))
            found = np.unique(np.concatenate([c[1:][near], c[:-1][near]]))
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["c"])

    entries = sets.where("n > 0").select(F.explode("prefix").alias("key"), "n", "c")
    near = entries.repartition("key").sortWithinPartitions("key", "n", "c").mapInArrow(run, "c long")
    return persist_table(near.distinct(), "with-partners")


def _id_place(ids: pa.Array) -> np.ndarray:
    return mixed(ids.fill_null(0).to_numpy().view(np.uint64)) % np.uint64(BITS)


def segments(docs: DataFrame, needed: DataFrame, rule: Rule) -> DataFrame:
    """(c, tokens): whole sets of the needed classes (rep).

    A bit table of the needed representatives' ids spares most texts the work. It lets some others pass:
    classes without a partner, and texts that stand twice under an id, as their segments then do.
    """
    k = rule.words

    def mark(batches):
        for batch in batches:
            place = np.unique(_id_place(batch.column(0))) if batch.num_rows else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(place.view(np.int64))], ["place"])

    wanted = bit_table(needed.select("rep").mapInArrow(mark, "place long"))
    wanted = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            if not batch.num_rows:
                continue
            hit = is_common(wanted.value, _id_place(batch.column(0)))
            sets = [s for s in (shingles(t, k, hashes) for t in batch.column(1).filter(pa.array(hit)).to_pylist()) if len(s)]
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array([class_number(digest(s)) for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["c", "tokens"])

    with small_batches(docs.sparkSession, BATCH):
        found = persist_table(docs.select("doc_id", "text").mapInArrow(run, "c long, tokens binary"), "segments")
    wanted.destroy()
    return found


def rank_tables(whole: DataFrame) -> list[np.ndarray]:
    """A bit table for each of ``COMMON``: n-grams that so many sets have."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                t, n = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in batch.column(0).to_pylist()]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n)], ["t", "n"])

    with small_batches(whole.sparkSession, BATCH):
        counts = whole.select("tokens").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
        counts = persist_table(counts.where(F.col("n") >= COMMON[0]).select(F.expr(f"pmod(t, {BITS})").alias("place"), "n"), "gram-counts")
    return [bit_table(counts.where(F.col("n") >= least).select("place")) for least in COMMON]


def shared_parts(whole: DataFrame, ranks, rule: Rule) -> DataFrame:
    """Stored (c, n, p, w, f, tokens, prefix): what sets have in common with others, by fragment of the order.

    ``p`` is the length of the whole prefix, ``prefix`` its part of the fragment, ``w`` the mean rank of the n-grams.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for c, tokens in zip(*(batch.column(i).to_pylist() for i in range(2))):
                s = np.frombuffer(tokens, np.uint64)
                rank = sum(is_common(table, s).astype(np.int64) for table in ranks.value)
                n, left = len(s), int((rank > 0).sum()) - rule.least(len(s)) + 1
                if left <= 0:
                    continue
                fragment, p, w = 2 * rank + (s >> np.uint64(63)).astype(np.int64), left, float(rank.mean())
                for f in np.unique(fragment[rank > 0]):
                    part = s[fragment == f]
                    rows.append((c, n, p, w, int(f), part.tobytes(), part[:max(left, 0)].view(np.int64)))
                    left -= len(part)
            if rows:
                *plain, prefixes = zip(*rows)
                offsets = np.cumsum([0] + [len(x) for x in prefixes]).astype(np.int32)
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([*(pa.array(x, kind) for x, kind in zip(plain, kinds)),
                                                  pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes)))],
                                                 ["c", "n", "p", "w", "f", "tokens", "prefix"])

    with small_batches(whole.sparkSession, BATCH):
        return persist_table(whole.mapInArrow(run, "c long, n int, p int, w double, f int, tokens binary, prefix array<long>"), "parts", keep=True)


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Stored (a, b, f, o, m, rest) per fragment: overlap, size of b there, and for star pairs b without a,
    of which no more is stored than the prefix that meets any set similar to b (p)."""
    def run(batches):
        for batch in batches:
            o, m, rests = [], [], []
            for star, p, ta, tb in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 6))):
                a, b = np.frombuffer(ta or b"", np.uint64), np.frombuffer(tb, np.uint64)
                at = np.searchsorted(a, b)
                same = a[np.minimum(at, len(a) - 1)] == b if len(a) else np.zeros(len(b), bool)
                o.append(int(same.sum()))
                m.append(len(b))
                rests.append(b[~same][:p].view(np.int64) if star else np.zeros(0, np.int64))
            offsets = np.cumsum([0] + [len(r) for r in rests]).astype(np.int32)
            flat = np.concatenate(rests) if rests else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(o, pa.int32()), pa.array(m, pa.int32()),
                                              pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                             ["a", "b", "f", "o", "m", "rest"])

    of_b = pairs.select("a", "b", "p", "star").join(parts.select(F.col("c").alias("b"), "f", F.col("tokens").alias("tb")), "b")
    of_a = parts.select(F.col("c").alias("a"), "f", F.col("tokens").alias("ta"))
    both = of_b.join(of_a, ["a", "f"], "left").select("a", "b", "f", "star", "p", "ta", "tb")
    with small_batches(pairs.sparkSession, BATCH):
        return persist_table(both.mapInArrow(run, "a long, b long, f int, o int, m int, rest array<long>"), "overlaps")


def _with_component(entries: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return entries.withColumn("comp", F.col("c"))
    named = entries.join(roots.select(F.col("node").alias("c"), "root"), "c", "left")
    return named.withColumn("comp", F.coalesce("root", "c")).drop("root")


def _lists(entries: DataFrame) -> DataFrame:
    """Stored entries of keys that at least two components share, with the number of entries."""
    counts = entries.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    shared = persist_table(counts.where("lo <> hi").select("key", "k"), "keys")
    return persist_table(entries.join(shared, "key"), "lists", keep=True)


_PLAIN = ("0 AS p", "0.0D AS w", "false AS star")


def _all_pairs(lists: DataFrame, rule: Rule) -> DataFrame:
    left = lists.select("key", F.col("c").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"))
    right = lists.select("key", F.col("c").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"))
    pairs = left.join(right, "key").where("a < b AND ca <> cb").where(rule.close("na", "nb"))
    return pairs.selectExpr("a", "na", "b", "nb", *_PLAIN)


def _star_pairs(lists: DataFrame) -> DataFrame:
    leaders = lists.groupBy("key").agg(F.max(F.struct("w", "c", "n")).alias("l"))
    leaders = persist_table(leaders.select("key", F.col("l.c").alias("a"), F.col("l.n").alias("na")), "leaders")
    return lists.join(leaders, "key").where("c <> a").select("a", "na", F.col("c").alias("b"), F.col("n").alias("nb"), "p", "w", F.lit(True).alias("star"))


def _next_level(star: DataFrame, counted: DataFrame, roots: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Residual entries and band pairs of the star pairs (a, na, b, nb, p, w, o)."""
    for side in "ab":
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"c{side}"))
        star = star.join(named, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    smallest = star.groupBy("a").agg(F.min("nb").alias("s"))
    least = F.expr(f"({rule.percent} * nb + 99) div 100")
    sized = persist_table(
        star.join(smallest, "a").withColumn("joined", F.expr("ca = cb")).withColumn("least", least)
        .withColumn("s", F.least("na", F.greatest("s", "least"))).withColumn("short", rule.need("nb", "s") - F.col("o")), "sized")
    # A pair needs the larger t of both outside the leader, and one of them is not of its component.
    apart = sized.where("NOT joined").groupBy("a").agg(F.min(F.greatest("short", F.lit(1))).alias("apart"))
    members = persist_table(sized.join(apart, "a").withColumn(
        "t", F.greatest("short", F.when(F.col("joined"), F.col("apart")).otherwise(F.lit(1)))), "members")
    # Fragments follow the global order, so a prefix of the residual set is cut fragment by fragment.
    rest = counted.where("size(rest) > 0").groupBy("a", "b", "f").agg(F.first("rest").alias("rest"), F.first(F.col("m") - F.col("o")).alias("k"))
    sizes = rest.groupBy("a", "b").agg(F.collect_list(F.struct("f", "k")).alias("ks"))  # a few fragments
    keep = members.join(sizes, ["a", "b"]).withColumn("total", F.expr("aggregate(ks, 0, (x, y) -> x + y.k)"))
    keep = keep.withColumn("keep", F.expr("least(total - t + 1, p)")).where("keep > 0")
    cut = rest.join(keep.select("a", "b", F.col("nb").alias("n"), "p", "w", "ks", "keep"), ["a", "b"])
    cut = cut.withColumn("own", F.expr("keep - aggregate(filter(ks, y -> y.f < f), 0, (x, y) -> x + y.k)")).where("own > 0")
    entries = cut.select(F.col("b").alias("c"), "n", "p", "w", "a", F.explode(F.expr("slice(rest, 1, CAST(least(own, size(rest)) AS INT))")).alias("t"))
    entries = entries.select(F.xxhash64("a", "t").alias("key"), "c", "n", "p", "w")
    x = members.where("NOT joined AND short <= 0").select("a", F.col("b").alias("x"), F.col("nb").alias("nx"), F.col("o").alias("ox"), F.col("cb").alias("cx"))
    y = members.where("nb < na AND o >= least").select("a", F.col("b").alias("y"), F.col("nb").alias("ny"), F.col("o").alias("oy"), F.col("cb").alias("cy"))
    band = x.join(y, "a").where("cx <> cy").where(rule.close("nx", "ny")).where(F.least("ox", "oy") >= rule.need("nx", "ny"))
    band = band.selectExpr("least(x, y) AS a", "if(x < y, nx, ny) AS na", "greatest(x, y) AS b", "if(x < y, ny, nx) AS nb", *_PLAIN)
    return entries, persist_table(band, "band", keep=True)


def link_sets(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(sets, classes, links, roots): documents' sets, classes of equal sets (c, d, rep), links between
    classes (a, b) and components (node, root)."""
    with small_batches(docs.sparkSession, BATCH):
        bits = docs.sparkSession.sparkContext.broadcast(common_bits(docs, rule))
        sets = set_table(docs, bits, rule)
    bits.destroy()
    classes = persist_table(sets.where("n > 0").groupBy("d", "c").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "set-classes")
    with scratch(docs.sparkSession):
        needed = persist_table(with_partners(sets, rule).join(classes, "c").select("rep"), "needed")
        whole = segments(docs, needed, rule)
        ranks = docs.sparkSession.sparkContext.broadcast(rank_tables(whole))
        parts = shared_parts(whole, ranks, rule)
    ranks.destroy()
    lists = _lists(parts.select(F.explode("prefix").alias("key"), "c", "n", "p", "w").withColumn("comp", F.col("c")))
    links, roots, band = None, None, None
    for level in range(LEVELS):
        with scratch(docs.sparkSession):
            last = level == LEVELS - 1
            pairs = _all_pairs(lists if last else lists.where(F.col("k") <= SHORT), rule)
            if not last:
                pairs = pairs.unionByName(_star_pairs(lists.where(F.col("k") > SHORT)))
            if band is not None:
                pairs = pairs.unionByName(band)
            pairs = persist_table(pairs.groupBy("a", "na", "b", "nb").agg(*(F.max(x).alias(x) for x in ("p", "w", "star"))), "pairs")
            counted = overlaps(pairs, parts)
            once = counted.groupBy("a", "b", "f").agg(F.max("o").alias("o"))  # a segment may stand twice
            summed = persist_table(pairs.join(once.groupBy("a", "b").agg(F.sum("o").alias("o")), ["a", "b"]), "summed")
            new = summed.where(F.col("o") >= rule.need("na", "nb")).select("a", "b")
            links = persist_table(new if links is None else links.unionByName(new).distinct(), "links", keep=True)
            roots = persist_table(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots", keep=True)
            star = summed.where("star")
            if star.limit(1).count() == 0:
                break
            entries, band = _next_level(star, counted, roots, rule)
            lists = _lists(_with_component(entries, roots))
    return sets, classes, links, roots


def link_documents(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id.

    ``component_id`` is the smallest doc_id that links reach, ``class_id`` the smallest with an equal
    set. Null and empty texts have no n-grams, are linked with nothing and stand alone, as do null
    ids among them. Rows repeated with the same id are one class; an empty table gives an empty
    result; further columns are ignored.
    """
    with scratch(docs.sparkSession):
        named = _linked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rule or Rule())
        return persist_table(named, "linked-documents", keep=True)


def _linked(docs: DataFrame, rule: Rule) -> DataFrame:
    sets, classes, _, roots = link_sets(docs, rule)
    rooted = classes.join(roots, classes["c"] == roots["node"]).select("c", "rep", "root")
    heads = persist_table(rooted.groupBy("root").agg(F.min("rep").alias("head")), "component-heads")
    named = persist_table(classes.select("d", "c", "rep").join(rooted.select("c", "root"), "c", "left").join(heads, "root", "left")
                          .select("d", "rep", F.coalesce("head", "rep").alias("head")), "named-classes")
    linked = sets.where("n > 0").select("doc_id", "n", "d").join(named, "d")
    alone = sets.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("rep"), F.col("doc_id").alias("head"))
    return linked.select("doc_id", "n", "rep", "head").unionByName(alone).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("head").alias("component_id"), F.col("rep").alias("class_id"))


def _with_digest(docs: DataFrame, rule: Rule) -> DataFrame:
    """Stored rows with ``_own``, the digest of their set, null without words."""
    k = rule.words

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, k, hashes) for t in batch.column("text").to_pylist()]
            own = pa.array([digest(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, "_own"])

    with small_batches(docs.sparkSession, BATCH):
        return persist_table(docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_own", T.BinaryType())])), "near-digests")


def _kept(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Stored ids and digests (_id, _d) of what stays, and the ids that are null or stand in several rows (_odd)."""
    sets, classes, _, roots = link_sets(docs, rule)
    rooted = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "d")).alias("first"))
    kept = first.select(F.col("first.rep").alias("_id"), F.col("first.d").alias("_d")).unionByName(
        sets.where("n = 0").select(F.col("doc_id").alias("_id"), F.lit(None).cast("binary").alias("_d")))
    odd = sets.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").select(F.col("doc_id").alias("_odd"))
    return persist_table(kept, "near-kept", keep=True), persist_table(odd, "near-odd", keep=True)


def one_per_group(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """The documents that stay, all columns: of each component the one with the smallest doc_id, null last,
    and those without words.

    Rows with a repeated id, or without one, are told apart by their n-gram sets: equal sets under one id
    are one document, different ones are documents of their own. Without words and id, each row stays.
    """
    rule = rule or Rule()
    with scratch(docs.sparkSession):
        kept, odd = _kept(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rule)
    out = docs.join(kept.where("_id IS NOT NULL").select("_id"), F.expr("CAST(doc_id AS LONG) = _id"), "left_semi")
    if not odd.limit(1).count():
        return out
    repeated = odd.where("_odd IS NOT NULL")
    same = F.expr("CAST(doc_id AS LONG) = _odd")
    rows = _with_digest(docs.where("doc_id IS NULL").unionByName(docs.join(repeated, same, "left_semi")), rule)
    worded = rows.where("_own IS NOT NULL").join(kept, F.expr("_own = _d AND CAST(doc_id AS LONG) <=> _id"), "left_semi")
    bare = rows.where("_own IS NULL")
    return (out.join(repeated, same, "left_anti")
            .unionByName(worded.dropDuplicates(["doc_id", "_own"]).drop("_own"))
            .unionByName(bare.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).drop("_own"))
            .unionByName(bare.where("doc_id IS NULL").drop("_own")))
