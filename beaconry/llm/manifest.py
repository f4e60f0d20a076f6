"""Merkle manifest of a table of documents: one tree per language, and one over their roots.

Eight consecutive nodes have a parent; a level's last run may be shorter, down to one node. Trees
are written as a postorder log. A builder takes an aligned block of leaves and appends each node
when it is complete, so its part of the log is contiguous; the roots of the blocks are the leaves
of the next round's builders, until a tree has one node. Where a node stands in the log follows
from its height and index alone (``position``), so a proof reads its siblings by address: nothing
is searched, and a block's part of the log with the path above it serves all its documents.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.text import crc
from beaconry.session import persist_table

FAN = 8
LEVELS = 3  # a builder's block spans this many levels: 512 leaves
BLOCK = FAN ** LEVELS
TAMPER = 3  # documents whose CRC this divides are tampered with
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SEGMENT = "tree string, block long, n long, names array<{name}>, twins array<binary>, log binary"
PATH = "array<struct<slot: int, siblings: string>>"
PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
         "tampered boolean")


def tall(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def position(leaves: int, height: int, index: int, levels: int | None = None) -> int:
    """Place (from 0) of a node in the postorder log of a tree, or of its lowest ``levels`` levels.

    Before it stand, per level up to its own, the nodes that end no later than it does, and per
    level above, those that end before its last leaf.
    """
    end = min((index + 1) * FAN ** height, leaves)
    top = tall(leaves) if levels is None else levels
    return (sum(-(-end // FAN ** h) for h in range(height + 1))
            + sum((end - 1) // FAN ** h for h in range(height + 1, top + 1)) - 1)


def parent(nodes: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def grow(leaves: list[bytes], levels: int) -> list[bytes]:
    """All nodes over an aligned block of leaves, ``levels`` levels up, in the order they are completed."""
    log, runs, last = [], [[] for _ in range(levels + 1)], len(leaves) - 1
    for at, node in enumerate(leaves):
        for level in range(levels + 1):
            log.append(node)
            runs[level].append(node)
            if level == levels or (len(runs[level]) < FAN and at < last):
                break
            node, runs[level] = parent(runs[level]), []
    return log


class Segment:
    """A block's part of the log, read by address."""

    def __init__(self, log: bytes, leaves: int, levels: int):
        self.hex, self.leaves, self.levels, self.known = log.hex(), leaves, levels, {}

    def node(self, height: int, index: int) -> str:
        at = 64 * position(self.leaves, height, index, self.levels)
        return self.hex[at:at + 64]

    def path(self, height: int, index: int) -> list[tuple[int, str]]:
        """Per level up to the block's root: place in the run, and the run's other nodes."""
        if height == self.levels:
            return []
        if (height, index) not in self.known:
            first = index // FAN * FAN
            run = range(first, min(first + FAN, -(-self.leaves // FAN ** height)))
            own = [(index - first, "".join(self.node(height, i) for i in run if i != index))]
            above = own + self.path(height + 1, index // FAN)
            if not height:
                return above
            self.known[height, index] = above
        return self.known[height, index]


def fold(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that follows from a leaf and the siblings on its way up."""
    for slot, siblings in path:
        leaf = hashlib.sha256((siblings[:64 * slot] + leaf + siblings[64 * slot:]).encode()).hexdigest()
    return leaf


def in_block(n: int, block: int) -> tuple[int, int]:
    """Leaves and levels of a block of a tree (or of what is left of it) of ``n`` leaves."""
    return min(BLOCK, n - block * BLOCK), min(LEVELS, tall(n))


def encoded(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(tree, name, leaf, twin): ``twin`` is the leaf of the tampered document, null if it is not tampered with."""
    head = [encoded(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    low = F.translate("text", UPPER, UPPER.lower())
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("name"),
        F.unhex(F.sha2(F.concat(*head, encoded(F.col("text"))), 256)).alias("leaf"),
        F.when(crc(F.col("doc_id")) % TAMPER == 0, F.unhex(F.sha2(F.concat(*head, encoded(low)), 256))).alias("twin"))


def numbered(rows: DataFrame) -> DataFrame:
    """Adds each row's place in its tree by name and leaf, ``at``, and the tree's number of rows, ``n``.

    Rows are sorted across the cluster; a range of the sort adds to its own numbers those of its
    tree in the ranges before. Equal rows may trade places, which changes no digest.
    """
    order = ["tree", "name", "leaf", "dealt"]
    line = persist_table(
        rows.withColumn("dealt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
        .drop("dealt").withColumn("line", F.monotonically_increasing_id()), "manifest-order")
    line = line.withColumn("part", F.shiftright("line", 33))
    parts = line.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("own"), F.min("line").alias("first"))
    tree = Window.partitionBy("tree")  # one row per range and tree in it
    before = F.sum("own").over(tree.orderBy("part")) - F.col("own")
    starts = parts.select("tree", "part", (F.col("first") - before).alias("start"), F.sum("own").over(tree).alias("n"))
    return line.join(starts, ["tree", "part"]).select("tree", "name", "leaf", "twin", (F.col("line") - F.col("start")).alias("at"), "n")


def build(rows: DataFrame) -> list[DataFrame]:
    """Log segments of each round: tree, block, n (leaves of the round's tree), names, twins, log."""
    kind = dict(rows.dtypes)["name"]
    rounds, now = [], numbered(rows)
    while True:
        now = persist_table(now.withColumn("block", F.expr(f"at div {BLOCK}")).groupBy("tree", "block")
                            .applyInPandas(_builder, SEGMENT.format(name=kind)), "manifest-log")
        rounds.append(now)
        largest = now.agg(F.max("n")).first()[0] or 0
        if largest <= BLOCK:
            return rounds
        kind = "long"
        now = now.where(f"n > {BLOCK}").select("tree", F.col("block").alias("name"), F.expr("substring(log, -32)").alias("leaf"),
                                                F.lit(None).cast("binary").alias("twin"), F.col("block").alias("at"),
                                                F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"))


def _builder(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("at")
    tree, block, n = (rows[c].iloc[0] for c in ("tree", "block", "n"))
    size, levels = in_block(int(n), int(block))
    if size != len(rows):
        raise RuntimeError("a block has not the leaves that its tree says: store the documents first")
    names = [None if pd.isna(x) else x for x in rows["name"]]
    return pd.DataFrame([{"tree": tree, "block": block, "n": n, "names": names, "twins": rows["twin"].tolist(),
                          "log": b"".join(grow(rows["leaf"].tolist(), levels))}])


def log(rounds: list[DataFrame]) -> DataFrame:
    """The log as rows: tree, position (in the whole tree's postorder), height, index, digest."""
    def rows(base: int):
        def run(batches):
            for batch in batches:
                for tree, block, n, total, own in zip(*(batch[c] for c in ("tree", "block", "n", "total", "log"))):
                    size, levels = in_block(n, block)
                    part, out = Segment(own, size, levels), []
                    for h in range(0 if not base else 1, levels + 1):
                        for i in range(-(-size // FAN ** h)):
                            index = block * FAN ** (LEVELS - h) + i
                            out.append((tree, position(total, base + h, index), base + h, index, part.node(h, i)))
                    yield pd.DataFrame(out, columns=["tree", "position", "height", "index", "digest"])
        return run

    total = rounds[0].where("block = 0").select("tree", F.col("n").alias("total"))
    return reduce(DataFrame.unionAll, [
        part.select("tree", "block", "n", "log").join(total, "tree").mapInPandas(
            rows(LEVELS * i), "tree string, position long, height int, index long, digest string")
        for i, part in enumerate(rounds)])


def _below(part: DataFrame, paths: DataFrame, children: str) -> DataFrame:
    """From the paths of blocks to the paths of their leaves."""
    def run(batches):
        for batch in batches:
            for block, n, names, own, above, subroot, root, tree in zip(*(
                    batch[c] for c in ("block", "n", "names", "log", "path", "subroot", "root", "tree"))):
                size, levels = in_block(n, block)
                seg = Segment(own, size, levels)
                above = [(s["slot"], s["siblings"]) for s in above]
                out = []
                for i in range(size):
                    path = [{"slot": s, "siblings": x} for s, x in seg.path(0, i) + above]
                    # A leaf of the tree of subroots is a whole tree, otherwise it is a block of the same tree.
                    out.append((names[i], 0, path, seg.node(0, i), root) if children == "trees" else (tree, names[i], path, subroot, root))
                yield pd.DataFrame(out, columns=["tree", "block", "path", "subroot", "root"])

    return part.join(paths, ["tree", "block"]).mapInPandas(run, f"tree string, block long, path {PATH}, subroot string, root string")


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Paths of the first round's blocks, from those of whole trees."""
    paths = None
    for i in reversed(range(len(rounds))):
        own = tops.join(rounds[i].where(f"n <= {BLOCK}").select("tree"), "tree", "left_semi")  # trees of one block in this round
        paths = own if paths is None else own.unionByName(paths)
        paths = persist_table(paths, "manifest-paths")
        if i:
            paths = _below(rounds[i], paths, "blocks")
    return paths


def proofs(segments: DataFrame, paths: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, n, names, twins, own, above, subroot, root in zip(*(
                    batch[c] for c in ("block", "n", "names", "twins", "log", "path", "subroot", "root"))):
                size, levels = in_block(n, block)
                seg = Segment(own, size, levels)
                above = [(s["slot"], s["siblings"]) for s in above]
                out = []
                for i in range(size):
                    leaf, path = seg.node(0, i), seg.path(0, i) + above
                    twin = None if twins[i] is None else bytes(twins[i]).hex()
                    folded = fold(twin or leaf, path)
                    proof = hashlib.sha256("".join(s for _, s in path).encode()).hexdigest()
                    name = names[i]
                    out.append((None if name is None or name != name else int(name), leaf, subroot, root, proof, folded,
                                folded == root, twin is not None))
                frame = pd.DataFrame(out, columns=[f.split()[0] for f in PROOF.split(", ")])
                frame["doc_id"] = pd.array(frame["doc_id"].array, dtype="Int64")
                yield frame

    joined = segments.join(paths, ["tree", "block"])
    return joined.select("block", "n", "names", "twins", "log", "path", "subroot", "root").mapInPandas(run, PROOF)


class Manifest:
    """The logs of a table's trees (``rounds``) and of the tree over their subroots (``top``)."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        self.rounds = build(persist_table(leaves_of(docs), "manifest-leaves"))
        roots = [r.where(f"n <= {BLOCK}").select(F.lit("").alias("tree"), F.col("tree").alias("name"),
                                                 F.expr("substring(log, -32)").alias("leaf"), F.lit(None).cast("binary").alias("twin"))
                 for r in self.rounds]
        self.top = build(persist_table(reduce(DataFrame.unionAll, roots), "manifest-subroots"))

    @property
    def root(self) -> str | None:
        """None for an empty table."""
        last = self.top[-1].where(f"n <= {BLOCK}").select("log").first()
        return bytes(last["log"])[-32:].hex() if last else None

    def paths(self) -> DataFrame:
        """Per block of the first round: path above it to the root, subroot, root."""
        none = F.array().cast(PATH)
        start = self.spark.range(1).select(F.lit("").alias("tree"), F.lit(0).cast("long").alias("block"), none.alias("path"),
                                           F.lit("").alias("subroot"), F.lit(self.root or "").alias("root"))
        trees = _below(self.top[0], _descend(self.top, start), "trees")
        return _descend(self.rounds, persist_table(trees, "manifest-trees"))

    def proofs(self) -> DataFrame:
        return proofs(self.rounds[0], self.paths())


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, tampered.

    Nulls are `-` in a leaf, so they differ from empty texts. Null ids stand before others; equal
    ids are ordered by their leaves, so the order of rows and repeated rows change nothing. A null
    id has the CRC of the empty text, which makes it tampered with. A text without A-Z stays verified.
    Further columns are ignored. An empty table gives an empty result.
    """
    return Manifest(docs).proofs()


def _levels(name: str, nodes: str) -> str:
    return f"""
{name} AS (
  SELECT tree, 0 AS h, i, digest, count(*) OVER (PARTITION BY tree) AS n FROM {nodes}
  UNION ALL
  SELECT *, count(*) OVER (PARTITION BY tree) FROM (
    SELECT tree, h + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY tree, h, i // 8))"""


def _fold(name: str, start: str, nodes: str) -> str:
    return f"""
{name}_run AS (
  SELECT a.tree, a.h, a.i, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM {nodes} a JOIN {nodes} b ON a.tree = b.tree AND a.h = b.h AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY ALL),
{name} AS (
  SELECT row, tree, 0 AS h, i, cur, proof FROM {start}
  UNION ALL
  SELECT f.row, f.tree, f.h + 1, f.i // 8, sha256(r.before || f.cur || r.after), f.proof || r.before || r.after
  FROM {name} f JOIN {name}_run r ON f.tree = r.tree AND f.h = r.h AND f.i = r.i)"""


_ENC = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_ENC.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOW = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
_CRC = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ord(c)::BIGINT), "
        "lambda a, c: list_reduce([xor(a, c)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")

SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, sha256(head || {_ENC.format('text')}) AS leaf, crc % {TAMPER} = 0 AS tampered,
         CASE WHEN crc % {TAMPER} = 0 THEN sha256(head || {_ENC.format('low')}) ELSE sha256(head || {_ENC.format('text')}) END AS given
  FROM (SELECT doc_id, text, lang, coalesce('=' || lang, '') AS tree, {_HEAD} AS head, {_LOW} AS low,
               CASE WHEN doc_id IS NULL THEN 0 ELSE {_CRC} END AS crc FROM documents)),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  row_number() OVER () AS row FROM d),
base AS (SELECT tree, i, leaf AS digest FROM leaves),
{_levels('nodes', 'base')},
roots AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, digest, tree AS name FROM nodes WHERE n = 1),
rootbase AS (SELECT tree, i, digest FROM roots),
{_levels('tops', 'rootbase')},
begin AS (SELECT row, tree, i, given AS cur, '' AS proof FROM leaves),
{_fold('own', 'begin', 'nodes')},
mid AS (SELECT o.row, '' AS tree, r.i, o.cur, o.proof, r.digest AS subroot
        FROM own o JOIN nodes t ON t.tree = o.tree AND t.n = 1 AND t.h = o.h JOIN roots r ON r.name = o.tree),
{_fold('upper_', 'mid', 'tops')}
SELECT l.doc_id, l.leaf, m.subroot, t.digest AS root, sha256(u.proof) AS proof_sha256, u.cur AS folded_root,
       u.cur = t.digest AS verified, l.tampered
FROM leaves l JOIN mid m ON m.row = l.row JOIN upper_ u ON u.row = l.row JOIN tops t ON t.n = 1 AND t.h = u.h
"""
