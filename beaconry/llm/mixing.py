"""Mixing sources to target weights by a low-discrepancy schedule of token blocks.

Points of the golden-ratio sequence, mapped through the cumulative weights, name a source per slot,
so every stretch of the schedule holds the sources in their shares. The n-th slot of a source takes
the n-th block of its shuffled tokens, beginning again when they are used up. Blocks of a source hold
equally many tokens, but for its last one. Everything is DataFrame operations; running totals are taken in three
levels of hashed groups, so no source is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beaconry.llm.text import SPACES
from beaconry.session import persist_table

WEIGHTS = (5, 2, 1)
PASSES = 3  # a document is used three times at most
BLOCK, FEWEST = 512, 256  # most tokens of a block; fewest blocks of a source, as far as it has tokens
PERIOD, STEP = 2**31, 1_327_217_885  # golden ratio times the period, odd: visits every point once a period


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space: the starts are counted, null gives 0."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+", "x")
    return F.length(F.regexp_replace(marked, SPACES, "")).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, size) -> one row per source with its weight, total and target.

    Sources in code-point order, null last, weigh 5, 2, 1, repeating, and share the sum of all
    sizes. A source stops at PASSES times its total and the others share the excess by weight.
    Sources fill up in the order of total over weight, so the level all others reach follows from
    running totals. The level rises up to the first source that bears it, and falls after it.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    rated = totals.withColumn("weight", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int")))
    cap = F.col("source_size") * float(PASSES)
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) - filled) / weight_left
    levels = rated.withColumn("level", level).withColumn("final", F.when(level * F.col("weight") <= cap, level))
    final = F.max("final").over(everything)
    return levels.select("source", "source_size", "weight", F.least(cap, final * F.col("weight")).alias("target"))


def running_totals(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over earlier rows of the group, in the order of (h1, h2, order).

    The columns h1 and h2 cut a group into parts. Sums of parts are added up
    over parts, never over rows, so the longest window is a part or one level's number of parts.
    """
    def earlier(window):
        return F.coalesce(F.sum("_v").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    parts = rows.groupBy(*group, "h1", "h2").agg(F.sum(value).alias("_v"))
    coarse = parts.groupBy(*group, "h1").agg(F.sum("_v").alias("_v"))
    coarse = coarse.select(*group, "h1", earlier(Window.partitionBy(*group).orderBy("h1")).alias("_b1"))
    fine = parts.select(*group, "h1", "h2", earlier(Window.partitionBy(*group, "h1").orderBy("h2")).alias("_b2"))
    starts = fine.join(coarse, [*group, "h1"]).select(*group, "h1", "h2", (F.col("_b1") + F.col("_b2")).alias("_start"))
    within = Window.partitionBy(*group, "h1", "h2").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(starts, [*group, "h1", "h2"])
            .withColumn("before", F.col("_start") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_start"))


def schedule(shares: DataFrame, slots: int, parts: int) -> DataFrame:
    """Slot numbers with their source and ``before``, the source's earlier slots.

    ``shares`` (src, low, high): intervals that cover 0 to PERIOD. A slot meets the sources of its
    grid cell only; with as many cells as sources that is two on average.
    """
    spark = shares.sparkSession
    cells = max(1024, shares.count())
    width = -(-PERIOD // cells)
    spread = shares.where("high > low").withColumn(
        "cell", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")))
    point = F.pmod(F.pmod(F.col("id"), F.lit(PERIOD)) * F.lit(STEP), F.lit(PERIOD))
    points = spark.range(0, slots, 1, parts).select(F.col("id").alias("slot"), point.alias("point"),
                                                    F.expr("id div 65536").alias("h1"), F.expr("id div 1024 % 64").alias("h2"))
    named = points.withColumn("cell", F.expr(f"point div {width}")).join(spread, "cell").where("point >= low AND point < high")
    return running_totals(named.select("slot", "src", "h1", "h2", F.lit(1).alias("one")), ["src"], ["slot"], "one")


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source.

    ``taken`` counts the words the schedule takes from a document, repeats included, at most PASSES
    times its size. Null and empty texts have size 0 and nothing is taken. Repeated rows are documents
    like others. The order of documents is a hash of (doc_id, text size), so reruns agree. An empty
    table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = persist_table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                     F.monotonically_increasing_id().alias("row")), "mix-sizes")
    number, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    aims = targets(rows)
    fewest = F.greatest(F.ceil(F.col("source_size") / BLOCK), F.least(F.lit(FEWEST), "source_size"), F.lit(1))
    aims = aims.withColumn("length", F.greatest(F.ceil(F.col("source_size") / fewest), F.lit(1)).cast("long"))
    aims = aims.withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")).cast("long"))
    aims = aims.withColumn("quota", F.when(F.col("source_size") > 0, F.round(
        F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    aims = persist_table(aims.withColumn("src", F.row_number().over(order))
                         .withColumn("_upto", F.sum("quota").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                         .withColumn("_all", F.sum("quota").over(Window.partitionBy())), "mix-sources")
    slots = aims.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    bound = lambda c: F.floor(c.cast("double") * PERIOD / F.col("_all")).cast("long")
    shares = aims.where("quota > 0").select("src", bound(F.col("_upto") - F.col("quota")).alias("low"), bound(F.col("_upto")).alias("high"))

    # How often each block is taken: slots of a source, numbered, go round its blocks.
    uses = (schedule(shares, slots, parts).join(aims.select("src", "blocks"), "src")
            .where(F.col("before") < F.col("blocks") * PASSES)
            .select("src", (F.col("before") % F.col("blocks")).alias("block"))
            .groupBy("src", "block").agg(F.count(F.lit(1)).alias("uses")))

    side = max(16, int((number / 64) ** 0.5) + 1)
    hashed = F.xxhash64(F.lit(seed), "doc_id", "size")
    lined = running_totals(
        _with_source(rows, aims).withColumn("hash", hashed)
        .withColumn("h1", F.pmod("hash", F.lit(side))).withColumn("h2", F.pmod(F.shiftright("hash", 20), F.lit(side))),
        ["src"], ["hash", "doc_id", "size", "row"], "size")
    # A document meets the blocks from that of its first token to that of its last.
    lined = lined.withColumn("first", F.expr("before div length")).withColumn("last", F.expr("(before + size - 1) div length"))
    cut = lined.withColumn("block", F.explode(F.when(F.col("size") > 0, F.expr("sequence(first, last)")).otherwise(F.array(F.lit(-1).cast("long")))))
    begin, end = F.expr("block * length"), F.expr("(block + 1) * length")
    words = F.when(F.col("size") > 0, F.least(F.col("before") + F.col("size"), end) - F.greatest(F.col("before"), begin)).otherwise(0)
    taken = cut.withColumn("words", words).join(uses, ["src", "block"], "left")
    return taken.groupBy("row", "doc_id", "size", "source_size", "target", "source").agg(
        F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).cast("long").alias("taken")).drop("row")


def _with_source(rows: DataFrame, aims: DataFrame) -> DataFrame:
    own = aims.select(F.col("source").alias("_source"), "src", "source_size", "target", "length")
    return rows.join(own, F.expr("source <=> _source")).drop("_source")


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents of the mix, all columns: each as often as its words are taken, to the nearest whole.

    A block's border may cut a document; half a document or more counts as one.
    """
    counts = persist_table(mix(docs, seed).where("taken > 0").select(
        F.col("doc_id").alias("_id"), "size", F.expr("(2 * taken + size) div (2 * size)").alias("_times")), "mix-counts")
    # Rows repeated with the same id are interchangeable: their counts are shared out evenly.
    counts = counts.groupBy("_id").agg(F.sum("_times").alias("_times"), F.count(F.lit(1)).alias("_rows"))
    counts = counts.withColumn("_times", F.expr("(2 * _times + _rows) div (2 * _rows)")).where("_times > 0").drop("_rows")
    out = docs.join(counts, F.expr("doc_id <=> _id"))
    return out.withColumn("_n", F.explode(F.expr("sequence(1, _times)"))).drop("_id", "_times", "_n")
