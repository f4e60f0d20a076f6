"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.session import persist_table


def _sign(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40)))).first()


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of longs -> (node, root) with the smallest node of its component, roots included.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones, so
    paths halve. Edges are never more than at the start. Loops and repeated edges are harmless; no
    edges give no rows.
    """
    now = persist_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (sign := _sign(now)) != before:
        before = sign
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = persist_table(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                              .where("u <> v").distinct(), "edges")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        now = persist_table(down.join(least, "u").select(F.expr("stack(2, v, m, u, m) AS (u, v)"))
                            .where("u <> v").distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
