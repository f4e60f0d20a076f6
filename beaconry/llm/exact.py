"""Exact de-duplication against a persistent digest index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm.text import SPACES
from beaconry.session import persist_table, scratch_path


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one blank; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


class DigestIndex:
    """Table of known digests, bucketed and sorted by digest, with the row that stays for each.

    ``add`` resolves a batch against the table by a sort-merge anti join, in which the table is
    not shuffled, and appends what is new. Adding a batch again changes nothing, so a job that
    died half-way can be repeated. The table lives at ``path``; a later session opens it by the
    same name and path.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, keep_row BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> DataFrame:
        """``rows`` (id, row, digest) -> per digest of the batch: keep_id, keep_row, group_size.

        The smallest id stays (null ids last, then the smallest row number), unless the index
        already knew the digest: then nothing of this batch stays.
        """
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
        groups = persist_table(
            rows.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"),
            "digest-groups")
        known = persist_table(groups.join(self.read().select("digest", F.col("keep_id").alias("known_id"),
                                                             F.lit(True).alias("known")), "digest", "left"), "digest-known")
        new = known.where("known IS NULL").select("digest", "keep_id", "keep_row")
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))
        return known.select(
            "digest", F.when(F.col("known"), F.col("known_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(F.col("known"), F.lit(None)).otherwise(F.col("keep_row")).alias("keep_row"), "group_size")


def new_index(spark: SparkSession, buckets: int = 64) -> DigestIndex:
    path = scratch_path(spark, "digest_index")
    return DigestIndex(spark, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets)


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored (id, row, digest); ``row`` tells apart rows with the same id."""
    return persist_table(docs.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("row"),
                                     F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest")), "digests")


def resolve(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal. Rows repeated with the same id and text keep exactly one.
    Columns beyond doc_id and text are ignored. An empty table gives an empty result.
    The digest table and the group table both go through a shuffle, so that Spark can split a
    digest that a large share of all rows has.
    """
    rows = digest_rows(docs)
    groups = (index or new_index(docs.sparkSession)).add(rows)
    return rows.join(groups, "digest").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, all columns. Only ids of dropped and kept rows meet the texts."""
    verdict = persist_table(resolve(docs, index), "exact-verdict")
    kept = verdict.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    marked = docs.withColumn("_sha_own", F.sha2(normalised(F.col("text")), 256))
    out = marked.join(kept, F.expr("doc_id <=> _id AND _sha_own = _sha"), "left_semi")
    repeated = verdict.groupBy("doc_id", "text_sha256").count().where("count > 1").limit(1).count()
    if repeated:  # rows repeated whole: the join kept each of them
        out = out.dropDuplicates(["doc_id", "_sha_own"])
    return out.drop("_sha_own")


SQL = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)
"""
