"""Small tables and brute-force versions for the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """Rows (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def stored(spark, df, folder):
    path = str(folder / "table")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def words(text):
    return (text or "").encode().lower().split()


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def edited(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    out = text.split(" ")
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "a b  c"), (7, "a b\tc"), (8, "é ß 漢字 " * 5),
       (9, "word " * 3000), (4, "one"), (None, "no id"), (None, None)]
