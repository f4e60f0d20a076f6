import random
import zlib

from beaconry.llm import toxicity
from tests.llm.helpers import ODD, documents, prose

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n):
    rng, rows, labels = random.Random(2), [], []
    bad = ["vile", "rotten", "filth", "scorn"]
    for i in range(n):
        toxic = i % 6 == 0
        text = prose(i, rng.randrange(30, 200)).split()
        for _ in range(4 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", ".", ",", "!"]))
        rows.append((i, " ".join(text)))
        if i % 3 < 2:
            labels.append((i, 1, int(toxic), "extra"))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(600)
    docs, table = documents(spark, rows).withColumnRenamed("lang", "toxic"), spark.createDataFrame(labels, LABELS)
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, table).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    unseen = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0 or i % 3 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum(got[i]["predicted"] == (i % 6 == 0) for i in unseen) >= 0.97 * len(unseen)
    # Held-out labels are not read: turning them round changes nothing.
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, q, t, x in labels]
    again = toxicity.score_documents(docs, spark.createDataFrame(turned, LABELS)).collect()
    assert {r["doc_id"]: round(r["score"], 9) for r in again} == {i: round(r["score"], 9) for i, r in got.items()}
    kept = toxicity.clean_documents(documents(spark, rows), table)
    assert kept.columns == documents(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}


def test_bounded_sample(spark):
    rows, labels = corpus(300)
    chosen = toxicity.labelled(documents(spark, rows), spark.createDataFrame(labels, LABELS), 50)
    assert chosen.count() == 50


def test_odd(spark):
    rows, labels = corpus(120)
    labels += [(1, 0, None, None), (None, 1, 1, None), (0, 1, 1, None), (77777, 1, 1, None)]
    got = toxicity.score_documents(documents(spark, rows + [(None if d is None else d + 1000, t) for d, t in ODD]),
                                   spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows) + len(ODD)
    empty = {r["score"] for r in got if r["doc_id"] in (1001, 1002, 1003)}
    assert len(empty) == 1


def test_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    got = toxicity.score_documents(documents(spark, ODD), none).collect()
    assert {r["score"] for r in got} == {0.25} and {r["predicted"] for r in got} == {0}
    assert toxicity.clean_documents(documents(spark, ODD), none).count() == len(ODD)
    assert toxicity.score_documents(documents(spark, []), none).count() == 0
