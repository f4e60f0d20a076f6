from beaconry.llm import exact
from tests.llm.helpers import ODD, documents


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)


def test_groups_and_ties(spark):
    got = rows(exact.resolve(documents(spark, ODD).withColumnRenamed("lang", "digest")))
    assert len(got) == len(ODD)
    assert (6, 6, 2, True) in got and (7, 6, 2, False) in got
    assert (1, 1, 3, True) in got and (2, 1, 3, False) in got and (None, 1, 3, False) in got
    assert sorted(g[3] for g in got if g[0] == 4) == [False, True]  # a repeated row: exactly one stays
    assert (3, 3, 1, True) in got and (5, 5, 1, True) in got


def test_empty(spark):
    assert exact.resolve(documents(spark, [])).count() == 0


def test_index_remembers(spark):
    index = exact.new_index(spark, buckets=4)
    first = rows(exact.resolve(documents(spark, [(5, "x y"), (9, "z")]), index))
    assert all(r[3] for r in first)
    again = rows(exact.resolve(documents(spark, [(1, "x  y"), (2, "new")]), index))
    assert again == [(1, 5, 1, False), (2, 2, 1, True)]
    assert index.read().count() == 3
    same = exact.DigestIndex(spark, index.name + "_again", index.path, 4)
    assert same.read().count() == 3
    plan = index.read().join(index.read().select("digest"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_keep_first(spark):
    kept = exact.keep_first(documents(spark, ODD))
    assert kept.columns == documents(spark, []).columns
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == 8 and texts.count("one") == 1
