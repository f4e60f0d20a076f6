import random

import pytest

from beaconry.llm import mixing
from tests.llm.helpers import ODD, documents, prose, words


def goals(sizes):
    """Targets by the rule as stated: share by weight, stop at three times the size, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * sizes[s] + 1e-9]
        if not full:
            return target | share
        for s in full:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
            open_.remove(s)


def check(spark, rows):
    got = mixing.mix(documents(spark, rows).withColumnRenamed("lang", "size").repartition(4)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        source = r[2] if len(r) > 2 else "s"
        sizes[source] = sizes.get(source, 0) + len(words(r[1]))
    assert sorted(r["size"] for r in got) == sorted(len(words(r[1])) for r in rows)
    target, taken = goals(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]], abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, n in taken.items():
        # A few blocks off at most; blocks are a 256th of a source, or one word.
        assert abs(n - target[source]) <= max(0.03 * target[source], 4 * max(1, sizes[source] / 256)), (source, n, target[source])
    return sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in got)


def test_hot_and_small_sources(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randrange(200)), rng.choice(["hot", "hot", "hot", "b", "c", "d", None])) for i in range(300)]
    rows += [(900, prose(1, 6000), "hot"), (901, "few words here", "tiny"), (902, None, "nothing"), (903, " ", None)]
    assert check(spark, rows) == check(spark, list(reversed(rows)))


def test_odd(spark):
    check(spark, ODD)


def test_empty(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [(1, None), (2, "")])).collect()[0]["taken"] == 0


def test_schedule_is_even(spark):
    shares = spark.createDataFrame([(1, 0, 2**30), (2, 2**30, 2**31)], "src long, low long, high long")
    slots = mixing.schedule(shares, 4000, 4).orderBy("slot").collect()
    assert len(slots) == 4000
    seen = {1: 0, 2: 0}
    for r in slots:
        assert r["before"] == seen[r["src"]]
        seen[r["src"]] += 1
        assert abs(seen[1] - seen[2]) < 8


def test_plan_has_no_python(spark):
    for df in (mixing.mix(documents(spark, ODD)), mixing.mixed_documents(documents(spark, ODD))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_mixed_documents(spark):
    rows = [(i, prose(i, 60), "a" if i % 4 else "b") for i in range(200)]
    out = mixing.mixed_documents(documents(spark, rows))
    assert out.columns == documents(spark, []).columns
    taken = {r["doc_id"]: r["taken"] / r["size"] for r in mixing.mix(documents(spark, rows)).collect()}
    times = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(abs(times.get(d, 0) - t) <= 0.5 for d, t in taken.items())
