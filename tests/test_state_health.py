import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beaconry.operators.analysis import normalize_timing, zscore_flag
from beaconry.operators.dims import apply_changes, scd2_merge, snapshot_diff
from beaconry.operators.health import health, latest_per, score_from_rules
from beaconry.operators.rollups import rollup_5min, rollup_by_place
from beaconry.profiles import NETWORK, RETAIL
from beaconry.profiles.network import PENALTIES
from beaconry.semantic import MetricView
from beaconry.semantic.views import NETWORK_PERFORMANCE, VIEWS

NOON = datetime(2026, 1, 7, 12)


def _perf(spark, rows):
    return spark.createDataFrame(
        [(d, "router", "edge-north", m, v, NOON.replace(hour=h)) for d, m, v, h in rows],
        "device_id string, device_type string, location string, metric_name string, avg_value double,"
        " window_end timestamp")


def _events(spark, rows):
    return spark.createDataFrame([(d, NOON.replace(hour=h), c, "x") for d, h, c in rows],
                                 "device_id string, event_timestamp timestamp, is_critical boolean,"
                                 " event_category string")


def test_health_uses_latest_metric_and_recent_events(spark):
    perf = _perf(spark, [("a", "latency_ms", 500.0, 9), ("a", "latency_ms", 10.0, 11), ("b", "latency_ms", 151.0, 11),
                         ("b", "packet_loss_pct", 3.1, 11), ("b", "jitter_ms", 41.0, 11)])
    events = _events(spark, [("a", 12, True), ("a", 9, True), ("a", 11, False)])
    got = {r.device_id: r for r in health(perf, events, NETWORK, NOON).collect()}
    assert (got["a"].current_latency_ms, got["a"].event_count_1h, got["a"].critical_event_count_1h) == (10.0, 2, 1)
    assert (got["a"].health_score, got["a"].health_status, got["a"].requires_attention) == (95, "Excellent", True)
    assert (got["b"].health_score, got["b"].health_status, got["b"].event_count_1h) == (10, "Critical", 0)


def test_score_is_clamped(spark):
    columns = {"current_latency_ms": 999.0, "current_packet_loss_pct": 99.0, "current_jitter_ms": 99.0,
               "critical_event_count_1h": 99}
    df = spark.range(1).withColumns({k: F.lit(v) for k, v in columns.items()})
    assert df.select(score_from_rules(PENALTIES).alias("s")).first().s == 0


def test_missing_accuracy(spark):
    perf = spark.createDataFrame(
        [("s", "fast_food", "dine_in", "r", 1.0, 2.0, "hourly_sales", 5.0, NOON)],
        "store_id string, store_category string, store_type string, region string, latitude double,"
        " longitude double, metric_name string, avg_value double, window_end timestamp")
    events = spark.createDataFrame([], "store_id string, store_category string, event_timestamp timestamp,"
                                       " is_critical boolean, event_category string")
    assert health(perf, events, RETAIL, NOON).first().health_score == 75
    assert health(perf, events, RETAIL, NOON, missing="skip").first().health_score == 100


def test_latest_per(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 1.0), ("b", 2, 2.0)], "k string, t int, v double")
    assert {(r.k, r.t, r.v) for r in latest_per(df, ["k"], "t", ["v"]).collect()} == {("a", 3, 1.0), ("b", 2, 2.0)}


def _metrics(spark, rows):
    return spark.createDataFrame(
        [(NOON.replace(minute=m), "d", "router", loc, "V", "latency_ms", "milliseconds", v, v > 150, f)
         for m, loc, v, f in rows],
        "event_timestamp timestamp, device_id string, device_type string, location string, vendor string,"
        " metric_name string, metric_unit string, value double, is_anomaly boolean, source_file string")


def test_rollup(spark):
    rows = rollup_5min(_metrics(spark, [(0, "x", 10.0, "f"), (4, "x", 200.0, "g"), (5, "x", 1.0, "f")]), NETWORK)
    first, second = rows.orderBy("window_start").collect()
    assert (first.sample_count, first.anomaly_count, first.max_anomaly_value, first.source_file_count) == (2, 1, 200.0, 2)
    assert (second.sample_count, second.stddev_value, second.max_anomaly_value) == (1, None, 0.0)
    assert first.window_end == second.window_start


def test_rollup_of_rollup_adds_up(spark):
    rng = random.Random(3)
    metrics = _metrics(spark, [(rng.randrange(60), rng.choice("xy"), rng.uniform(0, 300), "f") for _ in range(300)])
    direct = metrics.agg(F.count(F.lit(1)), F.count_if("is_anomaly"), F.max("value")).first()
    place = rollup_by_place(rollup_5min(metrics, NETWORK, sketch=True), NETWORK)
    assert tuple(place.agg(F.sum("total_samples"), F.sum("total_anomalies"), F.max("location_max_value")).first()) == tuple(direct)
    assert "location_true_p95_value" in place.columns


def _snapshot(spark, seed, n):
    rng = random.Random(seed)
    keys = rng.sample(range(40), n)
    return spark.createDataFrame([(k, rng.choice(["a", "b", None])) for k in keys], "k int, v string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_diff_then_apply(spark, seed):
    old, new = _snapshot(spark, seed, 25), _snapshot(spark, seed + 10, 25)
    result = apply_changes(old, snapshot_diff(old, new, ["k"]), ["k"])
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, new.collect()))
    assert snapshot_diff(new, new, ["k"]).count() == 0


@pytest.mark.parametrize("close", [False, True])
def test_scd2_history(spark, close):
    dim = spark.createDataFrame([], "k int, v string, effective_start_date timestamp,"
                                    " effective_end_date timestamp, is_active boolean")
    for day in range(1, 4):
        dim = scd2_merge(dim, _snapshot(spark, day, 25), ["k"], ["v"], datetime(2026, 1, day), close)
    rows = dim.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.effective_start_date)
        assert sum(r.is_active for r in versions) <= 1
        for earlier, later in zip(versions, versions[1:]):
            assert earlier.effective_end_date is not None
            assert earlier.effective_end_date <= later.effective_start_date
    active = {r.k for r in rows if r.is_active}
    assert active == ({r.k for r in _snapshot(spark, 3, 25).collect()} if close else set(by_key))


def test_normalize_and_zscore(spark):
    df = spark.createDataFrame(
        [("drive_through_kds_bump_time_sec", 90.0, 50.0), ("drive_through_menu_board_time_sec", 60.0, 20.0),
         ("hourly_sales", 10.0, 99.0), ("drive_through_window_time_sec", 7.0, None)],
        "metric_name string, value double, order_value double")
    got = {r.metric_name: r.normalized_value for r in normalize_timing(df).collect()}
    assert got["drive_through_kds_bump_time_sec"] == pytest.approx(50.0)
    assert got["drive_through_menu_board_time_sec"] == pytest.approx(60 / 1.1)
    assert (got["hourly_sales"], got["drive_through_window_time_sec"]) == (10.0, 7.0)
    flat = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "k string, value double")
    assert zscore_flag(flat, ["k"]).filter("is_outlier OR zscore IS NOT NULL").count() == 0


def test_metric_view(spark):
    view = MetricView.from_dict("v", {
        "source": "t", "dimensions": [{"name": "Place", "expr": "upper(p)", "comment": "where"}],
        "measures": [{"name": "Rate", "expr": "sum(a) / nullif(sum(n), 0)"}, {"name": "Devices", "expr": "count(distinct d)"}]})
    df = spark.createDataFrame([("x", 1, 10, "d1"), ("X", 3, 10, "d1"), ("y", 9, 10, "d2"), ("z", 0, 0, "d3")],
                               "p string, a int, n int, d string")
    # Ratios and distinct counts are taken at the grain of the question.
    assert view.query(df, measures=["Devices"]).first().Devices == 3
    rows = view.query(df, ["Place"], {"r": "Rate"}, where="`Place` <> 'Q'", having="`Rate` > 0.1 AND `Devices` = 1",
                      derive={"band": "CASE WHEN r > 0.5 THEN 'high' ELSE 'low' END"}, order_by=["r DESC"], limit=5)
    assert [tuple(r) for r in rows.collect()] == [("Y", 0.9, "high"), ("X", 0.2, "low")]
    df.createOrReplaceTempView("t")
    assert view.query(dimensions=["Place"], measures=["Rate"]).count() == 3
    with pytest.raises(ValueError):
        MetricView("w", "t", {"p": "upper(p)"}, {}).with_dimensions(df)
    assert view.describe()["dimensions"][0]["comment"] == "where"


def test_yaml_view():
    pytest.importorskip("yaml")
    view = MetricView.from_yaml("v", "source: t\ndimensions:\n  - name: A\n    expr: a\nmeasures:\n  - name: N\n    expr: COUNT(*)\n")
    assert view.measures == {"N": "COUNT(*)"}


def test_view_list():
    assert len(VIEWS.list()) == 13
    assert VIEWS.describe("network_performance")["source"] == NETWORK_PERFORMANCE.source
