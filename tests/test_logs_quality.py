from pyspark.sql import Row
from pyspark.sql import functions as F

from beaconry.functions.syslog import syslog_param
from beaconry.operators.events import dedup_events
from beaconry.operators.logs import parse_log, read_fields
from beaconry.operators.metrics import validate_metrics
from beaconry.operators.quality import expect, expectation_report, quarantine
from beaconry.profiles import NETWORK, RETAIL

HEAD = "1 2026-01-07T10:00:00.250Z router-datacenter-east-001 IFMGR 12 LINKUPDOWN"


def _lines(spark, *lines):
    return spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "id int, value string")


def _parsed(spark, line, profile=NETWORK):
    return read_fields(_lines(spark, line), profile).first()


def test_good_line(spark):
    row = _parsed(spark, f"<131>{HEAD} [net@32473 if=\"ge-0\"] Interface down")
    assert (row.priority, row.version, row.facility, row.severity) == (131, 1, 16, 3)
    assert (row.severity_name, row.is_critical, row.event_category) == ("Error", True, "interface_event")
    assert (row.device_type, row.location) == ("router", "datacenter-east")
    assert (row.structured_data, row.message) == ('[net@32473 if="ge-0"]', "Interface down")
    assert str(row.event_timestamp) == "2026-01-07 10:00:00.250000"


def test_structured_data_shapes(spark):
    assert _parsed(spark, f"<131>{HEAD} - Plain").structured_data == "-"
    two = _parsed(spark, f'<131>{HEAD} [a x="1"][b y="2"] Two blocks')
    assert (two.structured_data, two.message) == ('[a x="1"][b y="2"]', "Two blocks")
    escaped = _parsed(spark, f'<131>{HEAD} [a x="\\]"] Escaped')
    assert (escaped.structured_data, escaped.message) == ('[a x="\\]"]', "Escaped")
    many = _parsed(spark, f"<131>{HEAD} - first\nsecond line")
    assert many.message == "first\nsecond line"
    assert _parsed(spark, f"<131>{HEAD} -").message == ""


def test_unusable_lines_are_quarantined(spark):
    lines = _lines(spark, "", None, "no priority here", f"<192>{HEAD} - x", f"<191>{HEAD} - x", f"<0>{HEAD} - x",
                   f"<131>{HEAD} [open x", f"<1a>{HEAD} - x")
    assert {r.id for r in parse_log(lines, NETWORK).collect()} == {4, 5}
    bad = quarantine(read_fields(lines, NETWORK), NETWORK.log_expectations)
    assert {r.id for r in bad.collect()} == {0, 1, 2, 3, 6, 7}


def test_retail_line(spark):
    row = _parsed(spark, '<130>1 2026-01-07T10:00:00.000Z store-west-ff-001 POS 1 STOCKOUT '
                  '[s@32473 storeCategory="fast_food"] m', RETAIL)
    assert (row.store_category, row.region, row.event_category) == ("fast_food", "west", "inventory")


def test_param(spark):
    df = spark.createDataFrame([('[a k="v" n="2"]',)], "sd string")
    row = df.select(syslog_param(F.col("sd"), "k").alias("k"), syslog_param(F.col("sd"), "z").alias("z")).first()
    assert (row.k, row.z) == ("v", None)


def test_dedup_ignores_delivery(spark):
    line = f"<131>{HEAD} - once"
    assert dedup_events(parse_log(_lines(spark, line, line), NETWORK), NETWORK).count() == 1


def test_metric_thresholds(spark):
    rows = [("latency_ms", 150.0), ("latency_ms", 150.01), ("latency_ms", 100.01), ("mystery", 5.0),
            ("error_rate", None), ("jitter_ms", -1.0)]
    df = spark.createDataFrame([Row(timestamp="2026-01-07T10:00:00+00:00", device_id="d", metric_name=m, value=v)
                                for m, v in rows])
    got = {(r.metric_name, r.value): r for r in validate_metrics(df, NETWORK).collect()}
    assert len(got) == 4
    assert not got["latency_ms", 150.0].is_anomaly and got["latency_ms", 150.0].severity_level == "medium"
    assert got["latency_ms", 150.01].is_anomaly and got["latency_ms", 150.01].severity_level == "high"
    assert got["mystery", 5.0].metric_unit == "unknown"
    assert got["latency_ms", 150.0].vendor is None


def test_retail_category_fallback(spark):
    df = spark.createDataFrame([("2026-01-07T10:00:00+02:00", "store-west-ff-1", "food_waste_pct", 21.0)],
                               "timestamp string, store_id string, metric_name string, value double")
    row = validate_metrics(df, RETAIL).first()
    assert (row.store_category, row.metric_unit, row.is_anomaly) == ("fast_food", "percent", True)
    assert str(row.event_timestamp) == "2026-01-07 08:00:00"


def test_null_is_a_violation(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-1.0,)], "value double")
    assert expect(df, "ok", "value >= 0").filter("ok").count() == 1
    from beaconry.profiles import Expectation
    report = expectation_report(df, [Expectation("v", "value >= 0", True)]).first()
    assert (report.rule, report.policy, report.total_rows, report.violations, report.passed) == ("v", "drop", 3, 2, 1)
