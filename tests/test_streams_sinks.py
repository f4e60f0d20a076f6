"""Streams in several batches, late rows, restarts, schema growth; tables and views."""

import json
from datetime import datetime, timedelta

from beaconry.operators.logs import parse_log
from beaconry.operators.quality import observe
from beaconry.plans.tables import GRAPHS, Tables, ordered, refresh
from beaconry.profiles import NETWORK
from beaconry.sinks import tables as t
from beaconry.sinks.tables import latest_table, table_writer
from beaconry.sinks.streams import append_batches, read_latest, write_stream
from beaconry.sources import readers, schema
from beaconry.streaming.pipelines import (
    drain, ingest_json, read_ingested, refresh_windows, stream_events, stream_interval_join,
)

START = datetime(2026, 1, 7, 10)
METRIC = ("timestamp string, device_id string, device_type string, location string, vendor string,"
          " metric_name string, value double")


def _write(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def _record(minute, value, device="d"):
    at = (START + timedelta(minutes=minute)).isoformat() + "+00:00"
    return json.dumps({"timestamp": at, "device_id": device, "device_type": "router", "location": "edge-north",
                       "vendor": "V", "metric_name": "latency_ms", "value": value})


def _line(minute, text="m", device="router-edge-north-001"):
    at = (START + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return f"<130>1 {at} {device} APP 1 IFDOWN - {text}"


def test_stream_parse_equals_batch_and_restarts(spark, tmp_path):
    source = tmp_path / "in"
    _write(source, "a.txt", [_line(0), "garbage"])
    _write(source, "b.txt", [_line(1)])
    _write(source, "skip.log", [_line(2)])

    def run():
        lines = readers.read_text_stream(spark, str(source), max_files=1)
        drain(parse_log(lines, NETWORK), str(tmp_path / "out"), str(tmp_path / "ckpt"))
        return spark.read.parquet(str(tmp_path / "out"))

    assert run().count() == 2
    assert run().count() == 2            # nothing new: the checkpoint remembers
    _write(source, "c.txt", [_line(3)])
    rows = run()
    assert rows.count() == 3 and rows.filter("source_file LIKE '%c.txt'").count() == 1
    assert rows.filter("ingestion_timestamp IS NULL").count() == 0


def test_stream_dedup(spark, tmp_path):
    source = tmp_path / "in"
    _write(source, "a.txt", [_line(0), _line(0), _line(1)])
    _write(source, "b.txt", [_line(0), _line(2)])
    lines = readers.read_text_stream(spark, str(source), max_files=1)
    drain(stream_events(lines, NETWORK, "30 minutes"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_refreshed_windows_and_late_rows(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    fields = spark.createDataFrame([], METRIC).schema

    def run():
        from beaconry.operators.metrics import validate_metrics
        records = readers.read_json_stream(spark, str(source), fields, max_files=1)
        refresh_windows(validate_metrics(records, NETWORK), NETWORK, out, str(tmp_path / "ckpt")).awaitTermination()
        keys = ["window_start", "window_end", *NETWORK.rollup_keys]
        return {r.window_start.strftime("%H:%M"): r.sample_count for r in read_latest(spark, out, keys).collect()}

    _write(source, "a.json", [_record(0, 1.0), _record(1, 2.0)])
    assert run() == {"10:00": 2}
    _write(source, "b.json", [_record(2, 3.0), _record(60, 4.0)])   # first window grows, time moves on
    assert run() == {"10:00": 3, "11:00": 1}
    _write(source, "c.json", [_record(3, 5.0), _record(61, 6.0)])   # one row behind the watermark
    assert run() == {"10:00": 3, "11:00": 2}


def test_stream_interval_join(spark, tmp_path):
    for name, minutes in (("s", (0, 20)), ("e", (5, 6, 16))):
        _write(tmp_path / name, "a.json", [json.dumps({f"{name}_id": m, "k": "d", f"{name}_at": str(START + timedelta(minutes=m))})
                                           for m in minutes])

    def stream(name):
        fields = spark.createDataFrame([], f"{name}_id int, k string, {name}_at timestamp").schema
        return readers.read_json_stream(spark, str(tmp_path / name), fields).select(f"{name}_id", "k", f"{name}_at")

    pairs = stream_interval_join(stream("s"), stream("e"), ["k"], "s_at", "e_at", "5 minutes", "5 minutes")
    drain(pairs, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert {(r.s_id, r.e_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(0, 5), (20, 16)}


def test_schema_grows_between_runs(spark, tmp_path):
    source, home, out = tmp_path / "in", str(tmp_path / "home"), str(tmp_path / "out")
    first = spark.createDataFrame([], "id int, v double").schema
    _write(source, "a.json", ['{"id": 1, "v": 1.5}', '{"id": 2, "v": "n/a"}', "not json"])
    assert ingest_json(spark, str(source), out, home, first) == first
    _write(source, "b.json", ['{"id": 3, "v": 2.0, "fw": "1.2", "up": 7}'])
    grown = ingest_json(spark, str(source), out, home)
    assert grown.simpleString() == "struct<id:int,v:double,fw:double,up:bigint>"
    _write(source, "c.json", ['{"id": 4, "fw": "9", "up": 8}'])
    ingest_json(spark, str(source), out, home)
    rows = {r.id: r for r in read_ingested(spark, out, grown).collect()}
    assert (rows[1].up, rows[3].up, rows[4].up) == (None, 7, 8)
    assert rows[2].v is None and json.loads(rows[2]["_rescued_data"]) == {"v": "n/a"}
    assert rows[None]["_corrupt_record"] == "not json"


def test_unknown_columns_and_inference(spark, tmp_path):
    _write(tmp_path / "in", "a.json", ['{"id": 1, "x": true}', '{"id": 2}'])
    found = schema.infer_schema(spark, str(tmp_path / "in"))
    assert found.simpleString() == "struct<id:bigint,x:boolean>"
    schema.save_schema(spark, found, str(tmp_path / "s"))
    assert schema.load_schema(spark, str(tmp_path / "s")) == found
    assert schema.load_schema(spark, str(tmp_path / "nothing")) is None
    lines = spark.read.text(str(tmp_path / "in"))
    row = schema.unknown_columns(lines, spark.createDataFrame([], "id long").schema).first()
    assert (row.column_name, row.row_count) == ("x", 1)


def test_files_and_messages(spark, tmp_path):
    _write(tmp_path / "csv", "a.csv", ["a,b", "1,x"])
    fields = spark.createDataFrame([], "a int, b string").schema
    assert readers.read_csv(spark, str(tmp_path / "csv"), fields).first().b == "x"
    _write(tmp_path / "js", "a.json", ['{"a": 1, "b": "y"}'])
    assert readers.read_json(spark, str(tmp_path / "js"), fields).first().source_file.endswith("a.json")
    raw = spark.createDataFrame([("m1", bytearray(b"<1>text"), 5)], "messageId string, payload binary, at long")
    row = readers.messages_from(raw, "messageId", "payload", "at", START).first()
    assert (row.message_id, row.value, row.publish_ts_millis, row.ingestion_timestamp) == ("m1", "<1>text", 5, START)


def test_append_batches_is_repeatable(spark, tmp_path):
    _write(tmp_path / "in", "a.txt", ["x"])
    for checkpoint in ("c1", "c2"):      # a lost checkpoint replays batch 0 over its own files
        lines = readers.read_text_stream(spark, str(tmp_path / "in"))
        append_batches(lines, str(tmp_path / "out"), str(tmp_path / checkpoint), once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_observed_violations_on_a_stream(spark, tmp_path):
    from beaconry.operators.logs import read_fields
    _write(tmp_path / "in", "a.txt", [_line(0), "garbage"])
    lines = readers.read_text_stream(spark, str(tmp_path / "in"))
    watched = observe(read_fields(lines, NETWORK), NETWORK.log_expectations, "quality")
    query = write_stream(watched, str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True)
    query.awaitTermination()
    seen = [p.observedMetrics["quality"] for p in query.recentProgress if "quality" in p.observedMetrics]
    assert (seen[0].total, seen[0].valid_priority) == (2, 1)


def test_tables(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], float(i)) for i in range(20)], "id int, p string, v double")
    stored = t.write_table(df, "t_part", ["p"], sort_by=["v"])
    assert stored.count() == 20
    t.set_table_props(spark, "t_part", {"quality": "gold"}, "it's a table")
    assert spark.sql("SHOW TBLPROPERTIES t_part").filter("key = 'quality'").first().value == "gold"
    t.analyze(spark, "t_part")
    t.register_view(stored, "v_part")
    assert {"t_part", "v_part"} <= set(t.list_tables(spark))
    counts = {r.table_name: r.row_count for r in t.table_counts({"a": stored, "b": stored.limit(3)}).collect()}
    assert counts == {"a": 20, "b": 3}
    assert readers.table(spark, "t_part").filter("p = 'a'").count() == 10


def test_compaction_and_merged_schema(spark, tmp_path):
    path = str(tmp_path / "many")
    for i in range(6):
        t.append_merging_schema(spark.createDataFrame([(i,)], "a int") if i < 5 else
                                spark.createDataFrame([(i, "new")], "a int, b string"), path)
    assert t.read_merging_schema(spark, path).filter("b IS NULL").count() == 5
    small = t.compact(spark, path, str(tmp_path / "few"), sort_by=["a"])
    assert small.count() == 6 and len(small.inputFiles()) < 6


def test_refresh_in_order(spark, tmp_path):
    assert ordered(GRAPHS["network"])[0] == "network_metrics"
    records = spark.read.json(spark.sparkContext.parallelize([_record(m, 100.0 + m) for m in range(12)]))
    lines = spark.createDataFrame([(_line(m),) for m in range(3)], "value string")
    tables = Tables(NETWORK, records, lines, as_of=START + timedelta(minutes=30), time="timestamp")
    written = []

    def save(name, df):
        written.append(name)
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    stored = refresh(tables, save, processed_at=START)
    assert written.index("network_performance_5min") < written.index("device_health")
    assert stored["network_performance_5min"].count() == 3
    assert stored["device_health"].count() == 1
    assert "processed_timestamp" in stored["network_kpi_hourly"].columns
    assert not {"performance", "metrics", "by_place"} & set(tables.__dict__)  # still over raw input


def test_refresh_takes_in_new_rows(spark, tmp_path):
    source, root = str(tmp_path / "raw"), str(tmp_path / "gold")

    def arrive(minutes):
        rows = spark.read.json(spark.sparkContext.parallelize([_record(m, 100.0 + m) for m in minutes]))
        rows.write.mode("append").parquet(source)

    lines = spark.createDataFrame([(_line(m),) for m in range(3)], "value string")
    tables = Tables(NETWORK, lambda: spark.read.parquet(source), lines, as_of=START + timedelta(minutes=60), time="timestamp")
    arrive(range(12))
    first = refresh(tables, table_writer(spark, root), processed_at=START)
    arrive(range(10, 30))
    refresh(tables, table_writer(spark, root), processed_at=START)
    whole = Tables(NETWORK, spark.read.parquet(source), lines, as_of=START + timedelta(minutes=60), time="timestamp")
    for name, df in refresh(whole, table_writer(spark, str(tmp_path / "whole")), processed_at=START).items():
        assert sorted(latest_table(spark, root, name).collect(), key=str) == sorted(df.collect(), key=str), name
    assert first["network_metrics"].count() == 12  # its readers keep what they had


def test_ingest_time_can_be_pinned(spark):
    row = readers.with_ingest_time(spark.range(1), START).first()
    assert row.ingestion_timestamp == START
