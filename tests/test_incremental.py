"""Tables kept current part by part equal those computed at once."""

import os
from datetime import datetime, timedelta

import pytest

from beaconry.operators.dims import History, scd2_merge
from beaconry.operators.events import dedup_events, pane_keys, sliding_event_counts
from beaconry.operators.logs import parse_log
from beaconry.plans.incremental import IncrementalTables
from beaconry.plans.tables import GRAPHS, Tables, refresh
from beaconry.profiles import NETWORK, RETAIL
from beaconry.sinks import streams
from beaconry.sinks.parts import PartStore
from beaconry.sinks.tables import latest_table, table_writer
from beaconry.sources import readers
from beaconry.streaming.pipelines import ingest_json, refresh_panes, trailing_counts

START = datetime(2026, 1, 7, 10)
RECORD = ("event_timestamp timestamp, {entity} string, device_type string, location string, vendor string, model string,"
          " ip_address string, store_category string, store_type string, region string, brand string, district string, address string,"
          " latitude double, longitude double, metric_name string, value double, source_file string")
NETWORK_METRICS = ["latency_ms", "packet_loss_pct", "jitter_ms"]
RETAIL_METRICS = ["drive_through_wait_time_sec", "hourly_sales", "drive_through_order_accuracy_pct"]


def record(profile, minute, key, value, moved=0):
    names = NETWORK_METRICS if profile is NETWORK else RETAIL_METRICS
    name = f"router-edge-north-{key:03d}" if profile is NETWORK else f"store-{key:04d}"
    return (START + timedelta(minutes=minute) if minute is not None else None, name, "router", "edge-north", "V", f"m{key % 3}", "10.0.0.1",
            "fast_food", "drive_through", f"region{key % 2}", "B", "d", f"{key} Main St", 33.0 + key / 100 + moved, -118.0,
            names[key % 3], float(value), f"f{minute}")


def line(profile, minute, key, text="m"):
    at = (START + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    host = f"router-edge-north-{key:03d}" if profile is NETWORK else f"store-{key:04d}"
    return f'<130>1 {at} {host} APP 1 IFDOWN [store@32473 storeCategory="fast_food"] {text}'


def frames(spark, profile, rows, lines):
    return (spark.createDataFrame(rows, RECORD.format(entity=profile.entity)), spark.createDataFrame([(x,) for x in lines], "value string"))


def content(df):
    columns = sorted(c for c in df.columns if c != "processed_timestamp")
    return sorted([tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()], key=str)


def history(profile):
    """Three batches: the second reaches back, repeats events and brings records without a time."""
    first = [record(profile, m, k, m + k) for m in range(0, 170, 7) for k in range(5)]
    second = [record(profile, m, k, 2 * m, moved=1) for m in (8, 9, 181, 182, 183) for k in (1, 7)] + [record(profile, None, 1, 5)]
    third = [record(profile, m, k, 900) for m in (182, 240) for k in (1, 2)]
    lines = [[line(profile, m, k) for m in range(0, 170, 11) for k in range(4)] + ["garbage"],
             [line(profile, 11, 1), line(profile, 11, 1, "other"), line(profile, 185, 9), line(profile, 185, 9)],
             [line(profile, 185, 9), line(profile, 238, 2), line(profile, 0, 0)]]
    return list(zip([first, second, third], lines))


@pytest.mark.parametrize("profile", [NETWORK, RETAIL])
def test_refresh_append_refresh_equals_a_full_run(spark, tmp_path, profile):
    tables = IncrementalTables(spark, profile, str(tmp_path / "gold"), merge_above=2)
    done, batches = ([], []), history(profile)
    for rows, lines in batches:
        tables.refresh(*frames(spark, profile, rows, lines))
        done[0].extend(rows)
        done[1].extend(lines)
    full = Tables(profile, *frames(spark, profile, *done))
    for name, (attribute, _) in GRAPHS[profile.name].items():
        assert content(tables.table(name)) == content(getattr(full, attribute)), name


def files(root, table):
    return {os.path.join(d, f) for d, _, names in os.walk(root / table) for f in names if f.endswith(".parquet")}


def test_only_touched_parts_are_written(spark, tmp_path):
    root, (batches) = tmp_path / "gold", history(NETWORK)
    tables = IncrementalTables(spark, NETWORK, str(root))
    first = tables.refresh(*frames(spark, NETWORK, *batches[0]))
    assert first["network_performance_5min"] == ["2026-01-07-10", "2026-01-07-11", "2026-01-07-12"]
    before = {t: files(root, t) for t in first}
    second = tables.refresh(*frames(spark, NETWORK, *batches[1]))
    assert second["network_performance_5min"] == second["metrics_by_location"] == ["2026-01-07-10", "2026-01-07-13"]
    assert second["network_metrics"] == ["2026-01-07-10", "2026-01-07-13", "none"]
    assert second["network_silver_events"] == ["2026-01-07-10", "2026-01-07-13"]  # repeated lines add nothing
    assert second["network_kpi_hourly"] == ["2026-01-07-10", "2026-01-07-13"] and second["device_health"] == ["all"]
    for table in ("network_performance_5min", "network_metrics", "network_kpi_hourly"):
        assert before[table] < files(root, table)  # what was there is left alone until vacuum
        added = files(root, table) - before[table]
        assert {f.split("part=")[1].split("/")[0] for f in added} == set(second[table])
    # Lines only: rollups of measurements are not computed again, the hour's KPI is.
    third = tables.refresh(lines=frames(spark, NETWORK, [], [line(NETWORK, 120, 1, "late")])[1])
    assert "network_performance_5min" not in third and third["network_kpi_hourly"] == ["2026-01-07-12"]
    assert tables.refresh(lines=frames(spark, NETWORK, [], [line(NETWORK, 120, 1, "late")])[1]).get("network_kpi_hourly") is None
    whole = content(tables.table("network_performance_5min"))
    gone = tables.store.vacuum(keep=1)
    assert any(g.startswith("network_performance_5min/") for g in gone) and content(tables.table("network_performance_5min")) == whole
    assert tables.store.vacuum(keep=1) == []
    one = content(tables.table("network_performance_5min", ["2026-01-07-12"]))
    assert one and len(one) < len(whole)


def test_a_batch_of_many_hours_is_few_files(spark, tmp_path):
    """Files grow with the rows, not with the hours; what is replaced, merged or removed goes by the hour all the same."""
    def rows(hours):
        return [record(NETWORK, 60 * h + m, k, h + m + k) for h in hours for m in (1, 31) for k in (1, 2)] + [record(NETWORK, None, 1, 5)]

    def lines(hours):
        return [line(NETWORK, 60 * h + 7, k) for h in hours for k in (1, 2)]

    tables = IncrementalTables(spark, NETWORK, str(tmp_path / "gold"), merge_above=2)
    batches, most = [range(60), range(0, 60, 2), [3, 4], [*range(5, 45), 59, 80]], 0
    for hours in batches:
        before = files(tmp_path, "gold")
        written = tables.refresh(*frames(spark, NETWORK, rows(hours), lines(hours)))
        assert written["network_kpi_hourly"] == [(START + timedelta(hours=h)).strftime("%Y-%m-%d-%H") for h in hours]
        if len(hours) > 24:
            most = max(most, len(files(tmp_path, "gold") - before))
    assert most <= 20 * 4  # some tables and merges, of at most as many files as there are shuffle partitions
    full = Tables(NETWORK, *frames(spark, NETWORK, [r for b in batches for r in rows(b)], [x for b in batches for x in lines(b)]))
    for attempt in range(2):
        for name, (attribute, _) in GRAPHS["network"].items():
            assert content(tables.table(name)) == content(getattr(full, attribute)), name
        assert bool(tables.store.vacuum(keep=1)) == (attempt == 0)
    hour = "2026-01-07-13"  # in a folder of its own since the third batch
    assert {r["window_start"].hour for r in tables.table("network_performance_5min", [hour]).collect()} == {13}
    assert sum(r["sample_count"] for r in tables.table("network_performance_5min", [hour, "2026-01-07-14"]).collect()) == 2 * 4 + 3 * 4


def test_either_input_may_come_first(spark, tmp_path):
    rows, lines = history(NETWORK)[0]
    records, text = frames(spark, NETWORK, rows, lines)
    full = Tables(NETWORK, records, text)
    for order in ((dict(records=records), dict(lines=text)), (dict(lines=text), dict(records=records))):
        tables = IncrementalTables(spark, NETWORK, str(tmp_path / next(iter(order[0]))))
        for given in order:
            tables.refresh(**given)
        for name in ("network_kpi_hourly", "device_health"):
            assert content(tables.table(name)) == content(getattr(full, GRAPHS["network"][name][0])), name


def test_a_dead_run_and_a_batch_handed_over_again(spark, tmp_path, monkeypatch):
    rows, lines = history(NETWORK)[0]
    records, text = frames(spark, NETWORK, rows, lines)
    tables = IncrementalTables(spark, NETWORK, str(tmp_path / "gold"))
    tables.refresh(records, text, source="s", batch=0)
    before = content(tables.table("network_performance_5min"))
    monkeypatch.setattr(IncrementalTables, "_health", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.refresh(records, source="s", batch=1)
    monkeypatch.undo()
    assert content(tables.table("network_performance_5min")) == before  # nothing of the dead run shows
    assert tables.refresh(records, source="s", batch=0) == {}
    assert tables.refresh(records, source="s", batch=1)["network_performance_5min"]
    counts = {r["sample_count"] for r in tables.table("network_performance_5min").collect()}
    assert counts == {2 * c for c in {b["sample_count"] for b in Tables(NETWORK, records, text).performance.collect()}}
    # Of two changes that started from the same state one is refused.
    one, two = (PartStore(spark, tables.store.root).current() for _ in range(2))
    one.publish()
    with pytest.raises(FileExistsError):
        two.publish()


def test_following_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tables = IncrementalTables(spark, NETWORK, str(tmp_path / "gold"))
    done = []
    for i, (_, lines) in enumerate(history(NETWORK)):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(lines) + "\n")
        done += lines
        stream = readers.read_text_stream(spark, str(tmp_path / "in"), max_files=1)
        tables.follow(stream, "lines", str(tmp_path / "ckpt"), measured=False).awaitTermination()
    full = Tables(NETWORK, *frames(spark, NETWORK, [], done))
    assert content(tables.table("network_silver_events")) == content(full.silver_events)


def test_late_records(spark, tmp_path):
    tables = IncrementalTables(spark, NETWORK, str(tmp_path / "gold"), watermark="10 minutes")
    batches = [[record(NETWORK, m, 1, 1) for m in (0, 30)], [record(NETWORK, m, 1, 2) for m in (14, 20, 60)] + [record(NETWORK, None, 1, 7)],
               [record(NETWORK, m, 1, 3) for m in (44, 50, 61)]]
    for rows in batches:
        tables.refresh(spark.createDataFrame(rows, RECORD.format(entity="device_id")))
    late = tables.table("late_records")
    assert sorted((r["event_timestamp"], r["value"]) for r in late.collect()) == [(START + timedelta(minutes=14), 2.0), (START + timedelta(minutes=44), 3.0)]
    assert {r["watermark"] for r in late.collect()} == {START + timedelta(minutes=m) for m in (20, 50)}
    on_time = [r for batch in batches for r in batch if r[-2] != 2.0 or r[0] != START + timedelta(minutes=14)]
    on_time = [r for r in on_time if r[-2] != 3.0 or r[0] != START + timedelta(minutes=44)]
    full = Tables(NETWORK, *frames(spark, NETWORK, on_time, []))
    assert content(tables.table("network_performance_5min")) == content(full.performance)
    assert tables.table("network_metrics").filter("event_timestamp IS NULL").count() == 1


def test_many_batches_are_few_folders(spark, tmp_path):
    path, expected, most = str(tmp_path / "t"), {}, 0
    for i in range(48):
        day = START + timedelta(days=i // 28)
        rows = [(day + timedelta(minutes=m), f"k{m}", i) for m in {i % 7, i % 50}]
        expected.update({(at, k): v for at, k, v in rows})
        df = spark.createDataFrame(rows, "window_start timestamp, k string, v int").coalesce(1)
        streams.upsert(spark, path, df, ["window_start", "k"], source="s", batch=i, fan=3)
        runs = PartStore(spark, path).current().parts[streams.ROWS]
        most = max(most, max(map(len, runs.values())))
        if i == 32:
            assert len(runs["2026-01-07"]) == 1  # a date that has passed is one run
            streams.upsert(spark, path, df, ["window_start", "k"], source="s", batch=i, fan=3)  # handed over again
    assert most <= 2 * 4  # two runs on each of the levels that 28 batches need
    got = {(r["window_start"], r["k"]): r["v"] for r in streams.read_latest(spark, path, ["window_start", "k"]).collect()}
    assert got == expected
    late = spark.createDataFrame([(START + timedelta(minutes=3), "k3", -1), (START, "new", -2)], "window_start timestamp, k string, v int")
    streams.upsert(spark, path, late, ["window_start", "k"])
    got = {(r["window_start"], r["k"]): r["v"] for r in streams.read_latest(spark, path, ["window_start", "k"]).collect()}
    assert got == expected | {(START + timedelta(minutes=3), "k3"): -1, (START, "new"): -2}
    assert len(os.listdir(tmp_path / "t" / streams.ROWS)) < 40  # replaced runs do not stay for ever


def test_history_is_not_read_again(spark, tmp_path):
    kept = History(spark, str(tmp_path / "h"), ["k"], ["v"])
    snapshots = [[(1, "a"), (2, "b"), (3, None)], [(1, "x"), (2, "b"), (4, "d")], [(1, "y"), (2, "b"), (3, "c")], [(1, "y")]]
    whole = None
    for day, rows in enumerate(snapshots, 1):
        new, at = spark.createDataFrame(rows, "k int, v string"), datetime(2026, 1, day)
        empty = spark.createDataFrame([], "k int, v string, effective_start_date timestamp, effective_end_date timestamp, is_active boolean")
        whole = scd2_merge(empty if whole is None else whole, new, ["k"], ["v"], at, True)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        closed = {f for f in files(tmp_path / "h", "history") if "part=open" not in f}
        stamps = {f: os.stat(f).st_mtime_ns for f in closed}
        if day == 4:
            for f in closed:
                os.chmod(f, 0o400)
                os.rename(f, f + ".away")  # a merge must not miss them
        written = kept.merge(new, at, True)
        if day == 4:
            for f in closed:
                os.rename(f + ".away", f)
        assert {f: os.stat(f).st_mtime_ns for f in closed} == stamps
        assert day == 1 or written == [f"2026-01-0{day}", "open"]
        assert content(kept.read()) == content(whole)
    assert content(kept.current()) == content(whole.filter("is_active"))
    at = kept.at("2026-01-02").collect()
    assert sorted((r["k"], r["v"]) for r in at) == [(1, "x"), (2, "b"), (4, "d")]


def test_trailing_counts_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    done = []
    for i, minutes in enumerate([(0, 3, 3, 58), (59, 61, 130), (131, 64)]):
        done += [line(NETWORK, m, m % 3, f"{i}-{m}-{j}") for j, m in enumerate(minutes)]
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(done[-len(minutes):]) + "\n")
    events = dedup_events(parse_log(readers.read_text_stream(spark, str(tmp_path / "in"), max_files=1), NETWORK), NETWORK, "3 hours")
    out = str(tmp_path / "out")
    refresh_panes(events, NETWORK, out, str(tmp_path / "c"), watermark=None).awaitTermination()
    batch = dedup_events(parse_log(spark.createDataFrame([(x,) for x in done], "value string"), NETWORK), NETWORK)
    got = content(trailing_counts(spark, NETWORK, out))
    assert got == content(sliding_event_counts(batch, NETWORK)) and len(got) > 12 * 5
    # Each event stands in one pane.
    panes = PartStore(spark, out).read(streams.ROWS)
    assert streams.read_latest(spark, out, pane_keys(NETWORK)).agg({"event_count": "sum"}).first()[0] == len(done) and panes.count() <= len(done)


def test_schema_growth_reads_its_own_batches_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    first = spark.createDataFrame([], "id int").schema

    def run(name, *lines):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        return ingest_json(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "home"), first).simpleString()

    # Which type a key gets depends on the values of all runs until it joins the schema.
    assert run("a.json", '{"id": 1, "up": 7, "x": "1.5"}') == "struct<id:int,up:bigint,x:double>"
    for f in files(tmp_path, "out"):
        os.rename(f, f + ".away")
    assert run("b.json", '{"id": 2, "fw": true, "up": 8}', '{"id": 3, "fw": "no way"}') == "struct<id:int,up:bigint,x:double,fw:string>"


def test_the_newest_whole_version(spark, tmp_path):
    save = table_writer(spark, str(tmp_path))
    save("t", spark.range(3))
    dead = tmp_path / "t" / "version=9999999999999999999"
    dead.mkdir()
    (dead / "part-0.parquet").write_text("cut")
    assert latest_table(spark, str(tmp_path), "t").count() == 3


def test_a_second_refresh_of_fixed_input_warns(spark):
    records, lines = frames(spark, NETWORK, *history(NETWORK)[0])
    tables = Tables(NETWORK, records, lambda: lines)
    refresh(tables, lambda name, df: df, only=["network_metrics"])
    with pytest.warns(UserWarning, match="records keep to the files"):
        refresh(tables, lambda name, df: df, only=["network_metrics"])
