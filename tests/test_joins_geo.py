"""Bucketed and grid operators against brute force on small seeded data."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconry.operators import geo
from beaconry.operators.geo import geo_within, near_point, nearest_k, nearest_other, neighbour_counts, top_bottom_n
from beaconry.operators.joins import (
    interval_join, interval_sums, split_hot_groups, window_containment_join, windows_after,
)
from beaconry.plans.maps import market_saturation

START = datetime(2026, 1, 7)


def _times(spark, name, seed, rows, hot):
    """Half of the rows belong to one entity and instant-heavy stretch."""
    rng = random.Random(seed)
    data = [(i, "hot" if rng.random() < hot else f"d{rng.randrange(4)}",
             START + timedelta(seconds=rng.randrange(1800))) for i in range(rows)]
    data.append((rows, None, START))
    return data, spark.createDataFrame(data, f"{name}_id int, device string, {name}_time timestamp")


@pytest.mark.parametrize("closed", [(True, True), (False, True), (True, False)])
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("split", [None, 3])
def test_interval_join(spark, closed, how, split):
    left, ldf = _times(spark, "l", 1, 120, 0.5)
    right, rdf = _times(spark, "r", 2, 90, 0.5)
    lo, hi = timedelta(minutes=5), timedelta(minutes=2)
    expected = set()
    for lid, lk, lt in left:
        found = {(lid, rid) for rid, rk, rt in right if lk is not None and lk == rk
                 and (lt - lo <= rt if closed[0] else lt - lo < rt) and (rt <= lt + hi if closed[1] else rt < lt + hi)}
        expected |= found or ({(lid, None)} if how == "left" else set())
    joined = interval_join(ldf, rdf, ["device"], "l_time", "r_time", "5 minutes", "2 minutes", how, closed, split)
    got = [(r.l_id, r.r_id) for r in joined.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_on_both_sides(spark, how):
    """One key has nearly all rows, many of them equal; no piece of a side is large, and equal rows spread."""
    left = spark.createDataFrame([("hot", START)] * 400 + [("hot", START + timedelta(days=1)), ("d", START), (None, START), ("d", None)],
                                 "device string, l_time timestamp")
    right = spark.createDataFrame([("hot", START)] * 300 + [("x", START)], "device string, r_time timestamp")
    joined = interval_join(left, right, ["device"], "l_time", "r_time", "5 minutes", "5 minutes", how, rows_per_part=25)
    assert joined.filter("r_time IS NOT NULL").count() == 400 * 300
    assert joined.filter("r_time IS NULL").count() == (4 if how == "left" else 0)
    rows = [df.withColumns({"_bucket": F.lit(0), "_row": F.monotonically_increasing_id()}) for df in (left, right)]
    for side in split_hot_groups(*rows, ["device", "_bucket"], 25):
        sizes = [r["count"] for r in side.groupBy("device", "_part").count().collect()]
        assert max(sizes) <= 60


def test_interval_ends_belong(spark):
    s = spark.createDataFrame([("d", START)], "device string, l_time timestamp")
    e = spark.createDataFrame([("d", START + timedelta(minutes=m)) for m in (-5, 5, 6)], "device string, r_time timestamp")
    assert interval_join(s, e, ["device"], "l_time", "r_time", "5 minutes", "5 minutes").count() == 2
    sums = interval_sums(s, e, ["device"], "l_time", "r_time", "5 minutes", "5 minutes", {"n": F.lit(1)})
    assert sums.first().n == 2


@pytest.mark.parametrize("before,after", [("5 minutes", "5 minutes"), ("90 seconds", "0 seconds")])
def test_interval_sums_equal_pairs(spark, before, after):
    left, ldf = _times(spark, "l", 3, 200, 0.6)
    right, rdf = _times(spark, "r", 4, 300, 0.6)
    rdf = rdf.withColumn("w", F.col("r_id") % 3)
    pairs = (interval_join(ldf, rdf, ["device"], "l_time", "r_time", before, after, "left").groupBy("l_id")
             .agg(F.count("r_id").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("w")))
    sums = interval_sums(ldf, rdf, ["device"], "l_time", "r_time", before, after,
                         {"n": F.lit(1), "w": F.col("w")}).select("l_id", "n", "w")
    assert sums.count() == len(left)
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, pairs.collect()))


def test_containment_is_half_open(spark):
    calls = spark.createDataFrame([(1, "d", START + timedelta(minutes=5)), (2, "d", START + timedelta(minutes=4))],
                                  "id int, device string, at timestamp")
    windows = spark.createDataFrame([("d", START, 1.0), ("d", START + timedelta(minutes=5), 2.0)],
                                    "device string, window_start timestamp, v double")
    got = {r.id: r.v for r in window_containment_join(calls, windows, ["device"], "at").collect()}
    assert got == {1: 2.0, 2: 1.0}


def test_windows_after(spark):
    events = spark.createDataFrame([(0, START), (1, START + timedelta(seconds=1))], "id int, at timestamp")
    got = [(r.id, (r.window_start - START).seconds // 60)
           for r in windows_after(events, "at", "15 minutes").orderBy("id", "window_start").collect()]
    assert got == [(0, 0), (0, 5), (0, 10), (0, 15), (1, 5), (1, 10), (1, 15)]


def _km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
    return 12742 * math.asin(min(1, math.sqrt(h)))


def _points(spark, seed, centres, n, spread):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        lat, lon = centres[i % len(centres)]
        lon = (lon + rng.uniform(-spread, spread) + 180) % 360 - 180
        data.append((i, "ABC"[rng.randrange(3)], max(-90.0, min(90.0, lat + rng.uniform(-spread, spread))), lon))
    data.append((n, data[0][1], data[0][2], data[0][3]))  # same place, same brand
    data.append((n + 1, "D", data[1][2], data[1][3]))     # same place, other brand
    return data, spark.createDataFrame(data, "id int, brand string, latitude double, longitude double")


# A city, the antimeridian, high latitude, the pole.
CENTRES = [(34.0, -118.2), (10.0, 179.99), (70.0, 25.0), (89.9, 40.0)]


@pytest.mark.parametrize("km", [5.0, 40.0])
def test_geo_within(spark, km):
    data, df = _points(spark, 5, CENTRES, 120, 0.3)
    joined = geo_within(df, df, km, F.col("id") != F.col("near_id"), "left")
    got = {(r.id, r.near_id) for r in joined.collect()}
    expected = set()
    for a in data:
        found = {(a[0], b[0]) for b in data if a[0] != b[0] and _km(a[2:], b[2:]) <= km}
        expected |= found or {(a[0], None)}
    assert got == expected and joined.count() == len(got)


@pytest.mark.parametrize("km,cells", [(5.0, 8), (60.0, 4)])
def test_neighbour_counts(spark, km, cells):
    data, df = _points(spark, 6, CENTRES, 150, 0.2)
    got = {r.id: (r.same_group_count, r.other_group_count)
           for r in neighbour_counts(df, km, "brand", cells, "id").collect()}
    for a in data:
        near = [b for b in data if b[0] != a[0] and _km(a[2:], b[2:]) <= km]
        same = sum(b[1] == a[1] for b in near)
        assert got[a[0]] == (same, len(near) - same)


def test_neighbour_counts_of_odd_rows(spark):
    """Two of one brand, one without brand, one without place, and a second row of the first."""
    rows = [("a", "B1", 34.0, -118.0, "west"), ("b", "B1", 34.0009, -118.0, "west"), ("c", None, 34.0, -118.0, "west"),
            ("d", "B2", None, None, "west"), ("a", "B1", 34.0, -118.0, "east"), ("e", "B2", 34.0, -118.0009, "west")]
    df = spark.createDataFrame(rows, "store_id string, brand string, latitude double, longitude double, region string")
    got = sorted((r.store_id, r.region, r.same_group_count, r.other_group_count) for r in neighbour_counts(df, 5.0, "brand").collect())
    assert got == [("a", "east", 1, 1), ("a", "west", 1, 1), ("b", "west", 1, 1), ("c", "west", 0, 0), ("d", "west", 0, 0),
                   ("e", "west", 0, 2)]


def test_nearest_other(spark):
    data, df = _points(spark, 7, [*CENTRES, (-33.9, 151.2)], 90, 0.5)
    got = {r.id: r.nearest_km for r in nearest_other(df, "brand").collect()}
    assert len(got) == len(data)
    for a in data:
        assert got[a[0]] == pytest.approx(min(_km(a[2:], b[2:]) for b in data if b[1] != a[1]), abs=1e-6)


@pytest.mark.parametrize("crowd", [1, 40, 10_000])
def test_nearest_of_another_key(spark, crowd):
    """Some keys have several places and several groups; crowded cells are cut to any depth."""
    data, _ = _points(spark, 9, CENTRES, 90, 0.5)
    data = [(i % 60, *rest) for i, *rest in data]
    df = spark.createDataFrame(data, "id int, brand string, latitude double, longitude double")
    rows = nearest_other(df, "brand", key="id", crowd=crowd, split=4, levels=7).collect()
    assert len(rows) == len(data)
    for r in rows:
        best = min(_km((r.latitude, r.longitude), b[2:]) for b in data if b[1] != r.brand and b[0] != r.id)
        assert r.nearest_km == pytest.approx(best, abs=1e-6)
    own = spark.createDataFrame([("a", "X", 1.0, 1.0), ("a", "Y", 1.0, 1.1)], "id string, brand string, latitude double, longitude double")
    assert [r.nearest_km for r in nearest_other(own, "brand", key="id").collect()] == [None, None]


@pytest.mark.parametrize("k,km,group,crowd", [(1, 500.0, None, 10_000), (3, 60.0, "brand", 20), (4, 20_100.0, None, 50)])
def test_nearest_k(spark, k, km, group, crowd):
    data, _ = _points(spark, 10, CENTRES, 80, 0.5)
    data = [(i % 65, *rest) for i, *rest in data] + [(900, None, *data[0][2:]), (901, data[0][1], None, None)]
    df = spark.createDataFrame(data, "store_id int, brand string, latitude double, longitude double")
    got = {}
    for r in nearest_k(df, k, km, group=group, crowd=crowd).collect():
        got.setdefault(r.store_id, []).append((r.place, r.near_store_id, r.distance_km))
    known = [d for d in data if d[2] is not None and (not group or d[1] is not None)]
    for a in {d[0] for d in known}:
        best = {}
        for x in known:
            for y in known:
                if x[0] == a and y[0] != a and (not group or x[1] == y[1]) and _km(x[2:], y[2:]) <= km:
                    best[y[0]] = min(best.get(y[0], 1e9), _km(x[2:], y[2:]))
        found = sorted(got.get(a, []))
        assert [d for _, _, d in found] == pytest.approx(sorted(best.values())[:k], abs=1e-6)
        assert [best[i] for _, i, _ in found] == pytest.approx([d for _, _, d in found], abs=1e-6) and len({i for _, i, _ in found}) == len(found)


def _compared(run):
    """A result, and how many rows each comparison of places made for it."""
    seen = []
    plain = geo._compare

    def counted(*args):
        out = plain(*args)
        seen.append(out.count())
        return out

    geo._compare = counted
    try:
        return run(), seen
    finally:
        geo._compare = plain


@pytest.mark.parametrize("copies", [20, 40])
def test_crowded_places_are_compared_once(spark, copies):
    """Many keys at few places, of which each key has several."""
    spots = [(34.0 + i / 100, -118.0 + i % 3 / 100) for i in range(12)]
    data = [(n % (copies * 6), "AB"[n % 5 % 2], *spots[n % 12]) for n in range(12 * copies)] + [(None, "A", 34.005, -118.0)]
    df = spark.createDataFrame(data, "store_id int, brand string, latitude double, longitude double")
    rows, pairs = _compared(lambda: nearest_other(df, "brand", key="store_id").collect())
    assert len(rows) == len(data) and sum(pairs) < 24 * 24 * 2
    for r in rows:
        best = min(_km((r.latitude, r.longitude), b[2:]) for b in data if b[1] != r.brand and (r.store_id is None or b[0] != r.store_id))
        assert r.nearest_km == pytest.approx(best, abs=1e-6)
    got, pairs = _compared(lambda: nearest_k(df, 3, 30.0).collect())
    assert sum(pairs) <= 13 * 13 * 4  # not all rows with one another
    for a in {d[0] for d in data} - {None}:
        best = {}
        for x in data:
            for y in data:
                if x[0] == a and y[0] not in (a, None):
                    best[y[0]] = min(best.get(y[0], 1e9), _km(x[2:], y[2:]))
        found = sorted((r.place, r.near_store_id, r.distance_km) for r in got if r.store_id == a)
        assert [i for _, i, _ in found] == [i for i, _ in sorted(((i, round(d, 7)) for i, d in best.items()), key=lambda p: (p[1], p[0]))[:3]]
        assert [best[i] for _, i, _ in found] == pytest.approx([d for _, _, d in found], abs=1e-6)


def test_neighbours_of_keys_at_several_places(spark):
    rows = [("a", "B1", 34.0, -118.0), ("a", "B1", 34.001, -118.0), ("b", "B1", 34.0, -118.001), ("c", "B1", 34.0, -118.002),
            ("c", "B2", 34.0, -118.002), ("d", "B2", 34.002, -118.0)]
    df = spark.createDataFrame(rows, "store_id string, brand string, latitude double, longitude double")
    got = {(r.store_id, r.brand): (r.same_group_count, r.other_group_count) for r in neighbour_counts(df, 5.0, "brand").collect()}
    assert got == {("a", "B1"): (2, 2), ("b", "B1"): (2, 2), ("c", "B1"): (2, 1), ("c", "B2"): (1, 2), ("d", "B2"): (1, 3)}


@pytest.mark.parametrize("km,cells", [(5.0, 8), (60.0, 4)])
def test_neighbour_counts_by_key(spark, km, cells):
    data, _ = _points(spark, 11, CENTRES, 120, 0.3)
    data = [(i % 80, *rest) for i, *rest in data]
    df = spark.createDataFrame(data, "id int, brand string, latitude double, longitude double")
    for r in neighbour_counts(df, km, "brand", cells, "id").collect():
        near = [b for b in data if b[0] != r.id and _km((r.latitude, r.longitude), b[2:]) <= km]
        assert r.same_group_count == len({b[0] for b in near if b[1] == r.brand})
        assert r.other_group_count == len({b[0] for b in near if b[1] != r.brand})


@pytest.mark.parametrize("crowd,cells", [(1, 2), (30, 3), (2000, 8)])
def test_neighbour_counts_of_crowds(spark, crowd, cells):
    """Crowded cells are cut to any depth; some keys have several places and several groups."""
    data, _ = _points(spark, 13, CENTRES, 150, 0.06)
    data = [(i % 70 if i % 3 else 1000 + i, *rest) for i, *rest in data]
    df = spark.createDataFrame(data, "id int, brand string, latitude double, longitude double")
    rows = neighbour_counts(df, 6.0, "brand", cells, "id", crowd=crowd).collect()
    assert len(rows) == len(data)
    for r in rows:
        near = [b for b in data if b[0] != r.id and _km((r.latitude, r.longitude), b[2:]) <= 6.0]
        assert r.same_group_count == len({b[0] for b in near if b[1] == r.brand})
        assert r.other_group_count == len({b[0] for b in near if b[1] != r.brand})


@pytest.mark.parametrize("build", [lambda df: neighbour_counts(df, 5.0, "brand"), market_saturation])
def test_neighbours_of_crowded_places_are_compared_once(spark, build):
    """Many keys at few places, of which each key has several: places meet keys, not all rows one another."""
    spots = [(34.0 + i / 100, -118.0 + i % 3 / 100) for i in range(12)]
    data = [(f"s{n % 110}", "AB"[n % 7 % 2], *spots[n % 12], "west", "fast_food") for n in range(480)]
    df = spark.createDataFrame(data, "store_id string, brand string, latitude double, longitude double, region string, store_category string")
    seen, plain = [], {name: getattr(geo, name) for name in ("geo_within", "_beside") if hasattr(geo, name)}

    def counted(name):
        def run(*args, **named):
            out = plain[name](*args, **named)
            seen.append(out.count())
            return out
        return run

    for name in plain:
        setattr(geo, name, counted(name))
    try:
        rows = build(df).collect()
    finally:
        for name in plain:
            setattr(geo, name, plain[name])
    assert len(rows) == len(data) and seen and sum(seen) <= 12 * 480 + 480 * 8
    for r in rows[::7]:
        near = [b for b in data if b[0] != r.store_id and _km((r.latitude, r.longitude), b[2:4]) <= 5.0]
        want = len({b[0] for b in near if b[1] == r.brand}), len({b[0] for b in near if b[1] != r.brand})
        got = r.asDict()
        assert (got.get("same_group_count", got.get("nearby_same_brand_count")),
                got.get("other_group_count", got.get("nearby_competitor_count"))) == want


def test_nearest_other_without_competitor(spark):
    df = spark.createDataFrame([(1, "A", 0.0, 0.0), (2, "A", 1.0, 1.0)], "id int, brand string, latitude double, longitude double")
    assert nearest_other(df, "brand").count() == 0


def test_near_point(spark):
    data, df = _points(spark, 8, CENTRES[:1], 60, 0.3)
    got = {r.id for r in near_point(df, 34.0, -118.2, 20.0).collect()}
    assert got == {a[0] for a in data if _km((34.0, -118.2), a[2:]) <= 20.0}


def test_top_bottom(spark):
    df = spark.createDataFrame([("r", i, float(i)) for i in range(8)] + [("s", 1, 1.0)], "g string, id int, v double")
    got = {(r.g, r.id): r.performance_tier for r in top_bottom_n(df, "g", "v", 3, "id").collect()}
    assert {k[1] for k, t in got.items() if t == "Top Performer" and k[0] == "r"} == {0, 1, 2}
    assert {k[1] for k, t in got.items() if t == "Bottom Performer"} == {5, 6, 7}
    assert got["s", 1] == "Top Performer"
