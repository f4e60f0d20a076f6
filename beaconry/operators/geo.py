"""Distance joins on a latitude/longitude grid.

Bands have equal height; each band has its own whole number of columns, chosen so that a
cell is at least as wide as high.  Column numbers wrap at the antimeridian, and the band at
a pole is a single ring of few cells, so the whole globe is covered without special cases.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.functions.geo import EARTH_RADIUS_KM, KM_PER_DEGREE, haversine_km
from beaconry.session import persist_table

_SLACK_KM = 1e-6  # rounding guard for cell bounds; exact distances decide afterwards
_SLACK_CHORD = 1e-12  # the same for squares of chords of a sphere of radius 1


class Grid:
    """Cells ``height`` degrees high; ``split`` > 1 cuts every coarse cell into split x split.

    Methods return SQL text over column names.
    """

    def __init__(self, height: float, split: int = 1):
        self.coarse, self.split = height, split
        self.height = height / split

    def band(self, lat: str) -> str:
        last = math.ceil(180 / self.coarse) * self.split - 1
        return f"CAST(least(floor(({lat} + 90) / {self.height!r}D), {last}) AS BIGINT)"

    def columns(self, band: str) -> str:
        """Number of cells in a band."""
        south = f"(floor({band} / {self.split}) * {self.coarse!r}D - 90)"
        widest = f"least(greatest(abs({south}), abs({south} + {self.coarse!r}D)), 90)"
        return (f"CAST(greatest(floor(cos(radians({widest})) * {360 / self.coarse!r}D), 1) * {self.split}"
                " AS BIGINT)")

    def place(self, df: DataFrame, lat: str, lon: str, band: str = "_band", cell: str = "_cell") -> DataFrame:
        df = df.withColumn(band, F.expr(self.band(lat))).withColumn("_columns", F.expr(self.columns(band)))
        wrapped = f"pmod(CAST(floor(({lon} + 180) * _columns / 360) AS BIGINT), _columns)"
        return df.withColumn(cell, F.expr(wrapped)).drop("_columns")

    def with_box(self, df: DataFrame, band: str, cell: str, prefix: str) -> DataFrame:
        """Add centre and half width of a cell, in degrees: ``<prefix>lat``, ``lon``, ``half``."""
        width = f"(360D / {self.columns(band)})"
        return df.withColumn(f"{prefix}half", F.expr(f"{width} / 2")).withColumns({
            f"{prefix}lat": F.expr(f"{band} * {self.height!r}D - 90 + {self.height / 2!r}D"),
            f"{prefix}lon": F.expr(f"(2 * {cell} + 1) * {prefix}half - 180")})

    def reach(self, df: DataFrame, south: str, north: str, west: str, east: str, km: float,
              band: str = "_band", cell: str = "_cell") -> DataFrame:
        """Repeat rows for every cell that may hold a point within ``km`` of the box."""
        degrees = (km + _SLACK_KM) / KM_PER_DEGREE
        widest = f"greatest(abs({south}), abs({north}))"
        spread = (f"CASE WHEN {widest} + {degrees!r}D >= 90 THEN 180D ELSE 1e-9D + degrees(asin(least(1D,"
                  f" {math.sin(math.radians(degrees))!r}D / cos(radians({widest}))))) END")
        df = df.withColumn("_spread", F.expr(spread)).withColumn(band, F.explode(F.expr(
            f"sequence({self.band(f'greatest({south} - {degrees!r}D, -90D)')},"
            f" {self.band(f'least({north} + {degrees!r}D, 90D)')})")))
        df = df.withColumn("_columns", F.expr(self.columns(band))).withColumns({
            "_first": F.expr(f"CAST(floor(({west} - _spread + 180) * _columns / 360) AS BIGINT)"),
            "_last": F.expr(f"CAST(floor(({east} + _spread + 180) * _columns / 360) AS BIGINT)")})
        ring = ("CASE WHEN _last - _first + 1 >= _columns THEN sequence(0L, _columns - 1)"
                " ELSE transform(sequence(_first, _last), i -> pmod(i, _columns)) END")
        return df.withColumn(cell, F.explode(F.expr(ring))).drop("_spread", "_columns", "_first", "_last")


def _with_bounds(df: DataFrame, height: float) -> DataFrame:
    """Add ``_near`` and ``_far``: smallest and largest distance between points of the cells whose
    boxes are in ``a_`` and ``b_`` columns."""
    def cosine(box: str, toward_pole: bool) -> str:
        edge = (f"least(abs({box}lat) + {height / 2!r}D, 90)" if toward_pole
                else f"greatest(abs({box}lat) - {height / 2!r}D, 0)")
        return f"cos(radians({edge}))"

    def distance(lat: str, lon: str, toward_pole: bool) -> Column:
        h = (f"pow(sin(radians({lat}) / 2), 2) + {cosine('a_', toward_pole)} * {cosine('b_', toward_pole)}"
             f" * pow(sin(radians({lon}) / 2), 2)")
        return F.expr(f"{2.0 * EARTH_RADIUS_KM!r}D * asin(sqrt(least({h}, 1D)))")

    gaps = df.withColumns({
        "_dlat": F.expr("abs(a_lat - b_lat)"),
        "_dlon": F.expr("abs(pmod(a_lon - b_lon + 180, 360D) - 180)"), "_width": F.expr("a_half + b_half")})
    return gaps.withColumns({
        "_near": distance(f"greatest(_dlat - {height!r}D, 0)", "greatest(_dlon - _width, 0)", True),
        "_far": distance(f"least(_dlat + {height!r}D, 180)", "least(_dlon + _width, 180)", False),
    }).drop("_dlat", "_dlon", "_width")


def geo_within(left: DataFrame, right: DataFrame, km: float, extra: Column | None = None,
               how: str = "inner", distance: str = "distance_km",
               left_point: Sequence[str] = ("latitude", "longitude"),
               right_point: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """Pairs at most ``km`` apart.  Right columns are prefixed ``near_``; ``extra`` may use them.

    Left points stay in one cell, right points are repeated into the cells within reach, so
    pairs are unique and ``how='left'`` keeps unmatched rows.
    """
    grid = Grid(max(km, 1e-3) / KM_PER_DEGREE)
    lhs = grid.place(left, *left_point, "_band", "_cell")
    rhs = right.withColumnsRenamed({c: f"near_{c}" for c in right.columns})
    near = [f"near_{c}" for c in right_point]
    lat, lon = near
    rhs = grid.reach(rhs, lat, lat, lon, lon, km, "_near_band", "_near_cell")
    measured = haversine_km(*[F.col(c) for c in (*left_point, lat, lon)])
    condition = ((F.col("_band") == F.col("_near_band")) & (F.col("_cell") == F.col("_near_cell"))
                 & (measured <= km))
    if extra is not None:
        condition = condition & extra
    return (lhs.join(rhs, condition, how).withColumn(distance, measured)
            .drop("_band", "_cell", "_near_band", "_near_cell"))


def near_point(points: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Points within ``km`` of one place.  The latitude range is a plain comparison that reaches
    the scan, so row groups outside it are skipped."""
    degrees = (km + _SLACK_KM) / KM_PER_DEGREE
    boxed = points.filter(F.col("latitude").between(lat - degrees, lat + degrees))
    measured = boxed.withColumn("distance_km", haversine_km(lat, lon, F.col("latitude"), F.col("longitude")))
    return measured.filter(F.col("distance_km") <= km)


CROWD = 1_000_000  # point pairs of a cell that are compared rather than cut further


def _groups_of(known: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that stand at more than one place or in more than one group, and whether in more than one group."""
    seen = known.groupBy(key).agg(F.count(F.lit(1)).alias("_places"), (F.min(group) != F.max(group)).alias("_mixed"))
    return seen.filter("_places > 1").select(key, F.lit(True).alias("_several"), "_mixed")


# A key of which groups _lo to _hi were known to be near, and groups _gs are found near: one row for each new group (_s, keys of
# that group), and the key taken out as it was and put in as it is (_t, keys; _o, keys of no other group than _g).
_FOUND = """inline(concat(
    transform(_gs, x -> named_struct('_g', x, '_s', 1L, '_t', 0L, '_o', 0L)),
    filter(array(
        named_struct('_g', least(_lo, array_min(_gs)), '_s', 0L, '_t', 1L,
                     '_o', CAST(least(_lo, array_min(_gs)) = greatest(_hi, array_max(_gs)) AS BIGINT)),
        named_struct('_g', _lo, '_s', 0L, '_t', -1L, '_o', -CAST(_lo = _hi AS BIGINT))), x -> x._g IS NOT NULL)))"""
_COUNTS = ["_s", "_t", "_o"]
_PLACE = ["latitude", "longitude"]


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _COUNTS]


def _rings(left: DataFrame, right: DataFrame, by: Sequence[str], own: Sequence[str], km: float, height: float, split: int,
           levels: int, crowd: int) -> tuple[DataFrame, DataFrame, int]:
    """What lies wholly within ``km`` of each cell, what has to be compared point by point, and the number of levels walked.

    A walk from cells as high as the radius down: the points of ``right``, cell by cell and ``by`` group (and key),
    lie wholly within the radius of a cell of ``left``, or wholly outside, or are cut by the circle. What is cut is compared if
    that makes at most ``crowd`` pairs of points for the cell, otherwise both cells are cut ``split`` x ``split``.
    With a key in ``by``, each group of a key counts once: what of it is cut is dropped where more of it lies wholly inside.
    Only equal ``own`` meet.
    """
    a, b = ["_ab", "_ac"], ["_bb", "_bc"]
    unit, keyed = [*a, *own], "_key" in by

    def coarser(points: DataFrame, level: int, names: Sequence[str], keep: Sequence[str], *numbers: Column) -> DataFrame:
        width = split ** (levels - 1 - level)
        up = [F.floor(F.col(c) / width).cast("long").alias(n) for c, n in zip(("_band", "_cell"), names)]
        return points.groupBy(*up, *keep).agg(*numbers)

    def bounded(pairs: DataFrame, grid: Grid) -> DataFrame:
        near = _with_bounds(pairs, grid.height).filter(F.col("_near") <= km + _SLACK_KM)
        return near.select(*unit, *b, F.col("_m"), (F.col("_far") <= km - _SLACK_KM).alias("_whole"), *[c for c in pairs.columns if c[:2] == "_p"])

    whole, rim, open_ = [], [], None
    for level in range(levels):
        grid = Grid(height, split ** level)
        units = coarser(left, level, a, own, F.count(F.lit(1)).alias("_m"))
        aims = coarser(right, level, b, by, F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_c"))
        if open_ is None:
            half = grid.height / 2
            reached = grid.reach(grid.with_box(units, *a, "a_"), f"(a_lat - {half!r}D)", f"(a_lat + {half!r}D)",
                                 "(a_lon - a_half)", "(a_lon + a_half)", km, *b)
            found = bounded(grid.with_box(reached.join(aims.select(*b, *own).distinct(), [*b, *own]), *b, "b_"), grid).join(aims, [*b, *own])
            if keyed:
                nothing = F.lit(None).cast(right.schema["_g"].dataType)
                found = found.withColumns({"_lo": nothing, "_hi": nothing})
        else:
            # A few cells make many pairs, so these are spread before they are made; their bounds are taken once for all in them.
            parts = [F.floor(F.col(c) / split).cast("long").alias(f"_p{c}") for c in (*a, *b)]
            pa, pb = ["_p_ab", "_p_ac"], ["_p_bb", "_p_bc"]
            wider = open_.drop("_m", "_n", "_c", "_whole", "_gs").withColumnsRenamed({c: f"_p{c}" for c in (*a, *b)})
            cells = grid.with_box(aims.select(*b, *own).distinct(), *b, "b_").select("*", *parts[2:])
            pairs = (wider.select(*pa, *pb, *own).distinct().join(grid.with_box(units, *a, "a_").select("*", *parts[:2]), [*pa, *own])
                     .repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), *unit).join(cells, [*pb, *own]))
            inner = wider.join(aims.select("*", *parts[2:]), [*pb, *by])
            found = inner.join(bounded(pairs, grid), [*pa, *pb, *b, *own]).drop(*pa, *pb)
        if keyed:
            inside = F.collect_set(F.when(F.col("_whole"), F.col("_g")))
            found = found.withColumn("_gs", inside.over(Window.partitionBy(*a, "_key")))
        found = persist_table(found, "cells")
        rest, at = found.filter(~F.col("_whole")), F.lit(level).alias("_level")
        if keyed:
            new = found.filter("_whole").dropDuplicates([*a, "_key"]).select(at, *unit, F.expr(_FOUND))
            rest = rest.filter("NOT array_contains(_gs, _g)").withColumns({
                "_lo": F.expr("least(_lo, array_min(_gs))"), "_hi": F.expr("greatest(_hi, array_max(_gs))")})
        else:
            new = found.filter("_whole").select(at, *unit, "_g", *[F.col("_n").alias(c) for c in _COUNTS])
        whole.append(new.groupBy("_level", *unit, "_g").agg(*_sums()))
        loads = rest.groupBy(*unit).agg((F.first("_m") * F.sum("_c")).alias("_pairs"))
        crowded = loads.filter(F.col("_pairs") > crowd).select(*unit)
        last = level == levels - 1 or crowded.isEmpty()
        done = rest if last else rest.join(crowded, unit, "left_anti")
        rim.append(done.select(at, *a, *b, *by, *(["_lo", "_hi"] if keyed else [])))
        if last:
            break
        open_ = rest.join(crowded, unit, "left_semi")
    return reduce(DataFrame.unionByName, whole), reduce(DataFrame.unionByName, rim), len(rim)


def _on_sphere(df: DataFrame, prefix: str) -> DataFrame:
    lat, lon = F.radians("latitude"), F.radians("longitude")
    return df.withColumns({f"{prefix}x": F.cos(lat) * F.cos(lon), f"{prefix}y": F.cos(lat) * F.sin(lon), f"{prefix}z": F.sin(lat)})


def _beside(rim: DataFrame, walked: int, left: DataFrame, right: DataFrame, by: Sequence[str], own: Sequence[str], levels: int,
            split: int) -> DataFrame:
    """Left points beside the right points (``_lat``, ``_lon``, ...) they are to be compared with.

    All of a cell are in one partition, so what is then grouped by cell and point is not shuffled.
    """
    unit = ["_level", "_ab", "_ac", *own]
    theirs = _at_levels(right.withColumnsRenamed({"latitude": "_lat", "longitude": "_lon"}), levels, split, walked, ("_bb", "_bc"))
    mine = _at_levels(left, levels, split, walked, ("_ab", "_ac"))
    return rim.join(theirs, ["_level", "_bb", "_bc", *by]).drop("_bb", "_bc").repartition(*unit).join(mine, unit)


def _counted(left: DataFrame, right: DataFrame, by: Sequence[str], own: Sequence[str], km: float, height: float, split: int,
             levels: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Counts within ``km``: those of whole cells (``_level``, ``_ab``, ``_ac``) and those of single points, by group ``_g``.

    ``_s`` are keys of the group; ``_t`` are keys, each told under one of its groups; ``_o`` are keys of no other group.
    """
    places = left.select(*_PLACE, *own, "_band", "_cell").distinct()
    whole, rim, walked = _rings(places, right, by, own, km, height, split, levels, crowd)
    met = _beside(rim, walked, _on_sphere(places, "_"), _on_sphere(right, "_their_"), by, own, levels, split)
    # The square of the chord decides all but the pairs at the very edge, which take the exact distance.
    chord = reduce(Column.__add__, [(F.col(f"_{c}") - F.col(f"_their_{c}")) * (F.col(f"_{c}") - F.col(f"_their_{c}")) for c in "xyz"])
    edge = 4 * math.sin(min(km / (2 * EARTH_RADIUS_KM), math.pi / 2)) ** 2
    exact = haversine_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")) <= km
    met = met.filter((chord < edge - _SLACK_CHORD) | ((chord <= edge + _SLACK_CHORD) & exact))
    cell = ["_level", "_ab", "_ac"]
    if "_key" in by:
        found = met.groupBy(*cell, *_PLACE, "_key", "_lo", "_hi").agg(F.collect_set("_g").alias("_gs"))
        met = found.select(*cell, *_PLACE, *own, F.expr(_FOUND))
    else:
        met = met.select(*cell, *_PLACE, "_g", *[F.col("_n").alias(c) for c in _COUNTS])
    return whole, met.groupBy(*cell, *_PLACE, *own, "_g").agg(*_sums()).drop(*cell)


def _summed(spots: DataFrame, counts: Sequence[tuple[DataFrame, DataFrame]], own: Sequence[str], levels: int, split: int) -> DataFrame:
    """Spots (``latitude``, ``longitude``, ``_g``, ``own``) with ``_same`` keys of their group near, and ``_other`` of another one."""
    cell, place = ["_level", "_ab", "_ac", *own], [*_PLACE, *own]
    whole = persist_table(reduce(DataFrame.unionByName, [w for w, _ in counts]).groupBy(*cell, "_g").agg(*_sums()), "counts")
    single = persist_table(reduce(DataFrame.unionByName, [s for _, s in counts]).groupBy(*place, "_g").agg(*_sums()), "counts")

    def put_on(df: DataFrame, found: DataFrame, on: Sequence[str], mark: str) -> DataFrame:
        alike = found.select(*on, "_g", F.col("_s").alias(f"_s{mark}"), F.col("_o").alias(f"_o{mark}"))
        every = found.groupBy(*on).agg(F.sum("_t").alias(f"_t{mark}"))
        return df.join(alike, [*on, "_g"], "left").join(every, list(on), "left").fillna(0, [f"{c}{mark}" for c in _COUNTS])

    leveled = put_on(_at_levels(spots, levels, split, levels, ("_ab", "_ac")), whole, cell, "")
    out = put_on(leveled.groupBy(*place, "_g").agg(*_sums()), single, place, "1")
    return out.select(*place, "_g", (F.col("_s") + F.col("_s1")).alias("_same"),
                      (F.col("_t") + F.col("_t1") - F.col("_o") - F.col("_o1")).alias("_other"))


def neighbour_counts(points: DataFrame, km: float, group: str, cells_per_radius: int = 8, key: str = "store_id",
                     levels: int = 4, crowd: int = CROWD) -> DataFrame:
    """Points with the number of others within ``km``, of the same and of another group.

    Distinct ``key`` values count, never the own one: neither a repeated row nor a key that stands at
    several places or in several groups counts twice, or itself.  A point without group or place
    is returned with zeros and counted by nobody.

    Counts are those of a place and group, so the points of one place are looked at once. Cells as high as the radius
    are compared as they are where they hold few points, crowded ones are cut, ``cells_per_radius`` times each way and
    again: most of their neighbour cells lie wholly inside the circle and add one number, see :func:`_rings`. Keys of one
    place and group add up. Those of several are walked by key: a cell, or a place at its rim, takes each key and group once.
    """
    split, height = max(2, cells_per_radius), max(km, 1e-3) / KM_PER_DEGREE
    walk = (km, height, split, levels, crowd)
    # Read several times below, so the points are computed once and kept in shared storage.
    points = persist_table(points, "points")
    known = points.select(key, *_PLACE, group).dropna().distinct()
    known = known.join(_groups_of(known, key, group), key, "left").fillna(False, ["_several", "_mixed"])
    known = known.withColumnsRenamed({key: "_key", group: "_g"})
    placed = persist_table(Grid(height, split ** (levels - 1)).place(known, "latitude", "longitude"), "points")
    at = [*_PLACE, "_band", "_cell"]
    spots = placed.select(*at, "_g").distinct()

    alone = placed.filter("NOT _several").groupBy(*at, "_g").agg(F.count(F.lit(1)).alias("_n"))
    several = placed.filter("_several").select(*at, "_key", "_g", F.lit(1).alias("_n"))
    counts = [_counted(spots, alone, ["_g"], [], *walk)]
    if not several.isEmpty():
        counts.append(_counted(spots, several, ["_key", "_g"], [], *walk))
    counted = placed.select("_key", *_PLACE, "_g").join(_summed(spots, counts, [], levels, split), [*_PLACE, "_g"])

    # A key counts itself: once in its group, and once more where it stands near in another group.
    mixed = placed.filter("_mixed").select(*at, "_key", "_g", F.lit(1).alias("_n"))
    itself = F.lit(0)
    if not mixed.isEmpty():
        twice = _summed(mixed.drop("_n"), [_counted(mixed, mixed, ["_key", "_g"], ["_key"], *walk)], ["_key"], levels, split)
        counted = counted.join(twice.select("_key", *_PLACE, "_g", F.col("_other").alias("_itself")), ["_key", *_PLACE, "_g"], "left")
        itself = F.coalesce("_itself", F.lit(0))
    counted = counted.select(F.col("_key").alias(key), *_PLACE, F.col("_g").alias(group), (F.col("_same") - 1).alias("same_group_count"),
                             (F.col("_other") - itself).alias("other_group_count"))
    counts = ["same_group_count", "other_group_count"]
    return points.join(counted, [key, *_PLACE, group], "left").fillna(0, counts)


def _key_bits(key: str) -> Column:
    """A 64-bit map of the keys of a group of rows: it has at most as many bits as there are keys."""
    return F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({key}), 64) AS INT))")).alias("_keys")


def _shortlists(spots: DataFrame, weights: DataFrame, count: int, own: Sequence[str], height: float, split: int, levels: int,
                crowd: int, eligible: Column, keys: int = 0) -> tuple[DataFrame, int]:
    """Pairs of cells, ``_level, _ab, _ac, _bb, _bc`` and ``own``, that hold for each point its ``count`` nearest,
    and the number of levels walked.

    A quadtree walked from continents down: on each grid a cell keeps the cells that can still hold one of
    the nearest points, that is those no farther than the cells are, at most, in which ``count`` eligible points
    stand surely. A cell whose points and candidates make at most ``crowd`` pairs is done; others are cut
    ``split`` x ``split``. The points are counted once, on the finest grid; coarser cells add these
    counts up. ``weights`` may carry columns beside the count ``_n`` that ``eligible`` looks at. With their
    :func:`_key_bits`, points of ``keys`` different keys suffice, too, however many points a key has.
    """
    marks = [c for c in weights.columns if c not in ("_band", "_cell", "_n", "_keys")]
    totals = [F.sum("_n").alias("_n"), *([F.bit_or("_keys").alias("_keys")] if keys else [])]
    grids = [Grid(height, split ** level) for level in range(levels)]
    mine = persist_table(spots.groupBy("_band", "_cell", *own).agg(F.count(F.lit(1)).alias("_m")), "cells")
    theirs = persist_table(weights, "cells")
    a, b = ["_ab", "_ac"], ["_bb", "_bc"]

    def coarser(cells: DataFrame, level: int, names: Sequence[str], keep: Sequence[str], numbers: Sequence[Column]) -> DataFrame:
        width = split ** (levels - 1 - level)
        up = [F.floor(F.col(c) / width).cast("long").alias(n) for c, n in zip(("_band", "_cell"), names)]
        return cells.groupBy(*up, *keep).agg(*numbers)

    def units(level: int) -> DataFrame:
        return coarser(mine, level, a, own, [F.sum("_m").alias("_m")])

    def aims(level: int) -> DataFrame:
        return coarser(theirs, level, b, marks, totals)

    # The coarsest grid has a fixed number of cells, whatever the data.
    wide = (units(0).withColumn("_bb", F.explode(F.sequence(F.lit(0), F.lit(math.ceil(180 / height) - 1)).cast("array<long>")))
            .withColumn("_bc", F.explode(F.sequence(F.lit(0), F.lit(max(1, math.floor(360 / height)) - 1)).cast("array<long>"))))
    found, done = wide.join(aims(0), b), []
    for level, grid in enumerate(grids):
        found = found.filter(eligible).groupBy(*a, *own, *b).agg(F.first("_m").alias("_m"), *totals)
        boxed = _with_bounds(grid.with_box(grid.with_box(found, *a, "a_"), *b, "b_"), grid.height)
        unit = Window.partitionBy(*a, *own)
        so_far = unit.orderBy("_far", *b)
        sure = F.sum("_n").over(so_far) >= count
        if keys:
            sure = sure | (F.bit_count(F.bit_or("_keys").over(so_far)) >= keys)
        boxed = boxed.withColumn("_sure", sure).withColumn("_bound", F.min(F.when(F.col("_sure"), F.col("_far"))).over(unit))
        kept = boxed.filter(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound") + _SLACK_KM))
        kept = kept.withColumn("_pairs", F.col("_m") * F.sum("_n").over(unit))
        kept = persist_table(kept.select(*a, *own, *b, "_pairs"), "shortlist")
        last = level == levels - 1
        done.append(kept.filter(F.lit(True) if last else F.col("_pairs") <= crowd).select(F.lit(level).alias("_level"), *a, *own, *b))
        open_ = kept.filter(F.col("_pairs") > crowd).drop("_pairs")
        if last or open_.isEmpty():
            break
        parts = [F.floor(F.col(c) / split).cast("long").alias(f"_p{c}") for c in (*a, *b)]
        finer = units(level + 1).select("*", *parts[:2])
        nearer = aims(level + 1).select("*", *parts[2:])
        found = (open_.withColumnsRenamed({c: f"_p{c}" for c in (*a, *b)})
                 .join(finer, ["_p_ab", "_p_ac", *own]).join(nearer, ["_p_bb", "_p_bc"]))
    return reduce(DataFrame.unionByName, done), len(done)


def _at_levels(spots: DataFrame, levels: int, split: int, walked: int, names: tuple[str, str]) -> DataFrame:
    """Spots once for each level that was walked, with their cell on its grid."""
    at = F.explode(F.array(*[F.lit(level) for level in range(walked)])).alias("_level")
    cut = F.pow(F.lit(float(split)), F.lit(levels - 1) - F.col("_level"))
    return spots.select("*", at).withColumns({n: F.floor(F.col(c) / cut).cast("long") for n, c in zip(names, ("_band", "_cell"))}).drop(
        "_band", "_cell")


def nearest_other(points: DataFrame, group: str, distance: str = "nearest_km", height: float = 22.5,
                  split: int = 8, levels: int = 5, key: str | None = None, crowd: int = CROWD) -> DataFrame:
    """Points with the distance to the nearest point of another group, and of another ``key`` if one is named.

    Points without a group, or where no other group exists, drop out; a point without a place, or
    with no placed point of another group (and key), keeps a NULL distance.

    Only cells that hold many points are cut down to fine grids, see :func:`_shortlists`. Points are
    compared place by place: of another place only two keys matter, as one of them is not the own.
    So each place finds its nearest key and the nearest one beside it, which is for points of the first.
    """
    # Read several times below, so the points are computed once and kept in shared storage.
    points = persist_table(points, "points")
    known = points.dropna(subset=["latitude", "longitude", group])
    grid = Grid(height, split ** (levels - 1))
    by = ["latitude", "longitude", group]
    place = ["latitude", "longitude", "_g"]
    other = F.col("_bg") != F.col("_g")
    measured = F.min(haversine_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")))
    columns = ["latitude", "longitude", F.col(group).alias("_g"), *([F.col(key).alias("_key")] if key else [])]
    placed = persist_table(grid.place(known.select(*columns).distinct(), "latitude", "longitude"), "points")
    spots = placed.select("latitude", "longitude", "_band", "_cell", "_g").distinct()
    if key:
        # Points without a key differ from every key.
        two = F.expr("array_distinct(filter(array(min(_key), max(_key)), x -> x IS NOT NULL))")
        two = F.when(F.count("_key") < F.count(F.lit(1)), F.concat(two, F.array(F.lit(None)))).otherwise(two)
        theirs = persist_table(placed.groupBy(*spots.columns).agg(two.alias("_two"), _key_bits("_key")), "points")
        weights = theirs.groupBy("_band", "_cell", F.col("_g").alias("_bg")).agg(F.count(F.lit(1)).alias("_n"), F.bit_or("_keys").alias("_keys"))
        most = placed.filter("_key IS NOT NULL").groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        shortlist, walked = _shortlists(spots, weights, most + 1, ["_g"], height, split, levels, crowd, other, 2)
        pairs = _compare(shortlist, walked, spots, theirs.drop("_keys"), ["_g"], levels, split).filter(other)
        of_key = pairs.withColumn("_their_key", F.explode("_two")).groupBy(*place, "_their_key").agg(measured.alias("_km"))
        ranked = of_key.withColumn("_rank", F.row_number().over(Window.partitionBy(*place).orderBy("_km", "_their_key")))
        first = F.col("_rank") == 1
        found = ranked.filter("_rank <= 2").groupBy(*place).agg(
            F.max(F.when(first, F.col("_their_key"))).alias("_nearest"), F.max(F.when(first, F.col("_km"))).alias("_km"),
            F.max(F.when(~first, F.col("_km"))).alias("_beside"))
    else:
        weights = spots.groupBy("_band", "_cell", F.col("_g").alias("_bg")).agg(F.count(F.lit(1)).alias("_n"))
        shortlist, walked = _shortlists(spots, weights, 1, ["_g"], height, split, levels, crowd, other)
        found = _compare(shortlist, walked, spots, spots, ["_g"], levels, split).filter(other).groupBy(*place).agg(measured.alias(distance))
    groups = points.agg(F.min(group).alias("_low"), F.max(group).alias("_high"))  # one row
    rivalled = points.crossJoin(groups).filter((F.col(group) != F.col("_low")) | (F.col(group) != F.col("_high")))
    out = rivalled.drop("_low", "_high").join(found.withColumnRenamed("_g", group), by, "left")
    if key:
        out = out.withColumn(distance, F.when(F.col(key) == F.col("_nearest"), F.col("_beside")).otherwise(F.col("_km")))
    return out.drop("_nearest", "_km", "_beside")


def _compare(shortlist: DataFrame, walked: int, left: DataFrame, right: DataFrame, own: Sequence[str], levels: int, split: int) -> DataFrame:
    """Left spots beside the right spots (``_lat``, ``_lon``, ``_bg``, ...) of the cells on their shortlist."""
    near = right.withColumnsRenamed({"latitude": "_lat", "longitude": "_lon", "_g": "_bg"})
    mine = _at_levels(left, levels, split, walked, ("_ab", "_ac"))
    theirs = _at_levels(near, levels, split, walked, ("_bb", "_bc"))
    return shortlist.join(mine, ["_level", "_ab", "_ac", *own]).join(theirs, ["_level", "_bb", "_bc"])


def nearest_k(points: DataFrame, k: int, km: float, key: str = "store_id", group: str | None = None, height: float = 22.5,
              split: int = 8, levels: int = 5, crowd: int = CROWD) -> DataFrame:
    """The ``k`` nearest other keys within ``km`` of each key: key, near key, ``distance_km``, ``place`` from 1.

    The distance between two keys is that of their nearest places; ties go to the smaller key. With a
    ``group``, neighbours are of the own group only, and keys without one have none. Rows without
    key or place are left out. No pairs of all neighbours are formed: :func:`_shortlists` bounds what is compared.

    Points are compared place by place. The keys of one place are equally far, so the ``k + 1`` smallest of
    them hold all that another key can need; and a place's ``k + 1`` nearest keys hold the ``k`` nearest
    others of each of its own keys.
    """
    wanted = [key, "latitude", "longitude"] + ([group] if group else [])
    known = points.select(*wanted).dropna().distinct().withColumnsRenamed({key: "_key"} | ({group: "_g"} if group else {}))
    if not group:
        known = known.withColumn("_g", F.lit(0))
    grid = Grid(height, split ** (levels - 1))
    place = ["latitude", "longitude", "_g"]
    placed = persist_table(grid.place(known, "latitude", "longitude"), "points")
    spots = placed.select(*place, "_band", "_cell").distinct()
    smallest = F.row_number().over(Window.partitionBy(*place).orderBy("_key"))
    theirs = persist_table(placed.withColumn("_nth", smallest).filter(F.col("_nth") <= k + 1).drop("_nth"), "points")
    most = theirs.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 1
    weights = theirs.groupBy("_band", "_cell", F.col("_g").alias("_bg")).agg(F.count(F.lit(1)).alias("_n"), _key_bits("_key"))
    alike = F.col("_bg") == F.col("_g")
    # k other keys stand surely where (k + 1) * most rows do, as a key has at most that many.
    shortlist, walked = _shortlists(spots, weights, (k + 1) * most, ["_g"], height, split, levels, crowd, alike, k + 1)
    measured = haversine_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
    near = (_compare(shortlist, walked, spots, theirs.withColumnRenamed("_key", "_near"), ["_g"], levels, split).filter(alike)
            .withColumn("distance_km", measured).filter(F.col("distance_km") <= km)
            .groupBy(*place, "_near").agg(F.min("distance_km").alias("distance_km")))
    nearest = F.row_number().over(Window.partitionBy(*place).orderBy("distance_km", "_near"))
    near = near.withColumn("_nth", nearest).filter(F.col("_nth") <= k + 1)
    pairs = (placed.select(*place, "_key").join(near, place).filter(F.col("_key") != F.col("_near"))
             .groupBy("_key", "_near").agg(F.min("distance_km").alias("distance_km")))
    order = Window.partitionBy("_key").orderBy("distance_km", "_near")
    best = pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return best.select(F.col("_key").alias(key), F.col("_near").alias(f"near_{key}"), "distance_km", "place")


def top_bottom_n(df: DataFrame, part: str, metric: str, n: int, tie: str,
                 labels: tuple[str, str] = ("Top Performer", "Bottom Performer")) -> DataFrame:
    """The n smallest and n largest values of ``metric`` per group, labelled; small wins in overlap.

    Each ranking is its own ``ROW_NUMBER() <= n``, which Spark cuts to n rows per group before
    the shuffle; one query with both ranks would move and sort every row.
    """
    def ranked(order: Column, rank: int) -> DataFrame:
        window = Window.partitionBy(part).orderBy(order, F.col(tie))
        return (df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n)
                .drop("_rn").withColumn("_rank", F.lit(rank)))

    best = ranked(F.col(metric).asc_nulls_last(), 0)
    worst = ranked(F.col(metric).desc_nulls_last(), 1)
    both = best.unionByName(worst).groupBy(*df.columns).agg(F.min("_rank").alias("_rank"))
    tier = F.when(F.col("_rank") == 0, labels[0]).otherwise(labels[1])
    return both.withColumn("performance_tier", tier).drop("_rank")
