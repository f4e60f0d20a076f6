"""The table graph of one industry, from raw records to gold, built lazily and refreshed in order."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.time import AsOf, as_of_column, latest_time
from beaconry.operators.dims import dim_devices, dim_stores
from beaconry.operators.events import dedup_events, enrich_events, with_store_region
from beaconry.operators.health import health
from beaconry.operators.logs import parse_log
from beaconry.operators.metrics import validate_metrics
from beaconry.operators.rollups import drive_through, kpi_hourly, rollup_5min, rollup_by_place
from beaconry.profiles import NETWORK, RETAIL, Profile


class Tables:
    """Plans of all tables of a profile.  Nothing runs until a table is used or refreshed.

    ``records`` and ``lines`` may be functions that read them: a DataFrame over files keeps to the
    files it found when it was made, a function finds those that have arrived since.
    """

    def __init__(self, profile: Profile, records: DataFrame | Callable[[], DataFrame],
                 lines: DataFrame | Callable[[], DataFrame], as_of: AsOf | None = None, time: str = "event_timestamp"):
        self.profile, self._records, self._lines, self.time = profile, records, lines, time
        self._as_of = as_of
        self._refreshed = False

    def anew(self) -> Tables:
        """The same inputs, with nothing read or replaced yet."""
        fixed = [n for n, given in (("records", self._records), ("lines", self._lines)) if not callable(given)]
        if self._refreshed and fixed:
            warnings.warn(f"{' and '.join(fixed)} keep to the files they were made from: give a function that reads them"
                          " to take in files that have arrived since", stacklevel=3)
        self._refreshed = True
        return Tables(self.profile, self._records, self._lines, self._as_of, self.time)

    @cached_property
    def records(self) -> DataFrame:
        return self._records() if callable(self._records) else self._records

    @cached_property
    def lines(self) -> DataFrame:
        return self._lines() if callable(self._lines) else self._lines

    @cached_property
    def as_of(self) -> Column:
        """Given time, else the newest measurement: a scalar subquery, not a driver value.

        Measurements carry their time as a column, so this reads four columns; the newest
        event would mean parsing every log line.
        """
        return as_of_column(self._as_of) if self._as_of is not None else latest_time(self.metrics)

    @cached_property
    def parsed(self) -> DataFrame:
        return parse_log(self.lines, self.profile)

    @cached_property
    def metrics(self) -> DataFrame:
        return validate_metrics(self.records, self.profile, self.time)

    @cached_property
    def silver_events(self) -> DataFrame:
        events = dedup_events(self.parsed, self.profile)
        return events if self.profile is NETWORK else with_store_region(events, self.dimension)

    @cached_property
    def performance(self) -> DataFrame:
        return rollup_5min(self.metrics, self.profile)

    @cached_property
    def events(self) -> DataFrame:
        return enrich_events(self.silver_events, self.as_of)

    @cached_property
    def dimension(self) -> DataFrame:
        build = dim_devices if self.profile is NETWORK else dim_stores
        return build(self.metrics, self.as_of)

    @cached_property
    def by_place(self) -> DataFrame:
        return rollup_by_place(self.performance, self.profile)

    @cached_property
    def health(self) -> DataFrame:
        return health(self.performance, self.events, self.profile, self.as_of)

    @cached_property
    def kpi(self) -> DataFrame:
        return kpi_hourly(self.performance, self.events, self.profile)

    @cached_property
    def lanes(self) -> DataFrame:
        return drive_through(self.performance)


# Table name -> attribute and the tables it is computed from.
NETWORK_GRAPH = {
    "network_metrics": ("metrics", ()),
    "network_silver_events": ("silver_events", ()),
    "network_performance_5min": ("performance", ("network_metrics",)),
    "network_events": ("events", ("network_silver_events",)),
    "dim_devices": ("dimension", ("network_metrics",)),
    "metrics_by_location": ("by_place", ("network_performance_5min",)),
    "device_health": ("health", ("network_performance_5min", "network_events")),
    "network_kpi_hourly": ("kpi", ("network_performance_5min", "network_events")),
}
RETAIL_GRAPH = {
    "store_metrics": ("metrics", ()),
    "store_silver_events": ("silver_events", ("dim_stores",)),
    "store_performance_5min": ("performance", ("store_metrics",)),
    "store_events": ("events", ("store_silver_events",)),
    "dim_stores": ("dimension", ("store_metrics",)),
    "metrics_by_region": ("by_place", ("store_performance_5min",)),
    "store_health": ("health", ("store_performance_5min", "store_events")),
    "retail_kpi_hourly": ("kpi", ("store_performance_5min", "store_events")),
    "drive_through_performance": ("lanes", ("store_performance_5min",)),
}
GRAPHS = {NETWORK.name: NETWORK_GRAPH, RETAIL.name: RETAIL_GRAPH}


def ordered(graph: dict[str, tuple[str, tuple[str, ...]]]) -> list[str]:
    """Table names, inputs first."""
    done: list[str] = []

    def visit(name: str) -> None:
        for parent in graph[name][1]:
            visit(parent)
        if name not in done:
            done.append(name)

    for name in graph:
        visit(name)
    return done


def refresh(tables: Tables, save: Callable[[str, DataFrame], DataFrame], processed_at: AsOf | None = None,
            only: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Materialise the graph once, each table read back by the tables above it.

    ``save(name, df)`` writes and returns the stored table, so a rollup is computed once and
    not again in every plan that uses it, and a lost executor costs one stage.  ``tables`` itself
    keeps reading raw input, so a later refresh takes in what has arrived since.
    """
    tables = tables.anew()
    graph = GRAPHS[tables.profile.name]
    wanted = set(only) if only is not None else set(graph)
    stored = {}
    stamp = F.current_timestamp() if processed_at is None else as_of_column(processed_at)
    for name in ordered(graph):
        if name not in wanted:
            continue
        attribute = graph[name][0]
        stored[name] = save(name, getattr(tables, attribute).withColumn("processed_timestamp", stamp))
        tables.__dict__[attribute] = stored[name].drop("processed_timestamp")
        if attribute == "metrics" and tables._as_of is None:
            # All later tables take the same "now", from the stored measurements.
            tables.__dict__["as_of"] = latest_time(stored[name])
    return stored
