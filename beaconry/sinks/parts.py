"""Tables in parts that change one by one and are published together.

A table is a set of parts, usually one per hour. A change writes parts under a version of its own,
``table/version=V/part=P``, where no reader looks. Rows of many parts are not spread over a file each:
they share the files of a wide version, ``table/version=W``, sorted by their column ``part``, so files
grow with the rows and not with the hours. The change then publishes a manifest: which versions
make up each part of each table. The manifest gets its name by a rename, after it is complete, so
a run that died half-way leaves nothing that a reader could see, and all tables move on at once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from beaconry.sinks.files import move, names_in, read_text, remove, write_text
from beaconry.sources.schema import evolve_schema

WHOLE = "all"      # the part of a table that is always written whole
TIMELESS = "none"  # rows without a time
FEW = 24           # parts that get a folder each
WIDE = "w"         # begins the name of a version whose parts share files


def hour_part(time: str | Column, form: str = "yyyy-MM-dd-HH") -> Column:
    """Name of the part a time belongs to; names sort by time."""
    column = F.col(time) if isinstance(time, str) else time
    return F.coalesce(F.date_format(column, form), F.lit(TIMELESS))


def day_part(time: str | Column) -> Column:
    return hour_part(time, "yyyy-MM-dd")


class PartStore:
    """The published state of the tables below ``root``.

    The manifest names each part of each table once: it grows with the hours that the tables span,
    not with their rows, and is the only thing the driver reads.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _published(self) -> list[int]:
        return sorted(int(n) for n in names_in(self.spark, f"{self.root}/manifest") if n.isdigit())

    def current(self) -> Change:
        """The newest published state, as a change to which nothing has been added yet."""
        published = self._published()
        change = Change(self, published[-1] + 1 if published else 1)
        if published:
            change.parts, change.schemas, change.marks = self._manifest(published[-1])
        return change

    def _manifest(self, number: int) -> tuple[dict, dict, dict]:
        known = json.loads(read_text(self.spark, f"{self.root}/manifest/{number}"))
        return known["parts"], known["schemas"], known["marks"]

    def read(self, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        return self.current().read(table, parts)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what none of the last ``keep`` manifests names: older manifests, replaced parts, remains of dead runs.

        Returns the removed folders. Not to be run while a change is being written: its files are not
        in a manifest yet.
        """
        published, spark = self._published(), self.spark
        used: dict[str, dict[str, set[str]]] = {}
        for number in published[-keep:]:
            for table, parts in self._manifest(number)[0].items():
                for part, versions in parts.items():
                    for version in versions:
                        used.setdefault(table, {}).setdefault(f"version={version}", set()).add(f"part={part}")
        gone = [f"manifest/{number}" for number in published[:-keep]]
        for table in names_in(spark, self.root):
            for version in names_in(spark, f"{self.root}/{table}") if table != "manifest" else ():
                parts = used.get(table, {}).get(version)
                if parts is None:
                    gone.append(f"{table}/{version}")
                else:
                    gone += [f"{table}/{version}/{p}" for p in names_in(spark, f"{self.root}/{table}/{version}")
                             if p.startswith("part=") and p not in parts]
        for folder in gone:
            remove(spark, f"{self.root}/{folder}")
        return gone


class Change:
    """A state of the tables that is being written; readers see it when it is published."""

    def __init__(self, store: PartStore, number: int):
        self.store, self.number = store, number
        self.parts: dict[str, dict[str, list[str]]] = {}
        self.schemas: dict[str, str] = {}
        self.marks: dict[str, str] = {}
        self.written: dict[str, list[str]] = {}

    def names(self, table: str) -> list[str]:
        return sorted(self.parts.get(table, {}))

    def read(self, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        """Rows of some parts, or of all, with the column ``part``; no rows of parts that do not exist."""
        if table not in self.schemas:
            raise KeyError(f"no table {table}")
        wanted = self.parts.get(table, {})
        chosen = wanted if parts is None else [p for p in parts if p in wanted]
        return self._read(table, [(v, p) for p in chosen for v in wanted[p]])

    def _read(self, table: str, versions: Sequence[tuple[str, str]], whole: bool = False) -> DataFrame:
        """Rows of pairs of version and part. ``whole`` if these are all parts of their versions."""
        own = StructType.fromJson(json.loads(self.schemas[table]))
        schema = StructType([*own, StructField("version", StringType()), StructField("part", StringType())])
        spark, home = self.store.spark, f"{self.store.root}/{table}"
        narrow = [f"{home}/version={v}/part={p}" for v, p in versions if not v.startswith(WIDE)]
        wide = [(v, p) for v, p in versions if v.startswith(WIDE)]
        if not versions:
            return spark.createDataFrame([], schema).drop("version")
        files = spark.read.schema(schema).option("basePath", home)
        rows = files.parquet(*narrow).drop("version") if narrow else None
        if wide:
            shared = files.parquet(*[f"{home}/version={v}" for v in dict.fromkeys(v for v, _ in wide)])
            if not whole:  # parts that were replaced later still stand in the files
                pairs = spark.createDataFrame(wide, "_version string, _part string")
                shared = shared.filter(F.col("part").between(min(p for _, p in wide), max(p for _, p in wide))).join(
                    F.broadcast(pairs), F.expr("version = _version AND part = _part"), "left_semi")
            shared = shared.select(*own.names, "part")
            rows = shared if rows is None else rows.unionByName(shared)
        return rows

    def _write(self, table: str, df: DataFrame, sort_by: Sequence[str], level: int = 0, spread: int = 0) -> tuple[str, list[str]]:
        """Write the rows by their column ``part``; the version and the parts that have rows.

        ``spread`` is how many parts the rows may be of.
        """
        wide, spark = spread > FEW, self.store.spark
        version = f"{WIDE if wide else 'v'}{self.number}-{uuid.uuid4().hex}-{level}"
        path = f"{self.store.root}/{table}/version={version}"
        df = df.hint("rebalance", "part").sortWithinPartitions("part", *[c for c in sort_by if c in df.columns])
        (df.write if wide else df.write.partitionBy("part")).parquet(path)
        own = StructType([f for f in df.schema.fields if f.name != "part"])
        known = StructType.fromJson(json.loads(self.schemas[table])) if table in self.schemas else StructType([])
        self.schemas[table] = evolve_schema(known, own).json()
        if wide:
            return version, sorted(r["part"] for r in spark.read.schema("part string").parquet(path).distinct().collect())
        return version, [n.removeprefix("part=") for n in names_in(spark, path) if n.startswith("part=")]

    def stage(self, table: str, df: DataFrame, spread: int = 0) -> DataFrame:
        """Rows written aside for this change only, read back."""
        version, parts = self._write(table, df, (), spread=spread)
        return self._read(table, [(version, p) for p in parts], whole=True)

    def put(self, table: str, df: DataFrame, replaced: Iterable[str], sort_by: Sequence[str] = (), spread: int = 0) -> DataFrame:
        """Write rows by their column ``part``, in place of what the parts ``replaced`` held, beside what others hold.

        Returns the written rows. ``spread`` is how many parts they may be of; many share files.
        """
        version, found = self._write(table, df, sort_by, spread=spread)
        held = self.parts.setdefault(table, {})
        for part in replaced:
            held.pop(part, None)
        for part in found:
            held.setdefault(part, []).append(version)
        self._note(table, found)
        return self._read(table, [(version, p) for p in found], whole=True)

    def append(self, table: str, df: DataFrame, sort_by: Sequence[str] = (), spread: int = 0) -> DataFrame:
        """Add rows to the parts they belong to; returns these rows. A part gets one more version."""
        return self.put(table, df, (), sort_by, spread)

    def replace(self, table: str, df: DataFrame, parts: Iterable[str] | None = None, sort_by: Sequence[str] = ()) -> DataFrame:
        """Put rows in place of what the given parts held, or of the whole table, which then is one part."""
        if parts is None:
            parts, df = [WHOLE], df.withColumn("part", F.lit(WHOLE))
        parts = list(parts)
        return self.put(table, df, parts, sort_by, len(parts))

    def _note(self, table: str, parts: Sequence[str]) -> None:
        self.written[table] = sorted({*self.written.get(table, ()), *parts})

    def merge_versions(self, table: str, fan: int, combine: Callable[[DataFrame], DataFrame] | None = None,
                       sort_by: Sequence[str] = (), closed: Iterable[str] = ()) -> None:
        """Where a part has ``fan`` versions of one level, rewrite them as one of the next level.

        A row is so rewritten once per level, and a part has at most ``fan`` versions a level, however
        many were written. Of ``closed`` parts all versions become one. ``combine`` may reduce the rows
        that are merged; it must keep their column ``part``.
        """
        held, closed = self.parts.get(table, {}), set(closed)
        level = 0
        while True:
            chosen = {}
            for part, versions in held.items():
                own = versions if part in closed else [v for v in versions if int(v.rsplit("-", 1)[1]) == level]
                if len(own) >= (2 if part in closed else fan):
                    chosen[part] = own
            if not chosen and level >= max((int(v.rsplit("-", 1)[1]) for vs in held.values() for v in vs), default=0):
                return
            if chosen:
                rows = self._read(table, [(v, p) for p, versions in chosen.items() for v in versions])
                version, found = self._write(table, combine(rows) if combine else rows, sort_by, level + 1, len(chosen))
                for part, own in chosen.items():
                    held[part] = [v for v in held[part] if v not in own] + [version] * (part in found)
                self._note(table, found)
            level += 1

    def publish(self) -> None:
        """Make this change the current state. Fails if another one was published meanwhile."""
        home, spark = f"{self.store.root}/manifest", self.store.spark
        attempt = f"{home}/.attempt-{uuid.uuid4().hex}"
        write_text(spark, attempt, json.dumps({"parts": self.parts, "schemas": self.schemas, "marks": self.marks}))
        move(spark, attempt, f"{home}/{self.number}")
