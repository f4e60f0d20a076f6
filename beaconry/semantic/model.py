"""Semantic layer: named dimensions and measures over one source.

A query is one ``groupBy().agg()`` over the source rows, so ratios and distinct counts are
right at whatever grain is asked for.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _names_in(*fragments: str | None) -> set[str]:
    return {name for text in fragments if text for name in re.findall(r"`([^`]+)`", text)}


@dataclass(frozen=True)
class MetricView:
    name: str
    source: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    comment: str = ""
    comments: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, name: str, spec: Mapping) -> MetricView:
        """Build from the usual ``version/source/dimensions/measures`` mapping."""
        def section(key: str) -> dict[str, str]:
            return {item["name"]: item["expr"] for item in spec.get(key, [])}

        notes = {item["name"]: item["comment"] for key in ("dimensions", "measures")
                 for item in spec.get(key, []) if "comment" in item}
        return cls(name, spec["source"], section("dimensions"), section("measures"),
                   spec.get("comment", ""), notes)

    @classmethod
    def from_yaml(cls, name: str, text: str) -> MetricView:
        try:
            import yaml
        except ImportError as error:  # pragma: no cover - optional dependency
            raise RuntimeError("reading YAML needs the yaml package; use from_dict") from error
        return cls.from_dict(name, yaml.safe_load(text))

    def describe(self) -> dict:
        def section(items: Mapping[str, str]) -> list[dict]:
            return [{"name": n, "expr": e, "comment": self.comments.get(n, "")} for n, e in items.items()]

        return {"name": self.name, "source": self.source, "comment": self.comment,
                "dimensions": section(self.dimensions), "measures": section(self.measures)}

    def with_dimensions(self, source: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """Source rows with named dimensions beside the source columns."""
        names = list(self.dimensions) if names is None else names
        columns = {c.lower() for c in source.columns}
        for name in names:
            if name.lower() in columns and self.dimensions[name].lower() != name.lower():
                raise ValueError(f"dimension {name!r} would hide a source column")
        return source.withColumns({name: F.expr(self.dimensions[name]) for name in names})

    def query(self, source: DataFrame | None = None, dimensions: Sequence[str] = (),
              measures: Sequence[str] | Mapping[str, str] = (), where: str | None = None,
              having: str | None = None, derive: Mapping[str, str] | None = None,
              order_by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
        """Aggregate ``measures`` by ``dimensions``.

        ``measures`` is a list of names or a mapping output name -> measure.  ``where`` is SQL
        over dimensions; ``having``, ``derive`` and ``order_by`` are SQL over dimensions,
        measures and their output names (``"`Average Value` DESC"``).  A backquoted measure
        is computed for a condition even when it is not selected.
        """
        if source is None:
            from pyspark.sql import SparkSession
            source = SparkSession.active().table(self.source)
        wanted = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
        derive = dict(derive or {})
        mentioned = _names_in(having, *derive.values(), *order_by)
        hidden = {m: m for m in mentioned if m in self.measures and m not in wanted}
        needed = [d for d in self.dimensions if d in dimensions or d in _names_in(where)]

        rows = self.with_dimensions(source, needed)
        if where:
            rows = rows.filter(where)
        result = rows.groupBy(*[F.col(f"`{d}`") for d in dimensions]).agg(
            *[F.expr(self.measures[m]).alias(alias) for alias, m in {**wanted, **hidden}.items()])
        result = result.withColumns({alias: F.expr(sql) for alias, sql in derive.items()})
        if having:
            result = result.filter(having)
        if order_by:
            result = result.orderBy(*[_order(term) for term in order_by])
        if limit is not None:
            result = result.limit(limit)
        return result.select(*[F.col(f"`{c}`") for c in (*dimensions, *wanted, *derive)])


def _order(term: str):
    match = re.fullmatch(r"(?is)(.*?)\s+(asc|desc)", term.strip())
    expression, direction = match.groups() if match else (term, "asc")
    column = F.expr(expression)
    return column.desc() if direction.lower() == "desc" else column.asc()


class Registry:
    """Named views, for listing and lookup."""

    def __init__(self, *views: MetricView):
        self._views = {view.name: view for view in views}

    def add(self, view: MetricView) -> None:
        self._views[view.name] = view

    def __getitem__(self, name: str) -> MetricView:
        return self._views[name]

    def list(self) -> list[str]:
        return sorted(self._views)

    def describe(self, name: str) -> dict:
        return self._views[name].describe()
