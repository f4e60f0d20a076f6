"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from registry.lake import Lake, tidy
from registry.oracle import compose

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, tuple[str, str]] = {}


def add(name: str, build: Callable[[Lake], DataFrame], oracle: str | None = None, doubles: str = "") -> None:
    """``doubles`` lists the floating-point columns, with ``~`` for a blank in a name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(build(Lake(spark, sf_dir)))

    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = run
    if oracle is not None:
        ORACLES[name] = (oracle, doubles)


def oracle_texts() -> dict[str, str]:
    return {name: compose(sql, doubles) for name, (sql, doubles) in ORACLES.items()}
