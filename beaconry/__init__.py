"""Telemetry analytics as Spark jobs: logs, metrics, health, KPIs, correlation, geography.

Every public function takes DataFrames and returns a DataFrame built from native
Spark expressions.  Anything that depends on "now" takes an explicit ``as_of``.
"""

__version__ = "0.1.0"
