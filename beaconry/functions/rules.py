"""Column expressions generated from rule tables."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq}


class Rule(NamedTuple):
    """``name`` is a column, or a metric name when used with :func:`metric_rule`."""

    name: str
    op: str
    bound: float


def compare(value: Column, op: str, bound: float) -> Column:
    return _OPS[op](value, F.lit(bound))


def first_case(cases: Iterable[tuple[Column, Any]], otherwise: Any) -> Column:
    """Searched CASE: value of the first condition that is true."""
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return F.lit(otherwise) if chain is None else chain.otherwise(otherwise)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(operator.or_, conditions, F.lit(False))


def any_rule(rules: Sequence[Rule]) -> Column:
    """True when one of the column rules holds."""
    return any_of([compare(F.col(r.name), r.op, r.bound) for r in rules])


def metric_rule(rule: Rule, metric: Column, value: Column) -> Column:
    return (metric == rule.name) & compare(value, rule.op, rule.bound)


def any_metric_rule(rules: Sequence[Rule], metric: Column, value: Column) -> Column:
    """Never NULL: an unknown metric or value breaks no rule."""
    return F.coalesce(any_of([metric_rule(r, metric, value) for r in rules]), F.lit(False))


def code_label(code: Column, groups: dict[str, Sequence[Any]], otherwise: Any) -> Column:
    """Label of the group that lists the code."""
    return first_case([(code.isin(*codes), label) for label, codes in groups.items()], otherwise)


def like_label(text: Column, patterns: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """Label of the first LIKE pattern that matches."""
    return first_case([(text.like(pattern), label) for pattern, label in patterns], otherwise)


def bucket_label(value: Column, buckets: Sequence[tuple[float, float, str]], otherwise: str) -> Column:
    """Label of the first closed interval holding the value."""
    return first_case([(value.between(lo, hi), label) for lo, hi, label in buckets], otherwise)


def band_label(value: Column, bands: Sequence[tuple[str, float, str]], otherwise: str) -> Column:
    """Label of the first comparison that holds, e.g. ``('>=', 90, 'Excellent')``."""
    return first_case([(compare(value, op, bound), label) for op, bound, label in bands], otherwise)
