"""Entity health: latest metrics, recent events, rule score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.rules import Rule, any_of, band_label, compare, first_case
from beaconry.functions.time import AsOf
from beaconry.operators.events import recent_event_counts
from beaconry.profiles.base import Penalty, Profile, Scoring
from beaconry.profiles.retail import OTHER_SCORE


def latest_per(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str],
               within: Sequence[str] = ()) -> DataFrame:
    """Newest row per key, without ranking the rows of a key in one task.

    The first step keeps the newest ``values`` per key and ``within`` columns.  Its buffers are
    fixed-width numbers and times, so it is a hash aggregation that combines before the
    shuffle.  The second picks among the few rows left; their columns break ties.
    ``within`` should make rows of one ``order`` value unique.
    """
    inner = list(dict.fromkeys([*keys, *within]))
    newest = df.groupBy(*inner).agg(F.max(order).alias(order),
                                    *[F.max_by(c, order).alias(c) for c in values])
    rest = [c for c in inner if c not in keys]
    picked = newest.groupBy(*keys).agg(F.max(F.struct(order, *rest, *values)).alias("row"))
    return picked.select(*keys, *[F.col("row")[c].alias(c) for c in (order, *rest, *values)])


def score_from_rules(groups: Sequence[Sequence[Penalty]], column=F.col) -> Column:
    """100 minus the first matching penalty of every group, kept within 0 and 100."""
    score = F.lit(100)
    for group in groups:
        score = score - first_case(
            [(compare(column(p.name), p.op, p.bound), p.points) for p in group], 0)
    return F.least(F.lit(100), F.greatest(F.lit(0), score))


def _attention(rules: Sequence[Rule]) -> Column:
    return F.coalesce(any_of([compare(F.col(r.name), r.op, r.bound) for r in rules]), F.lit(False))


def _by_category(profile: Profile, build, otherwise) -> Column:
    if profile.category is None:
        return build(profile.scoring[None])
    category = F.col(profile.category)
    return first_case([(category == name, build(s)) for name, s in profile.scoring.items()], otherwise)


def health(perf: DataFrame, events: DataFrame, profile: Profile, as_of: AsOf,
           missing: str = "zero") -> DataFrame:
    """Current state of every entity.

    ``missing='zero'`` scores an absent metric as 0, which for "lower is worse" rules costs
    points; ``missing='skip'`` applies no rule to an absent metric.
    """
    place = ["latitude", "longitude"] if "latitude" in perf.columns else []
    keys = [profile.entity, *profile.health_attributes]
    within = list(dict.fromkeys([*profile.health_attributes, *(c for c in profile.rollup_keys if c in perf.columns)]))
    latest = latest_per(perf, [profile.entity, "metric_name"], "window_end", ["avg_value", *place], within)
    wide = latest.groupBy(*keys).agg(
        *[F.min_by(c, F.struct("metric_name", c)).alias(c) for c in place],
        *[F.max(F.when(F.col("metric_name") == metric, F.col("avg_value"))).alias(name)
          for name, metric in profile.health_metrics.items()],
    )
    recent = recent_event_counts(events, profile, as_of)
    join_keys = [profile.entity] + ([profile.category] if profile.category else [])
    joined = wide.join(recent, join_keys, "left")

    measured = list(profile.health_metrics)
    raw = {c: f"_raw_{c}" for c in measured}
    state = joined.withColumnsRenamed(raw).withColumns(
        {c: F.coalesce(F.col(raw[c]), F.lit(0.0)) for c in measured})
    counters = [c for c in recent.columns if c not in join_keys]
    state = state.fillna(0, counters)

    def scored(name: str) -> Column:
        return F.col(raw[name]) if missing == "skip" and name in raw else F.col(name)

    def score(s: Scoring) -> Column:
        return score_from_rules(s.penalties, scored)

    def status_score(s: Scoring) -> Column:
        return score_from_rules(s.status_penalties or s.penalties, scored)

    state = state.withColumns({
        "health_score": _by_category(profile, score, OTHER_SCORE),
        "_status_score": _by_category(profile, status_score, OTHER_SCORE),
    })
    state = state.withColumns({
        "health_status": band_label(F.col("_status_score"), profile.status_bands, profile.status_otherwise),
        "requires_attention": _by_category(profile, lambda s: _attention(s.attention), False),
        "health_status_from_score": band_label(
            F.col("health_score"), profile.status_bands, profile.status_otherwise),
    })
    return state.select(*keys, *place, *measured, *counters, "health_score", "health_status",
                        "requires_attention", "health_status_from_score")
