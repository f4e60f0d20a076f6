"""What an industry profile has to state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from beaconry.functions.rules import Rule


class Expectation(NamedTuple):
    """A row rule in SQL; ``drop`` removes violating rows, otherwise they are counted."""

    name: str
    condition: str
    drop: bool = False


class Penalty(NamedTuple):
    """Points taken when the column rule holds; within a group the first match counts."""

    name: str
    op: str
    bound: float
    points: int


@dataclass(frozen=True)
class Scoring:
    """Health rules of one category of entities."""

    penalties: Sequence[Sequence[Penalty]]
    attention: Sequence[Rule]
    # Some profiles derive the status from a shorter list than the score.
    status_penalties: Sequence[Sequence[Penalty]] | None = None


@dataclass(frozen=True)
class Profile:
    name: str
    entity: str
    entities: str                         # word used in count columns: device, store
    place: str                            # location or region
    place_prefix: str                     # prefix of rolled-up measures
    event_categories: Mapping[str, Sequence[str]]
    log_expectations: Sequence[Expectation]
    metric_expectations: Sequence[Expectation]
    anomalies: Sequence[Rule]
    severity_levels: Mapping[str, Sequence[Rule]]   # ordered, worst first
    units_like: Sequence[tuple[str, str]]
    units_exact: Mapping[str, Sequence[str]]
    metric_columns: Mapping[str, str]     # carried through validation: column -> type
    rollup_keys: Sequence[str]
    health_metrics: Mapping[str, str]     # output column -> metric name
    health_attributes: Sequence[str]
    recent_counts: Mapping[str, str]      # output column -> event category
    scoring: Mapping[str | None, Scoring]  # category -> rules; None key = uncategorised
    status_bands: Sequence[tuple[str, float, str]]
    status_otherwise: str
    category: str | None = None           # column that selects the scoring
    log_attributes: Mapping[str, str] = field(default_factory=dict)
    # metrics that some profiles read with their first-by-time value per window
    rollup_first: Sequence[str] = ()
    rollup_averages: Mapping[str, str] = field(default_factory=dict)
    rollup_flags: Sequence[str] = ()
