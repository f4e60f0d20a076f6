from beaconry.functions.geo import haversine_km
from beaconry.functions.rules import (
    any_rule, bucket_label, code_label, compare, first_case, like_label, metric_rule,
)
from beaconry.functions.syslog import syslog_fields, syslog_param, with_parts
from beaconry.functions.time import as_of_column, event_age_minutes, latest_time

__all__ = [
    "any_rule", "as_of_column", "bucket_label", "code_label", "compare", "event_age_minutes",
    "first_case", "haversine_km", "latest_time", "like_label", "metric_rule", "syslog_fields",
    "syslog_param", "with_parts",
]
