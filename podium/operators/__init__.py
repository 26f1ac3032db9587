"""DataFrame -> DataFrame transformations. Lazy, no actions, same code on batch and stream frames."""

from podium.operators.cleaning import clean_strings, deduplicate, numeric_rows
from podium.operators.history import as_of, latest_per_key, merged
from podium.operators.joins import fits_broadcast, hot_keys, join_reference, plan_bytes
from podium.operators.layout import along_curve, quantile_bounds
from podium.operators.messages import (
    observe_bad,
    parse_messages,
    parse_variants,
    payload_schema,
    to_messages,
    variant_fields,
)
from podium.operators.stats import GOLD, STREAM, StatsSpec, group_averages, reference_stats

__all__ = [
    "GOLD",
    "STREAM",
    "StatsSpec",
    "along_curve",
    "as_of",
    "clean_strings",
    "deduplicate",
    "fits_broadcast",
    "group_averages",
    "hot_keys",
    "join_reference",
    "latest_per_key",
    "merged",
    "numeric_rows",
    "observe_bad",
    "parse_messages",
    "parse_variants",
    "payload_schema",
    "plan_bytes",
    "quantile_bounds",
    "reference_stats",
    "to_messages",
    "variant_fields",
]
