"""Column-level expressions; every one is a composition of Spark built-ins."""

from racecast.functions.labels import (
    FREQUENCY_LABELS,
    POSITION_GROUPS,
    SEASON_MONTHS,
    TIME_BANDS,
    flag,
    frequency_label,
    position_group,
    season_of,
    season_of_month,
    time_band,
)
from racecast.functions.parse import (
    as_column,
    clean_int,
    clean_float,
    full_name,
    is_missing,
    lap_time_ms,
    parse_mixed_date,
    safe_ratio,
)

__all__ = [
    "FREQUENCY_LABELS",
    "POSITION_GROUPS",
    "SEASON_MONTHS",
    "TIME_BANDS",
    "as_column",
    "clean_float",
    "clean_int",
    "flag",
    "frequency_label",
    "full_name",
    "is_missing",
    "lap_time_ms",
    "parse_mixed_date",
    "position_group",
    "safe_ratio",
    "season_of",
    "season_of_month",
    "time_band",
]
