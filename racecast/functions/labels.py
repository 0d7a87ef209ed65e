"""Labels, bands and 0/1 flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racecast.functions.parse import as_column

# Label names, their order and the limits between them.
SEASON_MONTHS = {
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
    "Winter": (12, 1, 2),
}
TIME_BANDS = {
    "Morning": ("06:00:00", "11:59:59"),
    "Afternoon": ("12:00:00", "17:59:59"),
    "Evening": ("18:00:00", "20:59:59"),
    "Night": ("21:00:00", "05:59:59"),
}
DAY_START, DAY_END = "00:00:00", "23:59:59"
POSITION_GROUPS = {"Top 3": 3, "Top 10": 10}
POSITION_REST = "Outside Top 10"
FREQUENCY_LABELS = (
    "High Pit Stop Frequency",
    "Low Pit Stop Frequency",
    "Normal Pit Stop Frequency",
)


def season_of_month(month: str | Column, unknown: str = "Unknown") -> Column:
    month = as_column(month)
    names = [F.when(month.isin(*months), name) for name, months in SEASON_MONTHS.items()]
    return F.coalesce(*names, F.lit(unknown))


def season_of(date: str | Column) -> Column:
    """Season name of a date; 'Unknown' for NULL."""
    return season_of_month(F.month(as_column(date)))


def time_band(time: str | Column, strict_compat: bool = False) -> Column:
    """Part of the day of an 'HH:mm:ss' text.

    A band that passes midnight covers its two halves. With ``strict_compat`` its limits are
    compared as they stand, which matches no time at all, so night times give NULL.
    """
    time = as_column(time)
    cases = []
    for name, (start, end) in TIME_BANDS.items():
        inside = time.between(start, end)
        if start > end and not strict_compat:
            inside = time.between(start, DAY_END) | time.between(DAY_START, end)
        cases.append(F.when(inside, name))
    return F.coalesce(*cases)


def position_group(position: str | Column) -> Column:
    """Finishing group; NULL positions count as outside the top ten."""
    position = as_column(position)
    cases = [F.when(position <= limit, name) for name, limit in POSITION_GROUPS.items()]
    return F.coalesce(*cases, F.lit(POSITION_REST))


def frequency_label(
    count: str | Column,
    threshold: float | Column = 2,
    labels: tuple[str, str, str] = FREQUENCY_LABELS,
) -> Column:
    """(high, low, neither) label: above, up to, or not comparable with the threshold."""
    above = as_column(count) > threshold
    high, low, neither = (F.lit(text) for text in labels)
    return F.when(above, high).when(~above, low).otherwise(neither)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(condition, 1).otherwise(0)
