"""Features per driver, team, race entry and race.

Column names are parameters, so each operator also serves tables from other domains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.functions import as_column, flag, frequency_label, parse_mixed_date, safe_ratio
from racecast.operators.ordered import (
    DEFAULT_SPLIT,
    Split,
    previous_value,
    running_count,
    running_counts,
    running_total,
)
from racecast.operators.skew import DEFAULT_SKEW, Skew, salted_join

# Season the ages refer to, and the marks for "no earlier lap" and "single stop".
AGE_YEAR = 2018
NO_EARLIER_LAP = -1
SINGLE_STOP = -1.0
STEADY_INDEX = 1.0


def age_in_year(df: DataFrame, key: str, dob: str | Column, year: int = AGE_YEAR, out: str = "age") -> DataFrame:
    """One row per key: ``year`` less the year of birth. ``dob`` is a date or mixed-layout text."""
    born = as_column(dob)
    return df.groupBy(key).agg(F.max(F.lit(year) - F.year(born)).alias(out))


def with_parsed_date(df: DataFrame, c: str, out: str) -> DataFrame:
    return df.withColumn(out, parse_mixed_date(c))


def win_rate(df: DataFrame, key: str, event: str, won: Column) -> DataFrame:
    """One row per key: total_wins, total_races (distinct events), win_rate.

    The distinct count is spread over (key, event) before it is summed per key, so a heavy key
    is no heavy task.
    """
    totals = df.groupBy(key).agg(
        F.sum(flag(won)).alias("total_wins"), F.countDistinct(event).alias("total_races")
    )
    return totals.withColumn("win_rate", F.round(safe_ratio(F.col("total_wins"), F.col("total_races")), 3))


def win_rate_as_of(
    df: DataFrame, key: str, event: str, won: Column, split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """As ``win_rate``, but one row per (key, event) that knows only the earlier events."""
    per_event = df.groupBy(key, event).agg(F.sum(flag(won)).alias("wins"))
    totals = running_total(
        per_event, [key], [event], {"wins": F.col("wins"), "races": F.lit(1)}, split, sample_from=df
    )
    wins, races = F.col("cum_wins") - F.col("wins"), F.col("cum_races") - F.col("races")
    return totals.select(
        key,
        event,
        wins.alias("wins_before"),
        races.alias("races_before"),
        F.round(safe_ratio(wins, races), 3).alias("win_rate_before"),
    )


def with_race_date(entries: DataFrame, races: DataFrame, key: str, date: str) -> DataFrame:
    """Attach each entry's race date (NULL for unknown races) as a date, and its year."""
    dated = entries.join(races.select(key, date), key, "left")
    return dated.withColumns({date: F.to_date(date), f"{date}_year": F.year(F.to_date(date))})


def driver_profile(age: DataFrame, wins: DataFrame, key: str) -> DataFrame:
    """Age with win rate; drivers without results keep NULL win columns."""
    return age.join(wins, key, "left")


def position_change(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    position: str,
    out: str = "position_change",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Places gained since the previous row (negative: lost); -1 where there is none.

    ``order`` must be unique within ``partition``, which is normally (race, driver).
    """
    before = previous_value(df, partition, order, position, "_before", split)
    gained = F.when(F.col("_before").isNull(), NO_EARLIER_LAP).otherwise(F.col("_before") - F.col(position))
    return before.withColumn(out, gained).drop("_before")


def position_summary(df: DataFrame, keys: Sequence[str], change: str, position: str) -> DataFrame:
    """Rounded mean change and worst position per key, from rows of ``position_change``."""
    return df.groupBy(*keys).agg(
        F.round(F.avg(change), 0).alias("avg_position_change"), F.max(position).alias("max_position")
    )


def position_summary_direct(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], position: str
) -> DataFrame:
    """``position_summary`` of ``position_change(partition=keys)`` in one aggregation, no window.

    Changes within a key add up to first less last position, and its first row counts -1. This
    holds for known positions only: a NULL one stops the query, use the window form then.
    """
    # A single plain order column keeps the aggregation hashed; a tuple has to be sorted by key.
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    known = F.coalesce(F.col(position), F.raise_error(F.lit(f"{position} is NULL: use position_change")).cast("int"))
    net = F.min_by(known, at) - F.max_by(known, at) + F.lit(NO_EARLIER_LAP)
    return df.groupBy(*keys).agg(
        F.round(net / F.count(F.lit(1)), 0).alias("avg_position_change"), F.max(known).alias("max_position")
    )


def position_change_index(
    mean_change: str | Column = "avg_position_change",
    worst: str | Column = "max_position",
    scale: int = 0,
) -> Column:
    """Share of the possible change not used, signed: positive for gains, else negative.

    A driver who was first throughout has no possible change and gets 1.
    """
    mean_change, worst = as_column(mean_change), as_column(worst)
    sign = F.when(mean_change > 0, 1).otherwise(-1)
    unused = F.lit(1) - safe_ratio(F.abs(mean_change), worst - 1)
    return F.coalesce(F.round(unused * sign, scale), F.lit(STEADY_INDEX))


def stop_summary(df: DataFrame, keys: Sequence[str], duration: str, lap: str) -> DataFrame:
    """Stops per entry: total and mean duration, number, mean gap in laps, duration per gap lap.

    One stop has no gap (-1); stops on one lap have gap 0 and no efficiency.
    """
    stops = F.count(lap)
    gap = safe_ratio(F.max(lap) - F.min(lap), stops - 1)
    totals = df.groupBy(*keys).agg(
        F.sum(duration).alias("total_stop_duration"),
        F.round(F.avg(duration), 0).alias("avg_stop_duration"),
        stops.alias("total_stops"),
        F.when(stops > 1, F.round(gap, 0)).otherwise(SINGLE_STOP).alias("avg_laps_between_stops"),
    )
    efficiency = safe_ratio(F.col("avg_stop_duration"), F.col("avg_laps_between_stops"))
    return totals.withColumn("stop_efficiency", F.round(efficiency, 2))


def labelled_stops(stops: DataFrame, threshold: float = 2, out: str = "stop_frequency_label") -> DataFrame:
    """Complete stop rows with their frequency label; rows with any NULL are dropped."""
    return stops.withColumn(out, frequency_label("total_stops", threshold)).na.drop("any")


def experience(
    df: DataFrame,
    key: str,
    event: str,
    out: str = "experience",
    split: Split = DEFAULT_SPLIT,
    heavy: Skew | None = DEFAULT_SKEW,
) -> DataFrame:
    """Running count of a key's rows by event, rows of the same event counted together.

    The count of an event is joined back to its rows, with pairs of key and event that hold many rows salted.
    """
    if heavy is None:
        return running_count(df, [key], event, out, split)
    return salted_join(df, running_counts(df, [key], event, out, split), [key, event], "left", heavy, null_safe=True).select(
        *df.columns, out
    )


def group_success(
    df: DataFrame, key: str, rank: str, k: int = 3, out: str = "group_success", heavy: Skew | None = DEFAULT_SKEW
) -> DataFrame:
    """1 on all rows of a key of which any row has rank <= k, else 0. Rows without key are dropped.

    Aggregate and join rather than a window: a heavy key is reduced before the shuffle, and the join back deals its
    rows out to several tasks.
    """
    flags = df.groupBy(key).agg(F.max(flag(F.col(rank) <= k)).alias(out))
    return df.join(flags, key) if heavy is None else salted_join(df, flags, [key], "inner", heavy)
