"""Histories per key as a small state that new events advance, instead of a run over all history.

A state has one row per key: its distinct events (``races``), its rows (``entries``), a sum for each named count, and
its last event. New events must lie after the last event of their key; then only they are read, sorted and counted,
and the state's row is added to what they give. State and features equal those of a full run over all events.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.functions import as_column, safe_ratio
from racecast.operators.ordered import DEFAULT_SPLIT, Split, running_total

LAST = "last_event"
FIXED = ("races", "entries")


def _per_event(events: DataFrame, key: str, event: str, counts: dict[str, str | Column]) -> DataFrame:
    """(key, event, races, entries, counts): rows of one event counted together; rows without key or event go."""
    known = events.filter(F.col(key).isNotNull() & F.col(event).isNotNull())
    sums = (F.sum(as_column(c)).cast("bigint").alias(name) for name, c in counts.items())
    return known.groupBy(key, event).agg(F.count(F.lit(1)).alias("entries"), *sums).withColumn("races", F.lit(1).cast("bigint"))


def _summed(parts: DataFrame, key: str, names: list[str], last: str) -> DataFrame:
    return parts.groupBy(key).agg(*(F.sum(n).alias(n) for n in names), F.max(last).alias(LAST))


def history_state(events: DataFrame, key: str, event: str, counts: dict[str, str | Column]) -> DataFrame:
    """(key, races, entries, counts, last_event) of all events given; the state to start from."""
    return _summed(_per_event(events, key, event, counts), key, [*FIXED, *counts], event)


def late_events(state: DataFrame, new: DataFrame, key: str, event: str) -> DataFrame:
    """The new rows that do not lie after the last event of their key: these keys need a full run."""
    return new.join(state.select(key, LAST), key).filter(F.col(event) <= F.col(LAST)).drop(LAST)


@dataclass(frozen=True)
class Advanced:
    """``features``: (key, event, races, entries and counts before the event) of the new events. ``state``: the new state."""

    features: DataFrame
    state: DataFrame


def advance(
    state: DataFrame,
    new: DataFrame,
    key: str,
    event: str,
    counts: dict[str, str | Column],
    split: Split = DEFAULT_SPLIT,
) -> Advanced:
    """Features of the new events and the state after them, from the state and the new events alone.

    ``counts`` are those the state was made with. A new event that is not after its key's last one stops the query;
    ``late_events`` lists such rows. Keys new to the state start from nothing.
    """
    names = [*FIXED, *counts]
    fresh = _per_event(new, key, event, counts)
    order = running_total(fresh, [key], [event], {n: n for n in names}, split, counted=True)
    before = state.select(key, LAST, *(F.col(n).alias(f"_{n}") for n in names))
    joined = order.join(before, key, "left")
    late = F.col(event) <= F.col(LAST)
    in_order = F.when(late, F.raise_error(F.lit(f"{event} is not after the last one of its {key}")).cast("bigint")).otherwise(0)

    def earlier(name: str) -> Column:
        return (F.coalesce(f"_{name}", F.lit(0)) + F.col(f"cum_{name}") - F.col(name) + in_order).alias(f"{name}_before")

    # The difference of two sums of the new events is the sum of the earlier ones.
    features = joined.select(key, event, *(earlier(n) for n in names))
    parts = state.select(key, *names, LAST).unionByName(fresh.select(key, *names, F.col(event).alias(LAST)))
    return Advanced(features, _summed(parts, key, names, LAST))


def rate(features: DataFrame, count: str, out: str) -> DataFrame:
    """Share of a count in the races before, NULL before the first race."""
    return features.withColumn(out, F.round(safe_ratio(F.col(f"{count}_before"), F.col("races_before")), 3))
