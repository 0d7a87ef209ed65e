"""Ordered operators that stay parallel when one key holds most of the rows.

A window sorts each of its partitions in one task. A key with a third of all rows would put a
third of the table into that task, so heavy keys are first cut into segments along the sort
order. ``cut_points`` takes a sample of the distinct (key, order) tuples by hash at a fixed rate,
which gives the same cuts whenever it is evaluated, and ends a segment after every so many sampled
tuples: a segment's size is the same at every table size. Each row finds its segment by a join with
the cuts. Windows then run per (key, segment); what crosses a segment border (the last value, a
running sum) comes from one aggregated row per segment. A key that fits one segment has no cuts.

What is sorted never holds ties: callers give a unique order, or count ties before the sort. So
distinct tuples are the rows of the sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racecast.functions import as_column
from racecast.session import materialise

SEG = "_seg"


@dataclass(frozen=True)
class Split:
    """How finely keys are cut: one task sorts about ``rows_per_segment`` rows.

    ``sampled`` tuples stand for a segment, so its size strays by about one part in their square root.
    Up to ``broadcast_cuts`` cuts are broadcast; more are joined by key, with skewed keys left to
    adaptive execution.
    """

    rows_per_segment: int = 2_000_000
    sampled: int = 64
    broadcast_cuts: int = 100_000


DEFAULT_SPLIT = Split()


@dataclass(frozen=True)
class Cuts:
    """Segments (keys, _seg, _lo, _hi) of the heavy keys, and the most that one key has."""

    table: DataFrame
    longest: int
    broadcast: bool

    def near(self, table: DataFrame) -> DataFrame:
        """``table``, which has at most one row per segment, ready to be joined."""
        return F.broadcast(table) if self.broadcast else table


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def cut_sample(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split) -> DataFrame:
    """The distinct (key, order) tuples whose hash falls to a fixed share."""
    step = max(1, split.rows_per_segment // split.sampled)
    return df.select(*keys, *order).filter(F.pmod(F.xxhash64(*keys, *order), F.lit(step)) == 0).distinct()


def cut_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split = DEFAULT_SPLIT) -> DataFrame:
    """Segments (keys, _seg, _lo, _hi) of the keys estimated to hold two segments or more.

    A segment holds the rows with ``_lo <= order tuple < _hi``; NULL stands for an open end.
    """
    sample = cut_sample(df, keys, order, split)
    in_order = Window.partitionBy(*keys).orderBy(*order)
    at = F.struct(*order)
    ranked = sample.withColumns(
        {
            "_at": F.row_number().over(in_order) - 1,
            "_size": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
        }
    )
    cuts = ranked.filter((F.col("_at") % split.sampled == 0) & (F.col("_size") >= 2 * split.sampled))
    return cuts.select(
        *keys,
        (F.col("_at") / split.sampled).cast("int").alias(SEG),
        F.when(F.col("_at") > 0, at).alias("_lo"),
        F.lead(at).over(in_order).alias("_hi"),
    )


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split = DEFAULT_SPLIT
) -> Cuts | None:
    """The cuts of ``df``, computed once; None where no key needs any, so that the plain window is planned.

    Whether a key needs cuts is seen from the counts of the sample alone, without ordering or keeping it.
    """
    sizes = cut_sample(df, keys, order, split).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if not (sizes.agg(F.max("n")).first()[0] or 0) >= 2 * split.sampled:
        return None
    table = materialise(cut_points(df, keys, order, split))
    n, last = table.agg(F.count(F.lit(1)), F.max(SEG)).first()
    return Cuts(table, last + 1, n <= split.broadcast_cuts)


def _lookup(df: DataFrame, near: DataFrame, keys: Sequence[str], at: Column, lo: str, hi: str) -> DataFrame:
    """Left join with the row of ``near`` that has the same keys (there named _cut_) and ``lo <= at < hi``."""
    same_key = [F.col(k).eqNullSafe(F.col(f"_cut_{k}")) for k in keys]
    inside = [F.col(lo).isNull() | (at >= F.col(lo)), F.col(hi).isNull() | (at < F.col(hi))]
    return df.join(near, all_of(same_key + inside), "left").drop(lo, hi, *(f"_cut_{k}" for k in keys))


def with_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts) -> DataFrame:
    """``df`` with its segment number; NULL for keys without cuts.

    A row is compared with its key's blocks of segments, then with the segments of its block: for a key
    with n segments about twice the square root of n comparisons.
    """
    at = F.struct(*order)
    block = (F.col(SEG) / math.ceil(math.sqrt(cuts.longest))).cast("int")
    table = cuts.table.withColumn("_block", block).withColumnsRenamed({k: f"_cut_{k}" for k in keys})
    named = [f"_cut_{k}" for k in keys]
    blocks = table.groupBy(*named, "_block").agg(
        F.min_by("_lo", SEG).alias("_block_lo"), F.max_by("_hi", SEG).alias("_block_hi")
    )
    segments = table.withColumnRenamed("_block", "_cut__block")
    in_block = _lookup(df, cuts.near(blocks), keys, at, "_block_lo", "_block_hi")
    return _lookup(in_block, cuts.near(segments), [*keys, "_block"], at, "_lo", "_hi").drop("_block")


def with_border_values(rows: DataFrame, keys: Sequence[str], borders: DataFrame, cuts: Cuts) -> DataFrame:
    """Attach the per-segment ``borders``: one row per cut, so as small as the cuts."""
    near = cuts.near(borders.withColumnsRenamed({k: f"_b_{k}" for k in (*keys, SEG)}))
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    joined = rows.join(near, all_of([*same, F.col(SEG) == F.col(f"_b_{SEG}")]), "left")
    return joined.drop(*(f"_b_{k}" for k in (*keys, SEG)))


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "previous",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """``lag(value, 1)`` per key. ``order`` must end in a column that makes it unique."""
    cuts = find_cuts(df, keys, order, split)
    if cuts is None:
        return df.withColumn(out, F.lag(value, 1).over(Window.partitionBy(*keys).orderBy(*order)))
    tagged = with_segments(df, keys, order, cuts)
    in_order = Window.partitionBy(*keys, SEG).orderBy(*order)
    local = tagged.withColumns(
        {"_prev": F.lag(value, 1).over(in_order), "_at": F.row_number().over(in_order)}
    )
    tails = (
        tagged.filter(F.col(SEG).isNotNull())
        .groupBy(*keys, SEG)
        .agg(F.max_by(F.col(value), F.struct(*order)).alias("_tail"))
    )
    along = Window.partitionBy(*keys).orderBy(SEG)
    borders = tails.select(*keys, SEG, F.lag("_tail", 1).over(along).alias("_carry"))
    joined = with_border_values(local, keys, borders, cuts)
    at_border = (F.col("_at") == 1) & (F.col(SEG) > 0)
    return joined.withColumn(out, F.when(at_border, F.col("_carry")).otherwise(F.col("_prev"))).drop(
        SEG, "_prev", "_at", "_carry"
    )


def _segment_sums(tagged: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per segment of a heavy key: ``_before_v``, the sum over its earlier segments, and ``_all_v``."""
    sums = (
        tagged.filter(F.col(SEG).isNotNull())
        .groupBy(*keys, SEG)
        .agg(*(F.sum(name).alias(f"_sum_{name}") for name in names))
    )
    along = Window.partitionBy(*keys).orderBy(SEG)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sums.select(
        *keys,
        SEG,
        *(F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in names),
        *(F.sum(f"_sum_{name}").over(whole).alias(f"_all_{name}") for name in names),
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str | Column],
    split: Split = DEFAULT_SPLIT,
    sample_from: DataFrame | None = None,
    counted: bool = False,
) -> DataFrame:
    """One row per (keys, order) with, for each value ``v``, three sums.

    ``v`` is the sum there, ``cum_v`` the sum up to there, ``all_v`` the sum over the key. Rows are
    pre-aggregated per (keys, order) before any sort, so ties cost nothing however many; with
    ``counted`` they are taken to be so already. With no keys the whole table is one sequence.
    ``sample_from`` is a table with the same keys and order that is cheaper to read than ``df``.
    """
    values = {name: as_column(v) for name, v in values.items()}
    source = df if sample_from is None else sample_from
    whole = not keys
    if whole:
        # A computed constant keeps the segment lookup an equi-join.
        one = {"_one": F.pmod(F.xxhash64(*order), F.lit(1))}
        df, source, keys = df.withColumns(one), source.withColumns(one), ["_one"]
    cuts = find_cuts(source, keys, order, split)
    if counted:
        per_order = df.select(*keys, *order, *(v.alias(name) for name, v in values.items()))
    else:
        per_order = df.groupBy(*keys, *order).agg(*(F.sum(v).alias(name) for name, v in values.items()))
    parts = list(keys)
    if cuts is not None:
        per_order, parts = with_segments(per_order, keys, order, cuts), [*keys, SEG]
    up_to = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    in_part = Window.partitionBy(*parts)
    local = per_order.withColumns(
        {f"cum_{name}": F.sum(name).over(up_to) for name in values}
        | {f"all_{name}": F.sum(name).over(in_part) for name in values}
    )
    if cuts is None:
        return local.drop(*(keys if whole else []))
    joined = with_border_values(local, keys, _segment_sums(per_order, keys, list(values)), cuts)
    out = {}
    for name in values:
        before, cum = F.col(f"_before_{name}"), F.col(f"cum_{name}")
        out[f"cum_{name}"] = F.when(before.isNull(), cum).otherwise(F.coalesce(cum, F.lit(0)) + before)
        out[f"all_{name}"] = F.when(F.col(SEG).isNull(), F.col(f"all_{name}")).otherwise(F.col(f"_all_{name}"))
    passing = [f"_{part}_{name}" for part in ("before", "all") for name in values]
    return joined.withColumns(out).drop(SEG, *passing, *(keys if whole else []))


def running_counts(
    df: DataFrame, keys: Sequence[str], order: str, out: str, split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """(keys, order, out): one row per order value of a key, with the key's rows up to and including it."""
    known = F.when(F.col(order).isNotNull(), 1).otherwise(0)
    counts = running_total(df, keys, [order], {"_n": known}, split)
    return counts.select(*keys, order, F.col("cum__n").alias(out))


def running_count(
    df: DataFrame, keys: Sequence[str], order: str, out: str, split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """Per row, how many rows of its key have an order value up to and including its own.

    Rows are counted per (keys, order) before the sort and the running count is joined back, so neither a
    heavy key nor a heavy (key, order) pair is sorted in one task; the join back has one row per pair on
    its right, and adaptive execution splits a skewed left.
    """
    back = running_counts(df, keys, order, out, split).withColumnsRenamed({c: f"_at_{c}" for c in (*keys, order)})
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in (*keys, order)]
    return df.join(back, all_of(same), "left").drop(*(f"_at_{c}" for c in (*keys, order)))
