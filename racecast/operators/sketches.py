"""Mergeable sketches per part of a table, kept and united instead of reading the whole table again.

A part is whatever ``by`` says, such as the day or batch in which rows came. Its sketches are a few kilobytes each,
whatever its rows. The union of the parts' sketches is a sketch of all rows, with the error of one sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.operators.explore import QUARTILES
from racecast.operators.quality import missing

# 2^12 counters: an estimate of distinct values has a standard error of 1.04 / sqrt(2^12), 1.6 %.
HLL_BITS = 12
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)

# With k = 400 the rank of a returned quantile is off by less than 0.7 % of the rows, with 99 % confidence.
KLL_SIZE = 400
RANK_ERROR = 0.007


def _named(columns: Sequence[str], fields: Sequence[str]) -> Column:
    """One struct for each column, to be turned into rows."""
    return F.array(
        *(F.struct(F.lit(c).alias("column_name"), *(F.col(f"{c}__{f}").alias(f) for f in fields)) for c in columns)
    )


def distinct_sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, n, sketch) of the known values of each column, in one pass over all of them."""
    columns = [c for c in columns or df.columns if c not in by]
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__n"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS)).alias(f"{c}__sketch")]
    wide = df.groupBy(*by).agg(*aggs)
    return wide.select(*by, F.inline(_named(columns, ["n", "sketch"])))


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of several parts as one for each column (and ``by``)."""
    return sketches.groupBy(*by, "column_name").agg(F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``sketches`` with n_distinct in the place of the sketch; see ``DISTINCT_ERROR``. Never above n."""
    known = F.least(F.hll_sketch_estimate("sketch"), F.col("n"))
    return sketches.withColumn("n_distinct", known).drop("sketch")


def quantile_sketches(df: DataFrame, group: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, group, n, low, high, sketch) of the known values of each group."""
    known = df.filter(~missing(df, value)).select(*by, group, F.col(value).cast("double").alias("_v"))
    return known.groupBy(*by, group).agg(
        F.count("_v").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"),
        F.kll_sketch_agg_double("_v", F.lit(KLL_SIZE)).alias("sketch"),
    )


def united_quantiles(sketches: DataFrame, group: str, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of several parts as one for each group (and ``by``)."""
    return sketches.groupBy(*by, group).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", F.lit(KLL_SIZE)).alias("sketch"),
    )


def sketched_quartiles(sketches: DataFrame, group: str) -> DataFrame:
    """(group, n, low, q1, median, q3, high): ends exact, quartiles values whose rank is right up to ``RANK_ERROR``."""
    picks = (F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name) for name, share in QUARTILES.items())
    return sketches.select(group, "n", "low", *picks, "high")
