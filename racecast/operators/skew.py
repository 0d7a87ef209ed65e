"""Frequent keys, and joins of a table that may hold most of its rows in a few of them.

A join sends all rows of a key to one task. Keys that hold more than a share of the left table's rows are found
by a mergeable sketch of frequent items, in one pass over the key columns; at most ``1 / share`` keys can be so
frequent, which bounds what reaches the driver and what is broadcast, at every table size. Only their
rows get a salt, and only their rows of the right table are repeated, once for each salt. All other rows are
joined as they are. Where no key is frequent the plain join is planned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racecast.operators.ordered import all_of

KEPT_LEFT = ("inner", "left", "left_semi", "left_anti")


@dataclass(frozen=True)
class Skew:
    """A key is heavy with more than ``share`` of all rows, and is dealt out in pieces of that share.

    The sketch tracks ``tracked`` items, so a count is off by at most about ``3.5 / tracked`` of all rows: keep
    ``share`` well above that.
    """

    share: float = 0.002
    tracked: int = 20_000

    @property
    def most(self) -> int:
        """How many keys can be heavy."""
        return math.floor(1 / self.share)


DEFAULT_SKEW = Skew()


def _hashed(df: DataFrame, keys: Sequence[str], like: DataFrame) -> Column:
    """Hash of the keys in the types that they have in ``like``."""
    return F.xxhash64(*(F.col(k).cast(like.schema[k].dataType) for k in keys))


def _candidates(df: DataFrame, keys: Sequence[str], skew: Skew) -> DataFrame:
    """(_hash, _count, _rows): the most frequent key hashes with their estimated counts, and the number of rows."""
    if skew.share * skew.tracked < 7:
        raise ValueError(f"a share of {skew.share} needs {math.ceil(7 / skew.share)} tracked items or more")
    hashes = df.select(_hashed(df, keys, df).alias("h"))
    top = F.call_function("approx_top_k", F.col("h"), F.lit(skew.most), F.lit(skew.tracked))
    found = hashes.agg(top.alias("top"), F.count(F.lit(1)).alias("_rows"))
    return found.select("_rows", F.inline("top").alias("_hash", "_count"))


def heavy_keys(df: DataFrame, keys: Sequence[str], skew: Skew = DEFAULT_SKEW) -> list[tuple[int, int]]:
    """(hash of the key, pieces it is dealt into) of the heavy keys: at most ``skew.most``. Runs a job."""
    piece = F.col("_rows") * skew.share
    found = _candidates(df, keys, skew).filter(F.col("_count") > piece)
    return [tuple(r) for r in found.select("_hash", F.ceil(F.col("_count") / piece).cast("int")).collect()]


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float = 0.01, tracked: int = 20_000) -> DataFrame:
    """(keys, n): the keys that hold at least ``share`` of all rows, with exact counts.

    The sketch proposes keys down to half the share; these alone are counted, so one row a task and proposed
    key is shuffled, not one for every key of the table.
    """
    skew = Skew(share / 2, tracked)
    near = _candidates(df, keys, skew).filter(F.col("_count") >= F.col("_rows") * skew.share)
    near = F.broadcast(near.select("_hash", "_rows"))
    rows = df.select(*keys, _hashed(df, keys, df).alias("_hash")).join(near, "_hash")
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("_rows").alias("_rows"))
    return counts.filter(F.col("n") >= F.col("_rows") * share).drop("_rows")


def _salt(df: DataFrame) -> Column:
    """A number that spreads rows and is the same when a lost task is run again, in whatever order its rows come.

    Copies of one row are spread by the tasks that hold them.
    """
    plain = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(F.spark_partition_id(), *plain)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    skew: Skew = DEFAULT_SKEW,
    null_safe: bool = False,
    heavy_from: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` that splits the heavy keys of ``left`` over tasks.

    ``how`` keeps rows of the left only, since a repeated right row without partner would appear more than once.
    ``null_safe`` joins NULL with NULL. In a left join rows without a key are spread too, if they are many.
    ``heavy_from`` is a table with about the same share of rows for each key that is cheaper to read than ``left``.
    Columns are the keys, those of ``left``, those of ``right``; other names must not occur in both.
    """
    if how not in KEPT_LEFT:
        raise ValueError(f"a salted join keeps left rows only: {', '.join(KEPT_LEFT)}, not {how}")
    found = heavy_keys(left if heavy_from is None else heavy_from, keys, skew)
    parts = list(keys)
    if found:
        table = F.broadcast(left.sparkSession.createDataFrame(found, "_hash bigint, _pieces int"))
        near = left.withColumn("_hash", _hashed(left, keys, left)).join(table, "_hash", "left")
        salt = F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(_salt(left), "_pieces").cast("int"))
        left = near.withColumn("_salt", salt).drop("_hash", "_pieces")
        far = right.withColumn("_hash", _hashed(right, keys, left)).join(table, "_hash", "left")
        salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces") - 1, F.lit(0))))
        right = far.withColumn("_salt", salts).drop("_hash", "_pieces")
        parts.append("_salt")
    if not null_safe:
        return left.join(right, parts, how).drop("_salt")
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in parts})
    joined = left.join(named, all_of([F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in parts]), how)
    joined = joined.drop("_salt", *(f"_right_{k}" for k in parts))
    return joined.select(*keys, *(c for c in joined.columns if c not in keys))
