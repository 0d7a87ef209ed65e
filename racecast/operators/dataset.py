"""The training table: dimensions, joins, label and split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.functions import flag
from racecast.operators.skew import Skew, salted_join

HASH_BITS = 32


def clean_dimension(df: DataFrame, renames: dict[str, str] | None = None, drops: Sequence[str] = ()) -> DataFrame:
    """Rename columns that would collide after joins and drop those not needed."""
    return df.withColumnsRenamed(renames or {}).drop(*drops)


def base_table(
    entries: DataFrame,
    joins: Sequence[tuple[DataFrame, str | Sequence[str]]],
    drops: Sequence[str] = (),
    how: str = "inner",
    heavy: Skew | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """``entries`` joined in turn with each (table, key or keys).

    With ``how="inner"`` an entry survives only if every table knows it. No side is forced to be
    broadcast: Spark decides by measured size, and splits skewed partitions of a sorted join. With ``heavy`` keys
    that hold many entries are looked for in ``entries`` (one pass over the keys of each join) and salted; the keys
    must then be columns of ``entries``. With ``null_safe`` a NULL key matches a NULL key, as when data frames are
    merged in memory; else rows without a key find no partner.
    """
    on_keys = [(table, [keys] if isinstance(keys, str) else list(keys)) for table, keys in joins]
    if heavy is not None:
        joined = entries
        for table, keys in on_keys:
            joined = salted_join(joined, table, keys, how, heavy, null_safe, entries)
        return joined.drop(*drops)
    if null_safe:
        return reduce(lambda left, right: _null_safe_join(left, *right, how), on_keys, entries).drop(*drops)
    return reduce(lambda left, right: left.join(right[0], right[1], how), on_keys, entries).drop(*drops)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which NULL equals NULL; columns as of a join on names."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))
    joined = left.join(named, same, how)
    if how in ("right", "full", "outer", "right_outer", "full_outer"):
        joined = joined.withColumns({k: F.coalesce(k, f"_right_{k}") for k in keys})
    joined = joined.drop(*(f"_right_{k}" for k in keys))
    return joined.select(*keys, *(c for c in joined.columns if c not in keys))


def binary_label(c: str, positive: str, out: str | None = None) -> Column:
    """1 for the positive value, 0 for any other and for NULL."""
    return flag(F.col(c) == positive).alias(out or c)


def split_share(keys: Sequence[str], seed: int | str = 123, portable: bool = False) -> Column:
    """Number in [0, 1) that depends on the key values and seed only.

    ``portable`` takes MD5 of the keys' text, which other engines compute too; the default hash is
    faster.
    """
    if portable:
        text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
        return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long") / F.lit(2**HASH_BITS)
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(2**HASH_BITS)) / F.lit(2**HASH_BITS)


def split_by_hash(
    df: DataFrame, keys: Sequence[str], ratio: float = 0.7, seed: int = 123, portable: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the same rows on every run, however the table is partitioned."""
    in_train = split_share(keys, seed, portable) < ratio
    return df.filter(in_train), df.filter(~in_train)


def split_sizes(
    df: DataFrame, keys: Sequence[str], ratio: float = 0.7, seed: int = 123, portable: bool = False
) -> DataFrame:
    """(split, n) for both parts in one pass."""
    part = F.when(split_share(keys, seed, portable) < ratio, "train").otherwise("test")
    return df.groupBy(part.alias("split")).agg(F.count(F.lit(1)).alias("n"))
