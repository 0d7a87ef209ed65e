"""Profiles of a table and repair of its gaps."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racecast.functions import clean_int, is_missing

FLOATING = (T.DoubleType, T.FloatType)


def _is_floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, FLOATING)


def _rows(one_row: DataFrame, columns: Sequence[str], fields: Iterable[str], name: str = "column_name") -> DataFrame:
    """Turn the one-row aggregate with columns ``<c>__<field>`` into one row per column."""
    structs = [
        F.struct(F.lit(c).alias(name), *(F.col(f"{c}__{field}").alias(field) for field in fields)) for c in columns
    ]
    return one_row.select(F.inline(F.array(*structs)))


def missing(df: DataFrame, c: str) -> Column:
    return is_missing(F.col(c), _is_floating(df, c))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_null): NULL or NaN values per column, in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*(F.count(F.when(missing(df, c), 1)).alias(f"{c}__n_null") for c in columns))
    return _rows(counts, columns, ["n_null"])


def null_rows(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNull())


def _as_key(df: DataFrame, c: str) -> Column:
    """The value as text, equal for equal values only."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    # -0.0 and 0.0 are one value.
    return (F.col(c) + 0.0 if isinstance(kind, FLOATING) else F.col(c)).cast("string")


def cardinality(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False, one_scan: bool = False
) -> DataFrame:
    """(column_name, n_distinct): distinct non-NULL values per column.

    Exact counts take each column by itself, which reads a columnar table once in total and
    shuffles distinct values only. ``one_scan`` is for tables that are dear to read or to parse, such as CSV files: every
    row is read once and gives a value for each column, made distinct within its task before anything is shuffled.
    ``approximate`` is one pass with a fixed-size sketch per column.
    """
    columns = list(columns or df.columns)
    if approximate:
        sketches = df.agg(*(F.approx_count_distinct(c).alias(f"{c}__n_distinct") for c in columns))
        return _rows(sketches, columns, ["n_distinct"])
    if one_scan:
        values = df.select(F.posexplode(F.array(*(_as_key(df, c) for c in columns))).alias("_i", "_v"))
        counts = values.filter(F.col("_v").isNotNull()).distinct().groupBy("_i").agg(F.count(F.lit(1)).alias("_n"))
        # A column without a value has no row there.
        all_ = df.sparkSession.createDataFrame(list(enumerate(columns)), "_i int, column_name string")
        return all_.join(counts, "_i", "left").select("column_name", F.coalesce("_n", F.lit(0)).alias("n_distinct"))
    counts = (df.agg(F.countDistinct(c).alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_distinct")
              for c in columns)
    return reduce(DataFrame.unionByName, counts)


DESCRIBED = ("n", "mean", "stddev", "min_value", "max_value", "min_text", "max_text")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n, mean, stddev, min_value, max_value, min_text, max_text) per column.

    Numeric columns fill the value fields, all others the text fields: their least and greatest value, compared in
    their own type. Numbers and the rest are two aggregations, since least texts keep an aggregation from being
    compiled to one loop.
    """
    columns = list(columns or df.columns)
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    others = [c for c in columns if c not in numeric]
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    parts = []
    if numeric:
        aggs = []
        for c in numeric:
            x = F.col(c).cast("double")
            fields = {"n": F.count(c), "mean": F.avg(x), "stddev": F.stddev(x), "min_value": F.min(x), "max_value": F.max(x)}
            aggs += [value.alias(f"{c}__{field}") for field, value in fields.items()]
        one_row = df.agg(*aggs).withColumns({f"{c}__{end}_text": no_text for c in numeric for end in ("min", "max")})
        parts.append(_rows(one_row, numeric, DESCRIBED))
    if others:
        aggs = [F.count(c).alias(f"{c}__n") for c in others]
        aggs += [f(c).cast("string").alias(f"{c}__{end}_text") for c in others for end, f in (("min", F.min), ("max", F.max))]
        numbers = DESCRIBED[1:5]
        one_row = df.agg(*aggs).withColumns({f"{c}__{field}": no_number for c in others for field in numbers})
        parts.append(_rows(one_row, others, DESCRIBED))
    return reduce(DataFrame.unionByName, parts)


def global_mean(df: DataFrame, c: str, out: str = "mean") -> DataFrame:
    return df.agg(F.avg(c).alias(out))


def clean_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to int, bad values to NULL."""
    return df.withColumns({c: clean_int(c) for c in columns})


def present(df: DataFrame, c: str) -> Column:
    """The column with NaN as NULL."""
    return F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) if _is_floating(df, c) else F.col(c)


def imputation_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of each column's present values."""
    return df.agg(*(F.avg(present(df, c)).alias(c) for c in columns))


def impute(
    df: DataFrame,
    zero: Sequence[str] = (),
    mean: Sequence[str] = (),
    means: DataFrame | None = None,
) -> DataFrame:
    """Fill gaps with 0 or with column means.

    The means are those of ``df``, or the row ``means`` (``imputation_means`` of the training
    rows). They enter the plan as one scalar subquery, so nothing is fetched to the driver. A mean
    put into an int column loses its fraction.
    """
    filled = {c: F.coalesce(present(df, c), F.lit(0).cast(df.schema[c].dataType)) for c in zero}
    if mean:
        means = imputation_means(df, mean) if means is None else means
        row = means.select(F.struct(*mean).alias("s")).scalar()
        for c in mean:
            filled[c] = F.coalesce(present(df, c), row.getField(c).cast(df.schema[c].dataType))
    return df.withColumns(filled)
