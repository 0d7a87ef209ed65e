"""Table readers and small reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racecast.functions import clean_float, clean_int
from racecast.sources.csv_files import read_csv
from racecast.sources.schemas import NULL_TEXT, SCHEMAS


def _cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(source, T.StringType) and isinstance(target, T.IntegerType):
        return clean_int(c)
    if isinstance(source, T.StringType) and isinstance(target, T.DoubleType):
        return clean_float(c)
    return c.try_cast(target)


def _typed(raw: DataFrame, name: str) -> DataFrame:
    """Known columns in their type (bad values NULL), further columns as they are."""
    present = {f.name.lower(): f for f in raw.schema}
    absent = [f.name for f in SCHEMAS[name] if f.name.lower() not in present]
    if absent:
        raise ValueError(f"table {name} lacks the columns {absent}")
    known = []
    for field in SCHEMAS[name]:
        found = present.pop(field.name.lower())
        known.append(_cast(F.col(f"`{found.name}`"), found.dataType, field.dataType).alias(field.name))
    return raw.select(*known, *(F.col(f"`{f.name}`") for f in present.values()))


def load_table(spark: SparkSession, base_dir: str, name: str, fmt: str = "csv", infer: bool = False) -> DataFrame:
    """One of the nine race tables from ``base_dir``, matched by column name.

    With ``infer`` every column of a CSV table has the type found in its rows, else the library's columns have
    the types they are known to have and further columns stay text.
    """
    if infer and fmt == "csv":
        found = read_csv(spark, f"{base_dir.rstrip('/')}/{name}.csv").plain
        names = {f.lower(): f for f in found.columns}
        return found.withColumnsRenamed({names[f.name.lower()]: f.name for f in SCHEMAS[name] if f.name.lower() in names})
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", NULL_TEXT)
    return _typed(reader.load(f"{base_dir.rstrip('/')}/{name}.{fmt}"), name)


def load_all(spark: SparkSession, base_dir: str, fmt: str = "csv", infer: bool = False) -> dict[str, DataFrame]:
    return {name: load_table(spark, base_dir, name, fmt, infer) for name in SCHEMAS}


def preview(df: DataFrame, n: int = 5, by: str | None = None) -> DataFrame:
    """The first n rows, in the order of ``by`` if given."""
    return (df.orderBy(by) if by else df).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) of a table; reads no data."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
