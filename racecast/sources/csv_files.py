"""CSV files whose types are found in the data, and of which no field is lost silently.

Types come from one aggregation over all rows: per column, how many values each type can hold. The tightest
type that holds all of them (or all but a share ``tolerance``) is taken. A value its column's type cannot hold becomes
NULL, and a row with too many or too few fields keeps the fields that it has; both are kept as text
in the column ``_rescued``, from which ``damage`` counts them per file and column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racecast.sources.schemas import NULL_TEXT

RESCUED, LINE, FILE = "_rescued", "_line", "_file"

# Types from the tightest on: a pattern that is tested before the cast, since a failing cast costs twenty times as much.
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
CANDIDATES: dict[str, tuple[str, T.DataType]] = {
    "boolean": ("^(?i:true|false)$", T.BooleanType()),
    "int": ("^[+-]?[0-9]{1,11}$", T.IntegerType()),
    "bigint": ("^[+-]?[0-9]{1,20}$", T.LongType()),
    "double": (NUMBER, T.DoubleType()),
    "date": ("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", T.DateType()),
    "timestamp": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?(?:Z|[+-][0-9]{2}:[0-9]{2})?$", T.TimestampType()),
}
BY_TYPE = {type(kind): (pattern, kind) for pattern, kind in CANDIDATES.values()}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parsed(text: Column, kind: T.DataType) -> Column:
    """The value of a text in a type, NULL where it has none."""
    if isinstance(kind, T.StringType):
        return text
    if type(kind) not in BY_TYPE:
        return text.try_cast(kind)
    pattern, _ = BY_TYPE[type(kind)]
    return F.when(text.rlike(pattern), text.try_cast(kind))


def type_counts(texts: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column_name, n, and for each type the values it can hold) of text columns, in one pass."""
    # As SQL text: as many small Column calls would take the driver seconds for a wide table.
    structs = []
    for i, c in enumerate(columns or texts.columns):
        name = _quoted(c)
        holds = ", ".join(
            f"count(if({name} RLIKE r'{pattern}', try_cast({name} AS {kind.simpleString()}), NULL)) AS n_{of}"
            for of, (pattern, kind) in CANDIDATES.items()
        )
        structs.append(f"struct({i} AS position, {_literal(c)} AS column_name, count({name}) AS n, {holds})")
    return texts.agg(F.expr(f"array({', '.join(structs)})").alias("rows")).select(F.inline("rows"))


def found_types(texts: DataFrame, columns: Sequence[str] | None = None, tolerance: float = 0.0) -> DataFrame:
    """(position, column_name, data_type): the tightest type of each text column; text where there is no value."""
    holds = (
        F.when((F.col("n") > 0) & (F.col(f"n_{name}") >= (1 - tolerance) * F.col("n")), name) for name in CANDIDATES
    )
    return type_counts(texts, columns).select("position", "column_name", F.coalesce(*holds, F.lit("string")).alias("data_type"))


def infer(texts: DataFrame, tolerance: float = 0.0) -> T.StructType:
    """The types found, as a schema. Runs a job over all rows; a row for each column comes back."""
    kinds = {name: kind for name, (_, kind) in CANDIDATES.items()}
    rows = sorted(found_types(texts, None, tolerance).collect())
    return T.StructType([T.StructField(name, kinds.get(kind, T.StringType())) for _, name, kind in rows])


@dataclass(frozen=True)
class CsvTable:
    """``rows`` in ``types``, with ``_rescued`` (a map from column to text, NULL for a sound row) and ``_file``."""

    rows: DataFrame
    types: T.StructType

    @property
    def plain(self) -> DataFrame:
        return self.rows.drop(RESCUED, FILE)

    def damage(self) -> DataFrame:
        """(file, column_name, n): values not of their column's type, and ``_line`` for rows of a wrong length."""
        names = self.rows.select(F.col(FILE).alias("file"), F.explode(F.map_keys(RESCUED)).alias("column_name"))
        return names.groupBy("file", "column_name").agg(F.count(F.lit(1)).alias("n"))


def _texts(spark: SparkSession, path: str, names: Sequence[str], header: bool, null_text: str) -> DataFrame:
    """All fields as text, the whole line of rows of a wrong length, and the file."""
    schema = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField(LINE, T.StringType())])
    reader = spark.read.schema(schema).option("header", header).option("nullValue", null_text)
    # A file whose header differs from the others' is an error, not a shift of columns.
    reader = reader.option("enforceSchema", not header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    # With pruning a row is only as long as the columns that a query asks for, so its length would not be tested.
    reader = reader.option("columnPruning", False)
    return reader.csv(path).withColumn(FILE, F.col("_metadata.file_path"))


def read_csv(
    spark: SparkSession,
    path: str,
    types: T.StructType | None = None,
    header: bool = True,
    null_text: str = NULL_TEXT,
    tolerance: float = 0.0,
) -> CsvTable:
    """A CSV file, or folder of such files, in given types or in those found in all of its rows.

    Without a header the names come from ``types``, which must then be given. ``types`` need not be of all columns:
    the others' are found. An empty field and ``null_text`` are NULL.
    """
    if header:
        names = spark.read.option("header", True).csv(path).columns
    elif types is None:
        raise ValueError("a CSV file without header needs the names and types of its columns")
    else:
        names = types.names
    texts = _texts(spark, path, names, header, null_text)
    known = {} if types is None else {f.name.lower(): f.dataType for f in types}
    open_ = [n for n in names if n.lower() not in known]
    if open_:
        known |= {f.name.lower(): f.dataType for f in infer(texts.select(*map(_quoted, open_)), tolerance)}
    schema = T.StructType([T.StructField(n, known[n.lower()]) for n in names])
    values = {n: parsed(F.col(_quoted(n)), known[n.lower()]) for n in names}
    lost = [
        F.struct(F.lit(n).alias("key"), F.when(values[n].isNull(), F.col(_quoted(n))).alias("value"))
        for n in names
        if not isinstance(known[n.lower()], T.StringType)
    ]
    # Never true, but it names a column of the file: Spark reads the whole line only together with one.
    first = F.col(_quoted(names[0]))
    line = F.coalesce(F.col(LINE), F.when(F.char_length(first) < 0, first))
    lost.append(F.struct(F.lit(LINE).alias("key"), line.alias("value")))
    kept = F.filter(F.array(*lost), lambda x: x["value"].isNotNull())
    rescued = F.when(F.size(kept) > 0, F.map_from_entries(kept))
    rows = texts.select(*(values[n].alias(n) for n in names), rescued.alias(RESCUED), FILE)
    return CsvTable(rows, schema)
