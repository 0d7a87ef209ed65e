"""The nine race tables derived from an order database.

Orders play race entries (customer = driver, order date = race), their lines play laps, returned
lines play pit stops, suppliers play teams. It lets the whole race analysis run on test tables of
any size; the derivations are plain expressions, so nothing is generated on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racecast.session import materialise
from racecast.sources.schemas import NULL_TEXT

FIRST_DAY = "1995-01-01"
YEARS = (1996, 1998)
# Line numbers may repeat within an order; equal laps with equal positions are interchangeable.
LAP_ORDER = ("lap", "position")

# Statuses of the derived entries.
STATUSES = (
    "Finished", "Engine", "Spun-off", "Collision", "Gearbox-off", "Accident", "Hydraulics", "Suspension",
    "Brakes", "Clutch", "+1 Lap", "Retired",
)


def _race_id() -> Column:
    return F.date_diff(F.to_date("o_orderdate"), F.lit(FIRST_DAY).cast("date"))


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _races(orders: DataFrame) -> DataFrame:
    days = orders.select(F.to_date("o_orderdate").alias("date"), _race_id().alias("raceId")).distinct()
    hour = F.concat(_two(F.col("raceId") * 7 % 24), F.lit(":30:00"))
    return days.select(
        "raceId",
        F.year("date").alias("year"),
        F.concat(F.lit("Meeting "), _two(F.month("date"))).alias("name"),
        "date",
        F.when(F.col("raceId") % 11 != 3, hour).otherwise(NULL_TEXT).alias("time"),
        F.concat(F.lit("r"), F.col("raceId").cast("string")).alias("url"),
    )


def _drivers(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (key * 37 % 12_000).cast("int"))
    text = F.when(key % 3 == 0, F.date_format(born, "dd/MM/yyyy")).otherwise(F.date_format(born, "yyyy-MM-dd"))
    return customer.select(
        key.alias("driverId"),
        F.when(key % 97 != 5, text).alias("dob"),
        F.col("c_mktsegment").alias("forename"),
        F.col("c_name").alias("surname"),
    )


def _constructors(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("constructorId"),
        F.lower("s_name").alias("constructorRef"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("nationality"),
    )


def _results(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("constructorId"), F.count(F.lit(1)).cast("int").alias("laps")
    )
    key = F.col("o_orderkey")
    place = (1 + key * 7 % 24).cast("int")
    failed = F.when(F.col("o_orderstatus") == "O", 2 + key % 9).otherwise(11 + key % 2)

    def text(value: Column, gap: int) -> Column:
        return F.when(key % gap != 0, value.cast("string")).otherwise(NULL_TEXT)

    lap_time = F.concat(F.lit("1:"), _two(10 + key % 50), F.lit("."), F.lpad((key % 1000).cast("string"), 3, "0"))
    return orders.join(per_order, key == F.col("l_orderkey")).select(
        _race_id().alias("raceId"),
        F.col("o_custkey").alias("driverId"),
        "constructorId",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(failed).cast("int").alias("statusId"),
        place.alias("positionOrder"),
        place.cast("string").alias("position"),
        place.cast("string").alias("positionText"),
        F.greatest(F.lit(0), 26 - 2 * place).cast("double").alias("points"),
        "laps",
        F.lit("+1").alias("time"),
        text(5_000_000 + key * 13 % 900_000, 7).alias("milliseconds"),
        text(1 + key % 60, 5).alias("fastestLap"),
        text(1 + key % 22, 6).alias("rank"),
        text(lap_time, 5).alias("fastestLapTime"),
        F.when(key % 5 != 0, 140 + key % 120).cast("double").alias("fastestLapSpeed"),
    )


def _lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns(
        {"raceId": _race_id(), "driverId": F.col("o_custkey"), "lap": F.col("l_linenumber")}
    )


def _laps(lines: DataFrame) -> DataFrame:
    return lines.select(
        "raceId",
        "driverId",
        "lap",
        (1 + F.col("l_partkey") % 20).cast("int").alias("position"),
        (80_000 + F.col("l_partkey") % 9_000).cast("int").alias("milliseconds"),
    )


def _stops(lines: DataFrame) -> DataFrame:
    seconds = F.concat((20 + F.col("l_quantity")).cast("int").cast("string"), F.lit(".718"))
    return lines.filter(F.col("l_returnflag") == "R").select(
        "raceId",
        "driverId",
        "lap",
        F.when(F.col("l_partkey") % 40 != 0, seconds).otherwise("16:44.718").alias("duration"),
    )


def race_tables(spark: SparkSession, folder: str, keep_lines: bool = False) -> dict[str, DataFrame]:
    """The nine tables over the parquet files in ``folder``.

    ``keep_lines`` materialises the join of orders and lines by entry, for analyses that read both laps and stops.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    orders, lineitem = read("orders"), read("lineitem")
    lines = _lines(orders, lineitem)
    if keep_lines:
        lines = materialise(
            lines.select("raceId", "driverId", "lap", "l_partkey", "l_quantity", "l_returnflag"), ["raceId", "driverId"]
        )
    return {
        "circuits": read("region").select(
            F.col("r_name").alias("name"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng")
        ),
        "constructorResults": orders.select((F.col("o_orderkey") % 44).alias("points")),
        "constructors": _constructors(read("supplier"), read("nation")),
        "drivers": _drivers(read("customer")),
        "lapTimes": _laps(lines),
        "pitStops": _stops(lines),
        "races": _races(orders),
        "results": _results(orders, lineitem),
        "status": spark.createDataFrame(list(enumerate(STATUSES, start=1)), "statusId int, status string"),
    }
