"""Hand-made rows with hand-computed answers."""

import datetime as dt

from pyspark.sql import functions as F

from racecast import functions as R


def values(spark, ddl, rows, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in rows], f"x {ddl}").select(expr).collect()]


def test_mixed_dates(spark):
    day = dt.date(1985, 1, 7)
    got = values(spark, "string", ["1985-01-07", "07/01/1985", "1985.01.07", None, "1985-13-40"], R.parse_mixed_date("x"))
    assert got == [day, day, None, None, None]


def test_clean_int(spark):
    rows = ["26.898", "16:44.718", "\\N", " 7 ", "-3", "99999999999", "1e3", "", None, ".5", "-.5", "."]
    assert values(spark, "string", rows, R.clean_int("x")) == [26, None, None, 7, -3, None, None, None, None, 0, 0, None]


def test_lap_time(spark):
    got = values(spark, "string", ["1:23.456", "\\N", "83.456", "a:1.0", None], R.lap_time_ms("x"))
    assert got == [83456.0, None, None, None, None]


def test_season(spark):
    rows = [dt.date(2018, m, 15) for m in range(1, 13)] + [None]
    got = values(spark, "date", rows, R.season_of("x"))
    winter, spring, summer, fall = "Winter", "Spring", "Summer", "Fall"
    assert got == [winter] * 2 + [spring] * 3 + [summer] * 3 + [fall] * 3 + [winter, "Unknown"]


def test_time_band(spark):
    rows = ["06:00:00", "11:59:59", "14:00:00", "18:30:00", "22:00:00", "03:00:00", "\\N", None]
    day = ["Morning", "Morning", "Afternoon", "Evening"]
    assert values(spark, "string", rows, R.time_band("x")) == day + ["Night", "Night", None, None]
    assert values(spark, "string", rows, R.time_band("x", strict_compat=True)) == day + [None] * 4


def test_position_group(spark):
    got = values(spark, "int", [1, 3, 4, 10, 11, None], R.position_group("x"))
    assert got == ["Top 3", "Top 3", "Top 10", "Top 10", "Outside Top 10", "Outside Top 10"]


def test_frequency_label(spark):
    got = values(spark, "int", [1, 2, 3, None], R.frequency_label("x"))
    assert [g.split()[0] for g in got] == ["Low", "Low", "High", "Normal"]


def test_full_name_and_flag(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B")], "a string, b string")
    assert [r[0] for r in df.select(R.full_name("a", "b")).collect()] == ["A B", None]
    assert values(spark, "int", [1, 2, None], R.flag(F.col("x") == 1)) == [1, 0, 0]
