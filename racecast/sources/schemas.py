"""Columns the library uses, with their types on reading."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType()}


def _schema(columns: str) -> T.StructType:
    """Schema from 'name type, name type'; unlike ``fromDDL`` it needs no running session."""
    fields = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


# Table and column names of the race data set.
SCHEMAS: dict[str, T.StructType] = {
    "circuits": _schema("name string, lat double, lng double"),
    "constructorResults": _schema("points double"),
    "constructors": _schema("constructorId int, constructorRef string, name string, nationality string"),
    "drivers": _schema("driverId int, dob string, forename string, surname string"),
    "lapTimes": _schema("raceId int, driverId int, lap int, position int, milliseconds int"),
    "pitStops": _schema("raceId int, driverId int, lap int, duration string"),
    "races": _schema("raceId int, year int, name string, date date, time string, url string"),
    "results": _schema(
        "raceId int, driverId int, constructorId int, statusId int, positionOrder int, position string, "
        "positionText string, points double, laps int, time string, milliseconds string, fastestLap string, "
        "rank string, fastestLapTime string, fastestLapSpeed double"
    ),
    "status": _schema("statusId int, status string"),
}

# Fixed value: the text that stands for a missing value in the CSV files.
NULL_TEXT = "\\N"
