"""Reading, cleaning, joining and exploring a hand-made data set."""

import datetime as dt

import pytest
import raceset
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from racecast.operators.dataset import base_table
from racecast.plans import race, stand_in
from racecast.session import intermediates, shared_folder
from racecast.sources import load_all, load_table, preview, schema_report

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return load_all(spark, raceset.write(tmp_path_factory.mktemp("races")))


@pytest.fixture(scope="module")
def clean(tables):
    return race.clean_tables(tables)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_load(tables):
    races = tables["races"]
    assert races.columns[:3] == ["raceId", "year", "name"] and "round" in races.columns
    assert races.schema["date"].dataType.simpleString() == "date"
    assert rows(races, "raceId", "time")[2] == (3, None)
    assert tables["results"].filter("milliseconds is null").count() == 2
    assert set(tables) == set(raceset.CSV)


def test_missing_column(spark, tmp_path):
    (tmp_path / "status.csv").write_text("statusId\n1\n")
    with pytest.raises(ValueError, match="status"):
        load_table(spark, str(tmp_path), "status")


def test_parquet_source(spark, tables, tmp_path):
    tables["races"].write.parquet(str(tmp_path / "races.parquet"))
    assert rows(load_table(spark, str(tmp_path), "races", "parquet"), "raceId") == [(1,), (2,), (3,)]


def test_preview_and_schema(tables):
    assert rows(preview(tables["status"], 2, "statusId"), "statusId") == [(1,), (2,)]
    assert rows(schema_report(tables["status"]), "position", "column_name", "data_type") == [
        (0, "statusId", "int"), (1, "status", "string"),
    ]


def test_drivers(tables, clean):
    got = rows(clean["drivers"], "driverId", "age", "totalWins", "totalRaces", "winRate")
    assert got == [(1, 33, 2, 3, 0.667), (2, 33, 0, 2, 0.0), (3, None, 0, 1, 0.0), (5, 18, None, None, None)]
    names = race.named_drivers(tables["drivers"]).filter("driverId = 2").first()
    assert (names.driver_name, names.dob_date) == ("Bo Bee", dt.date(1985, 1, 7))


def test_dimensions(clean):
    assert "circuit_name" in clean["circuits"].columns and "lat" not in clean["circuits"].columns
    assert clean["constructors"].columns == [
        "constructorId", "constructorRef", "constructor_name", "constructor_nationality",
    ]
    assert rows(clean["constructorResults"], "points") == [(0.0,), (14.5,)]


@pytest.mark.parametrize("direct", [True, False])
def test_laps(tables, direct):
    laps = race.lap_features(tables["lapTimes"], direct)
    got = rows(laps, "raceId", "driverId", "avg_position_change", "max_position", "position_change_index")
    # (1,2): -1, 1, 2 -> 0.67 -> 1; index 1 * (1 - 1/4) -> 1. (1,1) never left the lead.
    assert got == [
        (1, 1, -1.0, 1, 1.0), (1, 2, 1.0, 5, 1.0), (1, 3, -1.0, 6, -1.0),
        (2, 1, -1.0, 3, -1.0), (2, 2, -1.0, 2, -0.0), (3, 1, -1.0, 1, 1.0),
    ]


def test_laps_with_unknown_position(tables):
    gap = tables["lapTimes"].withColumn("position", F.when(F.col("lap") != 2, F.col("position")))
    with pytest.raises(Exception, match="use position_change"):
        race.lap_features(gap, direct=True).collect()
    got = rows(race.lap_features(gap, direct=False), "raceId", "driverId", "avg_position_change")
    assert got[1] == (1, 2, -1.0)


def test_stops(clean):
    got = rows(
        clean["pitStops"], "raceId", "driverId", "total_pitStop_duration", "avg_pitStop_duration", "total_pitStops",
        "avg_laps_between_pitstops", "pitStop_efficiency",
    )
    # Two stops on one lap and stops without a duration have no efficiency and are dropped.
    assert got == [(1, 1, 44, 22.0, 2, 20.0, 1.1), (1, 2, 22, 22.0, 1, -1.0, -22.0), (1, 3, 21, 21.0, 1, -1.0, -21.0)]


def test_races(clean, tables):
    assert rows(clean["races"], "raceId", "season_name", "time_of_day") == [
        (1, "Spring", "Morning"), (2, "Winter", "Night"), (3, "Summer", None),
    ]
    strict = race.clean_races(tables["races"], strict_compat=True)
    assert rows(strict, "raceId", "time_of_day") == [(1, "Morning"), (2, None), (3, None)]


def test_results(clean):
    results = clean["results"]
    assert rows(results, "raceId", "driverId", "fastestLap", "rank") == [
        (1, 1, 5, 1), (1, 2, 0, 0), (1, 3, 5, 5), (2, 1, 7, 2), (2, 2, 9, 9), (3, 1, 5, 1),
    ]
    filled = results.filter("raceId = 1 and driverId = 2").first()
    assert filled.milliseconds == 25  # mean of 10, 21, 30, 40 is 25.25
    assert filled.fastestLapSpeed == pytest.approx((200.5 + 210.5 + 190 + 205 + 195) / 5)
    assert filled.avg_lap_time_seconds == pytest.approx((83.456 + 80 + 85 + 82 + 84) / 5)
    assert rows(results, "constructorId", "constructor_success") == [(1, 1)] * 3 + [(2, 0)] * 3
    assert rows(results.filter("driverId = 1"), "raceId", "driver_experience") == [(1, 1), (2, 2), (3, 3)]


def test_base_table(clean):
    base = race.race_base_table(clean)
    assert rows(base, "raceId", "driverId") == [(1, 1), (1, 2), (1, 3)]
    training = race.training_table(base)
    assert rows(training, "driverId", "status") == [(1, 1), (2, 0), (3, 1)]
    assert not {"statusId", "year", "date", "name", "constructorRef", "constructor_name"} & set(training.columns)


def test_every_exploration(tables):
    data = race.RaceData(tables, (2008, 2018))
    for topic in race.EXPLORATIONS:
        assert race.explore(data, topic).count() > 0, topic
    # The one engine failure has laps, but no stops.
    assert rows(race.explore(data, "failures_by_speed"), "fastestLapSpeed", "status", "n") == [(190.0, "Engine", 1)]
    assert rows(race.explore(data, "constructor_wins"), "constructor_name", "wins") == [("Ann", 2)]
    best = race.explore(data, "top_drivers").orderBy(F.desc_nulls_last("wins"), "driverId").collect()
    assert [(r.driverId, r.wins, r.points, r.driver_name) for r in best] == [
        (1, 1, 25.0, "Al Ace"), (2, None, 6.0, "Bo Bee"), (3, None, 4.0, "Cy Cee"),
    ]


def test_pre_race_features_and_prediction(spark):
    """Hand-computed: race 7 comes before race 3 by date; race 9 has not been run."""
    tables = {
        "races": spark.createDataFrame(
            [(7, "2018-03-04", "10:00:00"), (3, "2018-07-01", "22:30:00"), (9, "2018-12-02", None)],
            "raceId int, date string, time string",
        ).withColumns({"url": F.lit("u"), "year": F.lit(2018)}),
        "results": spark.createDataFrame(
            [(7, 1, 10, 1, 1), (7, 2, 10, 5, 2), (3, 1, 10, 2, 2), (3, 2, 11, 1, 1)],
            "raceId int, driverId int, constructorId int, positionOrder int, statusId int",
        ),
        "status": spark.createDataFrame([(1, "Finished"), (2, "Engine")], "statusId int, status string"),
        "drivers": spark.createDataFrame(
            [(1, "1990-05-01", "A", "B"), (2, "1985.01.07", "C", "D"), (3, "2000-01-01", "E", "F")],
            "driverId int, dob string, forename string, surname string",
        ),
    }
    entries = spark.createDataFrame([(9, 1, 10), (9, 2, 11), (9, 3, 12)], "raceId int, driverId int, constructorId int")
    columns = ["raceId", "driverId", "finished", *race.PRE_RACE_FEATURES]
    got = {(r.raceId, r.driverId): tuple(r)[2:] for r in race.pre_race_table(tables, entries).select(*columns).collect()}
    assert got == {
        (7, 1): (1, 0, 0.0, 0, 0.0, 28, "Spring", "Morning"),
        (7, 2): (0, 0, 0.0, 0, 0.0, None, "Spring", "Morning"),
        (3, 1): (0, 1, 1.0, 1, 1.0, 28, "Summer", "Night"),
        (3, 2): (1, 1, 0.0, 0, 0.0, None, "Summer", "Night"),
        (9, 1): (None, 2, 0.5, 2, 1.0, 28, "Winter", None),
        (9, 2): (None, 2, 0.5, 1, 1.0, None, "Winter", None),
        (9, 3): (None, 0, 0.0, 0, 0.0, 18, "Winter", None),
    }
    chances = race.predict_race(tables, entries, estimator=LogisticRegression(regParam=0.1)).collect()
    assert sorted(r.driverId for r in chances) == [1, 2, 3]
    assert all(0 <= r.finish_probability <= 1 for r in chances)


def test_base_table_reads_lines_and_results_once(spark):
    from racecast import session
    from racecast.plans import stand_in

    with session.intermediates():
        tables = stand_in.race_tables(spark, "/root/testdata/sf0.001", keep_lines=True)
        base = race.race_base_table(race.clean_tables(tables, lap_order=stand_in.LAP_ORDER))
        leaves = base._jdf.queryExecution().optimizedPlan().collectLeaves()
        columns = [leaves.apply(k).output().mkString(",") for k in range(leaves.size())]
    # What is left to scan has no column of the raw lines but through a kept table.
    raw = [c for c in columns if "l_orderkey" in c]
    assert not raw, raw


def test_results_laps_and_stops_are_joined_without_an_exchange(spark):
    """Kept by entry in the shared folder, the three meet in place: no exchange below their joins."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with intermediates():
            tables = stand_in.race_tables(spark, SF, keep_lines=True)
            clean = race.clean_tables(tables, lap_order=stand_in.LAP_ORDER)
            joins = [(clean["lapTimes"], race.ENTRY), (clean["pitStops"], race.ENTRY)]
            plan = base_table(clean["entries"], joins)._jdf.queryExecution().executedPlan().toString()
            kept = shared_folder(spark) is not None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("SortMergeJoin") == 2
    if kept:
        assert "Exchange hashpartitioning" not in plan


def test_base_table_is_the_join_of_the_cleaned_tables(spark):
    tables = stand_in.race_tables(spark, SF)
    clean = race.clean_tables(tables, lap_order=stand_in.LAP_ORDER)
    whole = {name: table for name, table in clean.items() if name not in ("entries", "experience", "success")}
    one, two = race.race_base_table(clean), race.race_base_table(race.Clean(whole))
    assert set(one.columns) == set(two.columns)
    names = sorted(one.columns)
    assert sorted(map(repr, one.select(names).collect())) == sorted(map(repr, two.select(names).collect()))
