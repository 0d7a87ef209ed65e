"""The race analysis: nine raw tables to base table, exploration tables and finish models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.functions import (
    clean_int,
    flag,
    full_name,
    lap_time_ms,
    parse_mixed_date,
    position_group,
    season_of,
    time_band,
)
from racecast.models.training import compare_models, fit_models, predict_event
from racecast.operators.dataset import base_table, binary_label, clean_dimension, split_by_hash
from racecast.operators.explore import (
    Bootstrap,
    box_stats,
    correlation,
    density_grid,
    histogram,
    mean_by,
    pair_counts,
    ranked,
    top_k,
    value_counts,
    wins_and_points,
    wins_by,
)
from racecast.operators.features import (
    age_in_year,
    driver_profile,
    experience,
    group_success,
    labelled_stops,
    position_change,
    position_change_index,
    position_summary,
    position_summary_direct,
    stop_summary,
    win_rate,
    win_rate_as_of,
)
from racecast.operators.ordered import running_counts
from racecast.operators.quality import clean_numeric, imputation_means, impute
from racecast.session import materialise
from racecast.sources import schema_report

ENTRY = ["raceId", "driverId"]
LAP_ORDER = ("lap",)
Tables = dict[str, DataFrame]


class Clean(dict):
    """Cleaned tables by name; a table given as a function is built when it is first asked for."""

    def __getitem__(self, name: str) -> DataFrame:
        value = super().__getitem__(name)
        if callable(value) and not isinstance(value, DataFrame):
            value = self[name] = value()
        return value



# Names of derived columns, statuses, and column lists of the data set.
STOP_NAMES = {
    "total_stop_duration": "total_pitStop_duration",
    "avg_stop_duration": "avg_pitStop_duration",
    "total_stops": "total_pitStops",
    "avg_laps_between_stops": "avg_laps_between_pitstops",
    "stop_efficiency": "pitStop_efficiency",
}
WIN_NAMES = {"total_wins": "totalWins", "total_races": "totalRaces", "win_rate": "winRate"}
FINISHED = "Finished"
FAILURES = (
    "Engine", "Spun-off", "Collision", "Gearbox-off", "Accident", "Hydraulics", "Suspension", "Brakes", "Clutch",
)
ZERO_FILLED = ("fastestLap", "rank")
MEAN_FILLED = ("milliseconds", "fastestLapSpeed", "avg_lap_time_seconds")
CATEGORIES = (
    "position_group", "season_name", "time_of_day", "constructor_nationality", "pitStopFrequencyLabel",
)
NOT_FOR_TRAINING = ("statusId", "year", "date", "constructorRef", "name", "constructor_name")
FEATURES = (
    "positionOrder", "points", "laps", "milliseconds", "fastestLap", "rank", "fastestLapSpeed",
    "avg_lap_time_seconds", "driver_experience", "constructor_success", "age", "totalWins", "totalRaces",
    "winRate", "avg_position_change", "max_position", "position_change_index", "total_pitStop_duration",
    "avg_pitStop_duration", "total_pitStops", "avg_laps_between_pitstops", "pitStop_efficiency",
)
TOP_FEATURES = (
    "raceId", "winRate", "avg_pitStop_duration", "laps", "avg_lap_time_seconds", "fastestLapSpeed", "points",
    "age", "max_position", "avg_laps_between_pitstops", "total_pitStop_duration", "season_name",
)
YEARS = (2008, 2018)
TOP_DRIVERS, TOP_STATUSES = 10, 20


def clean_circuits(circuits: DataFrame) -> DataFrame:
    return clean_dimension(circuits, {"name": "circuit_name"}, ["lat", "lng"])


def clean_constructors(constructors: DataFrame) -> DataFrame:
    return clean_dimension(
        constructors, {"name": "constructor_name", "nationality": "constructor_nationality"}
    )


def clean_constructor_results(rows: DataFrame) -> DataFrame:
    return rows.withColumn("points", F.col("points").cast("double"))


def named_drivers(drivers: DataFrame) -> DataFrame:
    """Drivers with a known date-of-birth text: driver_name and dob_date added."""
    known = drivers.na.drop(subset=["dob"])
    return known.withColumns(
        {"driver_name": full_name("forename", "surname"), "dob_date": parse_mixed_date("dob")}
    )


def driver_features(drivers: DataFrame, results: DataFrame) -> DataFrame:
    """driverId, age, totalWins, totalRaces, winRate."""
    ages = age_in_year(named_drivers(drivers), "driverId", "dob_date")
    wins = win_rate(results, "driverId", "raceId", F.col("positionOrder") == 1)
    return driver_profile(ages, wins, "driverId").withColumnsRenamed(WIN_NAMES)


def lap_features(laps: DataFrame, direct: bool = False, order: Sequence[str] = LAP_ORDER) -> DataFrame:
    """raceId, driverId, avg_position_change, max_position, position_change_index.

    ``order`` must be unique within an entry. ``direct`` needs no sort, but stops at a position that
    is NULL.
    """
    if direct:
        summary = position_summary_direct(laps, ENTRY, order, "position")
    else:
        changes = position_change(laps, ENTRY, order, "position")
        summary = position_summary(changes, ENTRY, "position_change", "position")
    return summary.withColumn("position_change_index", position_change_index())


def stop_features(stops: DataFrame) -> DataFrame:
    """One complete row per entry with stops: durations, number, gaps, efficiency, label."""
    seconds = stops.withColumn("pitStop_duration", clean_int("duration"))
    summary = stop_summary(seconds, ENTRY, "pitStop_duration", "lap")
    return labelled_stops(summary, out="pitStopFrequencyLabel").withColumnsRenamed(STOP_NAMES)


def clean_races(races: DataFrame, strict_compat: bool = False) -> DataFrame:
    labelled = races.withColumns(
        {"season_name": season_of("date"), "time_of_day": time_band("time", strict_compat)}
    )
    return labelled.drop("time", "url")


def typed_results(results: DataFrame) -> DataFrame:
    """Results with numeric columns; gaps are still open."""
    typed = clean_numeric(results.drop("time", "position", "positionText"), ["milliseconds", *ZERO_FILLED])
    return typed.withColumn("avg_lap_time_seconds", lap_time_ms("fastestLapTime") / 1_000).drop("fastestLapTime")


def clean_results(results: DataFrame, fill_means: bool = True, history: bool = True) -> DataFrame:
    """Results with filled gaps, position group, driver experience and team success.

    ``fill_means=False`` leaves the mean-filled columns open, to be filled later from training rows.
    ``history=False`` omits experience and success, which need a shuffle, for reports without them.
    """
    return _filled_results(typed_results(results), fill_means, history)


def _filled_results(typed: DataFrame, fill_means: bool, history: bool) -> DataFrame:
    filled = impute(typed, zero=ZERO_FILLED, mean=MEAN_FILLED if fill_means else ())
    grouped = filled.withColumn("position_group", position_group("positionOrder"))
    if not history:
        return grouped
    known = experience(grouped, "driverId", "raceId", "driver_experience")
    return group_success(known, "constructorId", "positionOrder", 3, "constructor_success")


def clean_tables(
    tables: Tables,
    fill_means: bool = True,
    strict_compat: bool = False,
    history: bool = True,
    lap_order: Sequence[str] = LAP_ORDER,
) -> Tables:
    """The cleaned tables with their derived features, by the raw tables' names.

    With ``history`` the typed results have five readers (means, win rates, experience, team success, the rows
    themselves), so they are materialised, dealt out by entry. "entries", "experience" and "success" are the parts of
    "results": the filled rows, and what is known per driver and race, and per team.
    """
    typed = typed_results(tables["results"])
    parts = {}
    if history:
        typed = materialise(typed, ENTRY)
        parts = {
            "entries": _filled_results(typed, fill_means, False),
            "experience": lambda: running_counts(typed, ["driverId"], "raceId", "driver_experience"),
            "success": typed.groupBy("constructorId").agg(
                F.max(flag(F.col("positionOrder") <= 3)).alias("constructor_success")
            ),
        }
    return Clean(parts | {
        "circuits": clean_circuits(tables["circuits"]),
        "constructorResults": clean_constructor_results(tables["constructorResults"]),
        "constructors": clean_constructors(tables["constructors"]),
        "drivers": driver_features(tables["drivers"], typed),
        "lapTimes": lap_features(tables["lapTimes"], order=lap_order),
        "pitStops": stop_features(tables["pitStops"]),
        "races": clean_races(tables["races"], strict_compat),
        "results": lambda: _filled_results(typed, fill_means, history),
        "status": tables["status"],
    })


def results_with_drivers(clean: Tables) -> DataFrame:
    return base_table(clean["results"], [(clean["races"], "raceId"), (clean["drivers"], "driverId")])


def results_with_constructors(clean: Tables) -> DataFrame:
    return base_table(results_with_drivers(clean), [(clean["constructors"], "constructorId")])


def results_with_laps(clean: Tables) -> DataFrame:
    """All tables but pit stops."""
    return base_table(
        results_with_constructors(clean), [(clean["status"], "statusId"), (clean["lapTimes"], ENTRY)]
    )


def race_base_table(clean: Tables) -> DataFrame:
    """One row per result whose entry has both laps and stops.

    Results, laps and stops are joined first: where all three are kept dealt out by entry, without an exchange. What
    is left of them then meets the histories and the tables of drivers, races and teams.
    """
    if "entries" not in clean:
        return base_table(results_with_laps(clean), [(clean["pitStops"], ENTRY)])
    entries = base_table(clean["entries"], [(clean["lapTimes"], ENTRY), (clean["pitStops"], ENTRY)])
    others = [
        (clean["experience"], ["driverId", "raceId"]), (clean["success"], "constructorId"), (clean["races"], "raceId"),
        (clean["drivers"], "driverId"), (clean["constructors"], "constructorId"), (clean["status"], "statusId"),
    ]
    return base_table(entries, others)


def training_table(base: DataFrame) -> DataFrame:
    """Base table with status as 1 (finished) or 0 and without the columns not used in training."""
    return base.withColumn("status", binary_label("status", FINISHED)).drop(*NOT_FOR_TRAINING)


@dataclass
class RaceData:
    """The raw tables with the joined tables the reports start from, each built when first used.

    ``interval`` and ``bootstrap`` say how the reports of means give their intervals.
    """

    tables: Tables
    years: tuple[int, int] = YEARS
    lap_order: Sequence[str] = LAP_ORDER
    interval: str = "normal"
    bootstrap: Bootstrap = Bootstrap(tuple(ENTRY))

    def means(self, rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
        """``mean_by`` with the intervals asked for; rows of a bootstrap are told apart by their entry."""
        return mean_by(rows, keys, value, self.interval, self.bootstrap)

    @cached_property
    def clean(self) -> Tables:
        return clean_tables(self.tables, history=False, lap_order=self.lap_order)

    @cached_property
    def with_drivers(self) -> DataFrame:
        return results_with_drivers(self.clean)

    @cached_property
    def with_teams(self) -> DataFrame:
        return results_with_constructors(self.clean)

    @cached_property
    def with_laps(self) -> DataFrame:
        return results_with_laps(self.clean)

    @cached_property
    def base(self) -> DataFrame:
        return race_base_table(self.clean)


def _won() -> Column:
    return F.col("positionOrder") == 1


def top_drivers(data: RaceData) -> DataFrame:
    """The drivers with most wins in the given years, with points and name."""
    rows = data.base.filter(F.col("year").between(*data.years))
    best = top_k(wins_and_points(rows, "driverId", _won(), "points"), "wins", TOP_DRIVERS, "driverId")
    return best.join(named_drivers(data.tables["drivers"]).select("driverId", "driver_name"), "driverId", "left")


def constructor_wins(data: RaceData) -> DataFrame:
    wins = wins_by(data.with_teams, "constructorId", _won(), "constructor_name")
    return ranked(wins, "wins", "constructorId")


def rank_by_experience(data: RaceData) -> DataFrame:
    known = experience(data.clean["results"], "driverId", "raceId", "driver_experience")
    return data.means(results_with_drivers(Clean(data.clean, results=known)), ["driver_experience"], "rank")


def failures_by_speed(data: RaceData, failures: Sequence[str] = FAILURES) -> DataFrame:
    """Rows per fastest-lap speed and status, for statuses that mean a failure."""
    failed = data.with_laps.filter(F.col("status").isin(*failures))
    return value_counts(failed, ["fastestLapSpeed", "status"])


# The exploration tables by topic. Each is the data of one chart.
EXPLORATIONS: dict[str, Callable[[RaceData], DataFrame]] = {
    "races_per_year": lambda d: histogram(d.clean["races"], "year"),
    "races_per_year_density": lambda d: density_grid(d.clean["races"], "year"),
    "top_drivers": top_drivers,
    "constructor_wins": constructor_wins,
    "position_groups": lambda d: value_counts(d.clean["results"], "position_group").orderBy("position_group"),
    "races_vs_wins": lambda d: pair_counts(d.with_drivers, "totalRaces", "totalWins"),
    "races_wins_correlation": lambda d: correlation(d.with_drivers, "totalRaces", "totalWins"),
    "win_rates": lambda d: histogram(d.with_drivers, "winRate"),
    "win_rates_density": lambda d: density_grid(d.with_drivers, "winRate"),
    "rank_by_experience": rank_by_experience,
    "wins_by_race_and_season": lambda d: d.means(d.with_laps, ["name", "season_name"], "totalWins"),
    "lap_seconds_by_season": lambda d: box_stats(d.with_laps, "season_name", "avg_lap_time_seconds"),
    "position_change_by_season": lambda d: box_stats(d.with_laps, "season_name", "avg_position_change"),
    "stops_by_season": lambda d: d.means(d.base, ["season_name"], "total_pitStops"),
    "stops_by_season_and_time": lambda d: d.means(
        d.base.filter(F.col("time_of_day").isNotNull()), ["season_name", "time_of_day"], "total_pitStops"
    ),
    "stop_duration_by_season": lambda d: box_stats(d.base, "season_name", "avg_pitStop_duration"),
    "top_statuses": lambda d: top_k(value_counts(d.with_laps, "status"), "n", TOP_STATUSES, "status"),
    "failures_by_speed": failures_by_speed,
    "speed_by_position": lambda d: d.means(d.with_laps, ["positionOrder"], "fastestLapSpeed"),
    "duration_vs_efficiency": lambda d: pair_counts(d.base, "avg_pitStop_duration", "pitStop_efficiency"),
    "efficiency_by_wins": lambda d: d.means(d.base, ["totalWins"], "pitStop_efficiency"),
    "change_by_stop_duration": lambda d: d.means(d.base, ["avg_pitStop_duration"], "position_change_index"),
    "joined_columns": lambda d: schema_report(d.with_laps),
}


def explore(data: RaceData, topic: str) -> DataFrame:
    return EXPLORATIONS[topic](data)


def finish_models(
    base: DataFrame,
    features: Sequence[str] = FEATURES + CATEGORIES,
    estimators: dict[str, Estimator] | None = None,
    ratio: float = 0.7,
    seed: int = 123,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """(models, report) for "will this driver finish?", from a base table with open means.

    Split by entry, gaps (also of ages, where a date of birth cannot be read) filled from the training rows,
    encoders fitted on the training rows. Entries without one of the categories are left out. Only the columns used are
    kept, so that what the others of the base table need is not computed.
    """
    categories = [c for c in features if c in CATEGORIES]
    means = [c for c in (*MEAN_FILLED, "age") if c in features]
    used = dict.fromkeys([*ENTRY, "status", *features])
    rows = materialise(training_table(base).na.drop("any", subset=categories).select(*used))
    train, test = split_by_hash(rows, ENTRY, ratio, seed)
    if means:
        of_train = imputation_means(train, means)
        train, test = impute(train, mean=means, means=of_train), impute(test, mean=means, means=of_train)
    models = fit_models(train, "status", features, categories, estimators)
    return models, compare_models(models, train, test)


PRE_RACE_FEATURES = (
    "driver_experience", "driver_win_rate", "constructor_experience", "constructor_success_rate", "age",
    "season_name", "time_of_day",
)
PRE_RACE_CATEGORIES = ("season_name", "time_of_day")


def pre_race_table(tables: Tables, entries: DataFrame | None = None) -> DataFrame:
    """What is known before a race, per (raceId, driverId, constructorId) of the results and of ``entries``.

    Races run in the order of date and raceId. Experience, win rate of the driver and share of the team's races
    with a driver among the first three count earlier races only; the rates are 0 before the first race. Adds
    ``entered``: true for the rows of ``entries``, which need no outcome, false for results. ``finished`` is
    1 or 0 for results and NULL for entries. A driver without a date of birth has a NULL age.
    """
    keys = ["raceId", "driverId", "constructorId"]
    status = tables["status"].select("statusId", binary_label("status", FINISHED, "finished"))
    rows = tables["results"].select(*keys, "positionOrder", "statusId", F.lit(False).alias("entered"))
    rows = rows.join(status, "statusId", "left").drop("statusId")
    if entries is not None:
        rows = rows.unionByName(entries.select(*keys, F.lit(True).alias("entered")), allowMissingColumns=True)
    races = clean_races(tables["races"]).select(
        "raceId", "season_name", "time_of_day", F.struct(F.to_date("date").alias("day"), "raceId").alias("_when")
    )
    rows = rows.join(races, "raceId")

    def before(key: str, success: Column, races_name: str, rate_name: str) -> DataFrame:
        known = win_rate_as_of(rows, key, "_when", success)
        rate = F.coalesce("win_rate_before", F.lit(0.0)).alias(rate_name)
        return known.select(key, "_when", F.col("races_before").alias(races_name), rate)

    ages = age_in_year(named_drivers(tables["drivers"]), "driverId", "dob_date")
    drivers = before("driverId", F.col("positionOrder") == 1, "driver_experience", "driver_win_rate")
    teams = before("constructorId", F.col("positionOrder") <= 3, "constructor_experience", "constructor_success_rate")
    return (
        rows.join(drivers, ["driverId", "_when"])
        .join(teams, ["constructorId", "_when"])
        .join(ages.select("driverId", "age"), "driverId", "left")
        .select(*keys, "entered", "finished", *PRE_RACE_FEATURES)
    )


def predict_race(
    tables: Tables,
    entries: DataFrame,
    features: Sequence[str] = PRE_RACE_FEATURES,
    estimator: Estimator | None = None,
) -> DataFrame:
    """(raceId, driverId, finish_probability, prediction) per entry (raceId, driverId, constructorId).

    The races of ``entries`` are in the races table; laps, stops and results of theirs are not needed. The model
    (default: logistic regression) learns from all results; unknown ages are taken as the mean, an unknown
    time of day as a value of its own.
    """
    rows = pre_race_table(tables, entries).na.fill("Unknown", list(PRE_RACE_CATEGORIES))
    rows = materialise(impute(rows, mean=["age"]))
    train, upcoming = rows.filter(~F.col("entered")), rows.filter("entered")
    categories = [c for c in features if c in PRE_RACE_CATEGORIES]
    models = fit_models(train, "finished", features, categories, {"model": estimator or LogisticRegression()})
    return predict_event(models["model"], upcoming, ENTRY, [c for c in features if c not in categories])
