"""One query per operator over the test tables, each over whole tables.

Stand-ins: customer or event user = driver, order = race, supplier = team, line or event = lap or
stop. The ``q_race_*`` queries run the race analysis over the derived race tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racecast import functions as R
from racecast.models import hashing, inference, metrics, training
from racecast.operators.ordered import Split
from racecast.operators import dataset, explore, features, history, quality, skew
from racecast.plans import race, stand_in
from racecast.session import materialise, scratch_folder
from racecast.sources import CsvTable, found_types, load_all, preview, read_csv
from racecast.sources.schemas import NULL_TEXT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Float results to a fixed number of digits, without negative zero, for comparison."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def _finished() -> Column:
    return F.col("o_orderstatus") == "F"


def _clock(ts: str) -> Column:
    return F.substring(F.col(ts).cast("string"), 12, 8)


# --- features per driver ---------------------------------------------------------------------


@query
def q_win_rate(spark: SparkSession, folder: str) -> DataFrame:
    return features.win_rate(read(spark, folder, "orders"), "o_custkey", "o_orderkey", _finished())


@query
def q_win_rate_as_of(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate").cast("string"))
    return features.win_rate_as_of(orders, "o_custkey", "day", _finished())


@query
def q_profile_left_join(spark: SparkSession, folder: str) -> DataFrame:
    # Every seventh customer gets a key that no order has.
    key = F.when(F.col("c_custkey") % 7 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey"))
    customers = read(spark, folder, "customer").select(key.alias("o_custkey"), "c_mktsegment")
    wins = features.win_rate(read(spark, folder, "orders"), "o_custkey", "o_orderkey", _finished())
    return features.driver_profile(customers, wins, "o_custkey")


@query
def q_entry_dates(spark: SparkSession, folder: str) -> DataFrame:
    entries = read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    dated = features.with_race_date(entries, read(spark, folder, "orders"), "o_orderkey", "o_orderdate")
    return dated.groupBy("o_orderdate_year").agg(F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("top"))


@query
def q_age_in_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("day"))
    layout = F.col("o_custkey") % 3
    text = (
        F.when(layout == 0, F.date_format("day", "dd/MM/yyyy"))
        .when(layout == 1, F.date_format("day", "yyyy-MM-dd"))
        .otherwise(F.date_format("day", "yyyy.MM.dd"))
    )
    parsed = features.with_parsed_date(first.withColumn("dob", text), "dob", "dob_date")
    return features.age_in_year(parsed, "o_custkey", "dob_date")


@query
def q_full_name_clean(spark: SparkSession, folder: str) -> DataFrame:
    supplier = dataset.clean_dimension(
        read(spark, folder, "supplier"), {"s_name": "name", "s_nationkey": "n_nationkey"}, ["s_acctbal"]
    )
    nation = dataset.clean_dimension(read(spark, folder, "nation"), {"n_name": "nation_name"}, ["n_regionkey"])
    joined = supplier.join(nation, "n_nationkey")
    return joined.select("s_suppkey", R.full_name("nation_name", "name").alias("full_name"))


@query
def q_experience(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return features.experience(orders, "o_custkey", "o_orderkey")


@query
def q_experience_many_ties(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events").select(
        "event_id", "event_type", F.to_date("ts").cast("string").alias("day")
    )
    return features.experience(events, "event_type", "day")


# --- laps and stops --------------------------------------------------------------------------


def _event_positions(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").select(
        "event_id", "user_id", "ts", F.floor("value").cast("int").alias("position")
    )


@query
def q_position_change(spark: SparkSession, folder: str) -> DataFrame:
    events = _event_positions(spark, folder)
    changed = features.position_change(events, ["user_id"], ["ts", "event_id"], "position")
    return changed.select("event_id", "user_id", "position", "position_change")


# Small segments, so that the form with cut keys runs on tables of any size.
CUT = Split(rows_per_segment=8, sampled=4)
CUT_VALUES = Split(rows_per_segment=1_000, sampled=16)


@query
def q_position_change_cut(spark: SparkSession, folder: str) -> DataFrame:
    events = _event_positions(spark, folder)
    changed = features.position_change(events, ["user_id"], ["ts", "event_id"], "position", split=CUT)
    return changed.select("event_id", "user_id", "position", "position_change")


@query
def q_experience_cut(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return features.experience(orders, "o_custkey", "o_orderkey", split=CUT)


@query
def q_win_rate_as_of_cut(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate").cast("string"))
    return features.win_rate_as_of(orders, "o_custkey", "day", _finished(), split=CUT)


@query
def q_position_summary_index(spark: SparkSession, folder: str) -> DataFrame:
    events = _event_positions(spark, folder)
    changed = features.position_change(events, ["user_id"], ["ts", "event_id"], "position")
    summary = features.position_summary(changed, ["user_id"], "position_change", "position")
    indexed = summary.withColumn("position_change_index", features.position_change_index())
    return rounded(indexed, 0, "avg_position_change", "position_change_index")


@query
def q_position_summary_direct(spark: SparkSession, folder: str) -> DataFrame:
    events = _event_positions(spark, folder)
    summary = features.position_summary_direct(events, ["user_id"], ["ts", "event_id"], "position")
    indexed = summary.withColumn("position_change_index", features.position_change_index(scale=3))
    return rounded(indexed, 3, "avg_position_change", "position_change_index")


def _line_stops(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("duration")
    )
    return features.stop_summary(lines, ["l_orderkey"], "duration", "l_linenumber")


@query
def q_stop_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _line_stops(spark, folder)


@query
def q_stop_clean_label(spark: SparkSession, folder: str) -> DataFrame:
    return features.labelled_stops(_line_stops(spark, folder))


@query
def q_global_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.global_mean(_line_stops(spark, folder), "total_stops", "mean_stops"), 6, "mean_stops")


@query
def q_group_success(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return features.group_success(lines, "l_orderkey", "l_quantity")


# --- labels and parsing ----------------------------------------------------------------------


@query
def q_season(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select("o_orderkey", R.season_of("o_orderdate").alias("season_name"))


@query
def q_time_band(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").select("event_id", R.time_band(_clock("ts")).alias("time_of_day"))


@query
def q_time_band_strict(spark: SparkSession, folder: str) -> DataFrame:
    band = R.time_band(_clock("ts"), strict_compat=True)
    return read(spark, folder, "events").select("event_id", band.alias("time_of_day"))


@query
def q_lap_time(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    seconds, rest = (cents / 100).cast("long"), cents % 100
    text = F.concat(
        (seconds / 60).cast("long").cast("string"), F.lit(":"),
        F.lpad((seconds % 60).cast("string"), 2, "0"), F.lit("."), F.lpad(rest.cast("string"), 2, "0"),
    )
    laps = F.when(F.col("event_type") == "error", "\\N").otherwise(text)
    return read(spark, folder, "events").select("event_id", F.round(R.lap_time_ms(laps), 3).alias("lap_ms"))


@query
def q_clean_numeric(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", "16:44.718").when(kind == "signup", "\\N").otherwise(F.col("value").cast("string"))
    )
    events = read(spark, folder, "events").select("event_id", text.alias("amount"))
    return quality.clean_numeric(events, ["amount"])


@query
def q_position_group(spark: SparkSession, folder: str) -> DataFrame:
    place = F.when(F.col("l_quantity") < 50, F.col("l_quantity"))
    lines = read(spark, folder, "lineitem").select(R.position_group(place).alias("position_group"))
    return explore.value_counts(lines, "position_group").orderBy("position_group")


@query
def q_binary_label(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = read(spark, folder, "orders").select("o_orderkey", status.alias("status"))
    return orders.select("o_orderkey", dataset.binary_label("status", "F", "label").alias("label"))


@query
def q_filters(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate").cast("string"))
    orders = orders.withColumn("priority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    tests = {
        "n_null": F.col("priority").isNull(),
        "n_equal": F.col("o_orderstatus") == "F",
        "n_member": F.year("o_orderdate").isin(1996, 1997, 1998),
        "n_between": F.month("o_orderdate").between(3, 5),
        "n_text_between": F.col("day").between("1996-01-01", "1996-12-31"),
        "n_dash": F.col("priority").contains("-"),
        "n_slash": F.col("priority").contains("/"),
        "n_either": F.isnan("o_totalprice") | (F.col("o_totalprice") > 250_000),
    }
    orders = orders.withColumn("status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    known = orders.na.drop(subset=["status"])
    return known.agg(*(F.count(F.when(test, 1)).alias(name) for name, test in tests.items()))


@query
def q_filter_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100_000)).na.drop("any")


# --- quality ---------------------------------------------------------------------------------


def _gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    return read(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(price < 200_000, price).when(price < 300_000, F.lit(float("nan"))).alias("price"),
    )


@query
def q_null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_profile(_gappy_orders(spark, folder))


@query
def q_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_rows(_gappy_orders(spark, folder).select("o_orderkey", "status"), "status")


@query
def q_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.cardinality(read(spark, folder, "lineitem"))


@query
def q_cardinality_one_scan(spark: SparkSession, folder: str) -> DataFrame:
    return quality.cardinality(read(spark, folder, "lineitem"), one_scan=True)


@query
def q_describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.describe(read(spark, folder, "lineitem")), 4, "mean", "stddev")


@query
def q_impute_zero_mean(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.when(F.col("l_quantity") < 45, F.col("l_quantity"))
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("rank"),
        quantity.alias("speed"),
        quantity.cast("int").alias("speed_int"),
    )
    return rounded(quality.impute(lines, zero=["rank"], mean=["speed", "speed_int"]), 6, "speed")


@query
def q_preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview(read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), 5, "o_orderkey")


# --- joins -----------------------------------------------------------------------------------


@query
def q_base_table(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey"), "o_orderstatus"
    )
    customer = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment"
    )
    nation = read(spark, folder, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    lines = read(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_quantity")).alias("quantity")
    )
    visits = read(spark, folder, "events").groupBy(F.col("user_id").alias("CUSTKEY")).agg(
        F.count(F.lit(1)).alias("visits")
    )
    return dataset.base_table(
        orders,
        [
            (customer, "custkey"),
            (nation, "n_nationkey"),
            (read(spark, folder, "region"), "r_regionkey"),
            (lines, "o_orderkey"),
            (visits, "custkey"),
        ],
        drops=["n_nationkey", "r_regionkey"],
    )


@query
def q_composite_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_suppkey"]
    returned = lines.filter(F.col("l_returnflag") == "R").groupBy(*keys).agg(F.count(F.lit(1)).alias("stops"))
    sums = lines.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    return dataset.base_table(sums, [(returned, keys)])


# --- exploration -----------------------------------------------------------------------------


@query
def q_top_k_winners(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").filter(F.year("o_orderdate").isin(1996, 1997, 1998))
    points = orders.withColumn("points", F.floor("o_totalprice"))
    best = explore.top_k(explore.wins_and_points(points, "o_custkey", _finished(), "points"), "wins", 10, "o_custkey")
    names = read(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return best.join(names, "o_custkey", "left")


@query
def q_wins_sorted(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_returnflag")
    named = lines.join(read(spark, folder, "supplier").select("s_suppkey", "s_name"), "s_suppkey")
    return explore.ranked(explore.wins_by(named, "s_suppkey", F.col("l_returnflag") == "R", "s_name"), "wins", "s_suppkey")


@query
def q_histogram(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))
    return rounded(explore.histogram(orders, "year"), 6, "low", "high")


@query
def q_density(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))
    return rounded(explore.density_grid(orders, "year", points=50), 6, "x", "density")


@query
def q_density_binned(spark: SparkSession, folder: str) -> DataFrame:
    """With bins whose ends are the values themselves the binned density is the exact one."""
    lines = read(spark, folder, "lineitem").select("l_quantity")
    return rounded(explore.density_binned(lines, "l_quantity", points=50, bins=49 * 80), 6, "x", "density")


def _customer_wins(spark: SparkSession, folder: str) -> DataFrame:
    return features.win_rate(read(spark, folder, "orders"), "o_custkey", "o_orderkey", _finished())


@query
def q_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return explore.pair_counts(_customer_wins(spark, folder), "total_races", "total_wins")


@query
def q_corr(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.correlation(_customer_wins(spark, folder), "total_races", "total_wins"), 6, "corr")


MEANS = ("mean", "stddev", "ci_low", "ci_high")


@query
def q_mean_by(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.mean_by(read(spark, folder, "lineitem"), ["l_linenumber"], "l_quantity"), 4, *MEANS)


@query
def q_mean_by_two(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events").select(
        "event_type", R.time_band(_clock("ts")).alias("time_of_day"), F.floor("value").alias("whole")
    )
    return rounded(explore.mean_by(events, ["event_type", "time_of_day"], "whole"), 4, *MEANS)


@query
def q_mean_by_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    how = explore.Bootstrap(("l_orderkey", "l_linenumber", "l_partkey"), REPLICATES, portable=True)
    lines = read(spark, folder, "lineitem")
    return rounded(explore.mean_by(lines, ["l_linenumber"], "l_quantity", "bootstrap", how), 4, *MEANS)


BOX = ("low", "q1", "median", "q3", "high", "whisker_low", "whisker_high")


@query
def q_box_stats(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(explore.box_stats(lines, "l_returnflag", "l_extendedprice"), 4, *BOX)


@query
def q_top_status(spark: SparkSession, folder: str) -> DataFrame:
    counts = explore.value_counts(read(spark, folder, "lineitem"), "l_partkey")
    return explore.top_k(counts, "n", 20, "l_partkey")


@query
def q_status_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").filter(F.col("l_returnflag").isin("A", "R", "X"))
    return explore.value_counts(lines, ["l_quantity", "l_returnflag"])


# --- classification --------------------------------------------------------------------------


@query
def q_string_index(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    known = orders.na.drop("any", subset=["priority", "status"])
    indexed = training.fit_categories(known, ["priority", "status"]).transform(known)
    return explore.value_counts(indexed, ["priority", "priority_index", "status", "status_index"])


@query
def q_split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return dataset.split_sizes(read(spark, folder, "orders"), ["o_orderkey"], portable=True)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "labels").join(read(spark, folder, "documents").drop("text"), "doc_id")


def _rule(spark: SparkSession, folder: str) -> DataFrame:
    guess = R.flag((F.col("n_chars") > 500) & (F.col("toxic") == 0))
    return _documents(spark, folder).withColumn("prediction", guess)


@query
def q_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(_rule(spark, folder), "quality")


@query
def q_confusion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.class_metrics(metrics.confusion(_rule(spark, folder), "quality", keys=["lang"]), ["lang"])
    return rounded(report, 6, "accuracy", "f1", "weighted_precision", "weighted_recall")


@query
def q_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.auc(_documents(spark, folder), "quality", "n_chars"), 6, "auc")


@query
def q_auc_by_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(
        "l_linestatus", R.flag(F.col("l_returnflag") == "R").alias("label"), "l_extendedprice"
    )
    return rounded(metrics.auc(lines, "label", "l_extendedprice", ["l_linestatus"]), 6, "auc")


DOCUMENT_FEATURES = ["n_chars", "toxic", "lang", "source"]


def _document_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = _documents(spark, folder)
    return dataset.split_by_hash(rows, ["doc_id"])


@query
def q_model_report(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _document_split(spark, folder)
    models = training.fit_models(train, "quality", DOCUMENT_FEATURES, ["lang"])
    return training.compare_models(models, train, test)


@query
def q_best_model(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _document_split(spark, folder)
    trees = {f"tree_depth_{n}": DecisionTreeClassifier(maxDepth=n) for n in (2, 5)}
    models = training.fit_models(train, "quality", DOCUMENT_FEATURES, ["lang"], trees)
    return training.best_model(training.compare_models(models, train, test, score="probability"))


@query
def q_importance(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _document_split(spark, folder)
    models = training.fit_models(
        train, "quality", DOCUMENT_FEATURES, estimators={"logistic_regression": LogisticRegression()}
    )
    return training.feature_importance(models["logistic_regression"], train)


@query
def q_feature_subset(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _document_split(spark, folder)
    subset = ["n_chars", "toxic"]
    models = training.fit_models(
        train.select("doc_id", "quality", *subset), "quality", subset,
        estimators={"decision_tree": DecisionTreeClassifier()},
    )
    return training.compare_models(models, train, test)


@query
def q_predict_event(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _document_split(spark, folder)
    models = training.fit_models(
        train, "quality", DOCUMENT_FEATURES, ["lang"], {"logistic_regression": LogisticRegression()}
    )
    return training.predict_event(models["logistic_regression"], test, ["doc_id"])


@query
def q_cross_validate(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _document_split(spark, folder)
    ready = training.fit_features(train, "quality", DOCUMENT_FEATURES).transform(train)
    _, table = training.cross_validate(ready, ["doc_id"])
    return table


# --- the race analysis over derived race tables ----------------------------------------------


def _race(spark: SparkSession, folder: str) -> race.RaceData:
    return race.RaceData(stand_in.race_tables(spark, folder), stand_in.YEARS, stand_in.LAP_ORDER)


def _race_base(spark: SparkSession, folder: str, fill_means: bool = True) -> DataFrame:
    tables = stand_in.race_tables(spark, folder, keep_lines=True)
    return race.race_base_table(race.clean_tables(tables, fill_means, lap_order=stand_in.LAP_ORDER))


@query
def q_race_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return _race(spark, folder).clean["drivers"]


@query
def q_race_laps(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_race(spark, folder).clean["lapTimes"], 0, "avg_position_change", "position_change_index")


@query
def q_race_stops(spark: SparkSession, folder: str) -> DataFrame:
    return _race(spark, folder).clean["pitStops"]


@query
def q_race_results(spark: SparkSession, folder: str) -> DataFrame:
    clean = race.clean_results(stand_in.race_tables(spark, folder)["results"])
    return rounded(clean, 6, "fastestLapSpeed", "avg_lap_time_seconds")


@query
def q_race_base_table(spark: SparkSession, folder: str) -> DataFrame:
    base = _race_base(spark, folder)
    texts = base.withColumn("date", F.col("date").cast("string"))
    floats = ("fastestLapSpeed", "avg_lap_time_seconds", "avg_position_change", "position_change_index")
    return rounded(texts, 4, *floats)


@query
def q_race_training_table(spark: SparkSession, folder: str) -> DataFrame:
    base = _race_base(spark, folder)
    rows = race.training_table(base)
    return rows.groupBy("status", "position_group", "season_name", "time_of_day", "pitStopFrequencyLabel").agg(
        F.count(F.lit(1)).alias("n"), F.sum("driver_experience").alias("experience"), F.sum("age").alias("ages")
    )


@query
def q_race_model_report(spark: SparkSession, folder: str) -> DataFrame:
    _, report = race.finish_models(_race_base(spark, folder, fill_means=False))
    return report


@query
def q_race_top_features(spark: SparkSession, folder: str) -> DataFrame:
    trees = {"decision_tree": DecisionTreeClassifier()}
    _, report = race.finish_models(_race_base(spark, folder, fill_means=False), race.TOP_FEATURES, trees)
    return report


# Columns of each exploration table that are floats, with the digits compared.
RACE_TOPICS: dict[str, tuple[int, tuple[str, ...]]] = {
    "races_per_year": (6, ("low", "high")),
    "races_per_year_density": (6, ("x", "density")),
    "top_drivers": (4, ("points",)),
    "constructor_wins": (0, ()),
    "position_groups": (0, ()),
    "races_vs_wins": (0, ()),
    "races_wins_correlation": (6, ("corr",)),
    "win_rates": (6, ("low", "high")),
    "win_rates_density": (6, ("x", "density")),
    "rank_by_experience": (4, MEANS),
    "wins_by_race_and_season": (4, MEANS),
    "lap_seconds_by_season": (4, BOX),
    "position_change_by_season": (4, BOX),
    "stops_by_season": (4, MEANS),
    "stops_by_season_and_time": (4, MEANS),
    "stop_duration_by_season": (4, BOX),
    "top_statuses": (0, ()),
    "failures_by_speed": (4, ("fastestLapSpeed",)),
    "speed_by_position": (4, MEANS),
    "duration_vs_efficiency": (0, ()),
    "efficiency_by_wins": (4, MEANS),
    "change_by_stop_duration": (4, MEANS),
}


def _race_topic(topic: str) -> Query:
    digits, floats = RACE_TOPICS[topic]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(race.explore(_race(spark, folder), topic), digits, *floats) if floats else race.explore(
            _race(spark, folder), topic
        )

    return run


QUERIES.update({f"q_race_{topic}": _race_topic(topic) for topic in RACE_TOPICS})

# Reports of means, their intervals by a bootstrap that other engines can repeat.
BOOTSTRAP_TOPICS = (
    "wins_by_race_and_season", "stops_by_season", "stops_by_season_and_time", "speed_by_position", "efficiency_by_wins",
    "change_by_stop_duration",
)
REPLICATES = 200


def _bootstrap_topic(topic: str) -> Query:
    digits, floats = RACE_TOPICS[topic]
    how = explore.Bootstrap(tuple(race.ENTRY), REPLICATES, portable=True)

    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = stand_in.race_tables(spark, folder)
        data = race.RaceData(tables, stand_in.YEARS, stand_in.LAP_ORDER, "bootstrap", how)
        return rounded(race.explore(data, topic), digits, *floats)

    return run


QUERIES.update({f"q_race_{topic}_bootstrap": _bootstrap_topic(topic) for topic in BOOTSTRAP_TOPICS})


@query
def q_race_joined_columns(spark: SparkSession, folder: str) -> DataFrame:
    return race.explore(_race(spark, folder), "joined_columns")


@query
def q_race_circuits(spark: SparkSession, folder: str) -> DataFrame:
    return race.clean_circuits(stand_in.race_tables(spark, folder)["circuits"])


@query
def q_race_constructor_results(spark: SparkSession, folder: str) -> DataFrame:
    points = race.clean_constructor_results(stand_in.race_tables(spark, folder)["constructorResults"])
    return explore.value_counts(points, "points")


@query
def q_race_pre_race(spark: SparkSession, folder: str) -> DataFrame:
    rows = race.pre_race_table(stand_in.race_tables(spark, folder)).drop("entered")
    return rows.withColumns({c: F.round(c, 3) for c in ("driver_win_rate", "constructor_success_rate")})


@query
def q_race_predict(spark: SparkSession, folder: str) -> DataFrame:
    """Every driver of the last race again as an entry of a race that has not been run."""
    tables = stand_in.race_tables(spark, folder)
    last = tables["races"].agg(F.max("raceId"))
    field = tables["results"].filter(F.col("raceId") == last.scalar()).select("raceId", "driverId", "constructorId")
    known = {**tables, "results": tables["results"].filter(F.col("raceId") != last.scalar())}
    return race.predict_race(known, field.dropDuplicates(race.ENTRY))


@query
def q_race_importance(spark: SparkSession, folder: str) -> DataFrame:
    base = race.training_table(_race_base(spark, folder)).na.drop("any", subset=list(race.CATEGORIES))
    # Read by the mean, by each category's counts and by the encoding.
    rows = quality.impute(materialise(base.select("status", *race.FEATURES, *race.CATEGORIES)), mean=["age"])
    models = training.fit_models(
        rows, "status", race.FEATURES + race.CATEGORIES, race.CATEGORIES,
        {"logistic_regression": LogisticRegression()},
    )
    return training.feature_importance(models["logistic_regression"], rows)


# --- models whose results are known exactly ---------------------------------------------------

def _sure() -> LogisticRegression:
    return LogisticRegression(maxIter=300, tol=1e-10)



def _labelled_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A label whose share differs by priority, and columns derived from both."""
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    label = R.flag(F.col("o_orderkey") % 11 < 2 * level)
    return read(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        level.alias("level"),
        label.alias("label"),
        R.flag(level > 2).alias("high"),
        (F.col("o_totalprice") + F.when(label == 1, 1_000_000).otherwise(-1_000_000)).alias("apart"),
    )


@query
def q_string_index_many(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(F.col("l_partkey").cast("string").alias("part"))
    indexed = training.fit_categories(lines, ["part"]).transform(lines)
    return explore.value_counts(indexed, ["part", "part_index"])


@query
def q_encoded_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled_orders(spark, folder)
    encoded = training.fit_features(rows, "label", ["level", "priority"]).transform(rows)
    names = F.array(*(F.lit(n) for n in training.feature_names(encoded)))
    entries = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value"))
    return encoded.select("o_orderkey", F.inline(entries).alias("feature", "value")).filter("value <> 0")


@query
def q_logistic_means(spark: SparkSession, folder: str) -> DataFrame:
    """Without regularisation the probability of a group is its share of label 1."""
    rows = _labelled_orders(spark, folder)
    models = training.fit_models(rows, "label", ["priority"], estimators={"lr": _sure()})
    chances = training.predict_event(models["lr"], rows, ["priority"])
    return explore.value_counts(rounded(chances, 3, "finish_probability"), chances.columns)


@query
def q_log_odds(spark: SparkSession, folder: str) -> DataFrame:
    """The coefficient of a feature of 0 and 1 is the logarithm of the odds ratio."""
    rows = _labelled_orders(spark, folder)
    models = training.fit_models(rows, "label", ["high"], estimators={"lr": _sure()})
    return rounded(training.feature_importance(models["lr"], rows), 3, "importance")


@query
def q_log_odds_errors(spark: SparkSession, folder: str) -> DataFrame:
    """The error of a logarithm of odds is the root of the sum of the cells' inverses."""
    rows = _labelled_orders(spark, folder)
    models = training.fit_models(rows, "label", ["high"], estimators={"lr": _sure()})
    return rounded(inference.coefficient_table(models["lr"], rows), 3, "coefficient", "std_error", "z")


@query
def q_hash_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Places that several parts share when their numbers, as text, are hashed to 512 places."""
    lines = read(spark, folder, "lineitem").select(F.col("l_partkey").cast("string").alias("part"))
    return hashing.collisions(lines, "part", 512, portable=True)


@query
def q_tree_majority(spark: SparkSession, folder: str) -> DataFrame:
    """A tree that can part all groups predicts each group's majority."""
    rows = _labelled_orders(spark, folder)
    models = training.fit_models(rows, "label", ["priority"], ["priority"], {"tree": DecisionTreeClassifier()})
    return explore.value_counts(models["tree"].transform(rows), ["priority", "prediction"])


@query
def q_svm_apart(spark: SparkSession, folder: str) -> DataFrame:
    """Classes far apart are told apart by the linear SVM."""
    rows = _labelled_orders(spark, folder)
    svm = {"linear_svm": training.default_classifiers()["linear_svm"]}
    models = training.fit_models(rows, "label", ["apart"], estimators=svm)
    return models["linear_svm"].transform(rows).select("o_orderkey", "prediction")


def _group_report(spark: SparkSession, folder: str) -> DataFrame:
    """Models that know the group only, trained on a split that other engines can make too."""
    train, test = dataset.split_by_hash(_labelled_orders(spark, folder), ["o_orderkey"], portable=True)
    both = {"lr": _sure(), "tree": DecisionTreeClassifier()}
    models = training.fit_models(train, "label", ["priority"], estimators=both)
    return training.compare_models(models, train, test, score="probability")


REPORTED = ("auc", "accuracy", "f1", "weighted_precision", "weighted_recall")


@query
def q_group_report(spark: SparkSession, folder: str) -> DataFrame:
    # A tree merges leaves that predict alike, so its area is not that of the groups; all else is.
    area = F.when(F.col("model") == "lr", F.col("auc")).alias("auc")
    return rounded(_group_report(spark, folder).withColumn("auc", area), 6, *REPORTED)


@query
def q_subset_report(spark: SparkSession, folder: str) -> DataFrame:
    """Trained again on one of its features, a tree reports that feature's groups."""
    train, test = dataset.split_by_hash(_labelled_orders(spark, folder), ["o_orderkey"], portable=True)
    models = training.fit_models(train, "label", ["high"], estimators={"tree": DecisionTreeClassifier()})
    return rounded(training.compare_models(models, train, test, score="probability"), 6, *REPORTED)


@query
def q_group_best(spark: SparkSession, folder: str) -> DataFrame:
    report = training.best_model(_group_report(spark, folder), "accuracy")
    return rounded(report.select("model", "split", "n", "accuracy"), 6, "accuracy")


@query
def q_fold_auc(spark: SparkSession, folder: str) -> DataFrame:
    """With one rising feature every fold's AUC is the feature's own, whatever the regularisation."""
    rows = _labelled_orders(spark, folder)
    ready = training.fit_features(rows, "label", ["level"]).transform(rows)
    _, table = training.cross_validate(
        ready, ["o_orderkey"], reg_params=(0.01, 0.1), elastic_net_params=(0.0,), portable=True
    )
    return rounded(table, 6, "mean_auc")


@query
def q_box_stats_cut(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(explore.box_stats(lines, "l_returnflag", "l_extendedprice", split=CUT_VALUES), 4, *BOX)


@query
def q_auc_by_key_cut(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(
        "l_linestatus", R.flag(F.col("l_returnflag") == "R").alias("label"), "l_extendedprice"
    )
    return rounded(metrics.auc(lines, "label", "l_extendedprice", ["l_linestatus"], split=CUT_VALUES), 6, "auc")


# --- keys that hold a third of all rows -------------------------------------------------------


def _hot_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every third order is one customer's; some orders have none."""
    key = F.col("o_orderkey")
    customer = F.when(key % 3 == 0, F.lit(1)).when(key % 50 != 7, F.col("o_custkey")).cast("bigint")
    return read(spark, folder, "orders").select(key, customer.alias("custkey"), (key % 24).cast("int").alias("place"))


@query
def q_heavy_hitters(spark: SparkSession, folder: str) -> DataFrame:
    return skew.heavy_hitters(_hot_orders(spark, folder), ["custkey"], share=0.01)


@query
def q_salted_join(spark: SparkSession, folder: str) -> DataFrame:
    names = read(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return skew.salted_join(_hot_orders(spark, folder), names, ["custkey"], "left")


@query
def q_group_success_hot(spark: SparkSession, folder: str) -> DataFrame:
    return features.group_success(_hot_orders(spark, folder), "custkey", "place", k=0)


@query
def q_experience_hot(spark: SparkSession, folder: str) -> DataFrame:
    orders = _hot_orders(spark, folder).withColumn("day", F.when(F.col("custkey") == 1, 1).otherwise(F.col("place")))
    return features.experience(orders, "custkey", "day")


@query
def q_base_table_hot(spark: SparkSession, folder: str) -> DataFrame:
    customer = read(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_nationkey")
    sums = read(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity")
    )
    joins = [(customer, "custkey"), (sums, "o_orderkey")]
    return dataset.base_table(_hot_orders(spark, folder), joins, heavy=skew.DEFAULT_SKEW)


@query
def q_null_key_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the totals of their customer, those without a customer with the totals of all such."""
    orders = _hot_orders(spark, folder)
    totals = orders.groupBy("custkey").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("worst"))
    return dataset.base_table(orders, [(totals, "custkey")], null_safe=True)


# --- CSV files --------------------------------------------------------------------------------


@query
def q_csv_types(spark: SparkSession, folder: str) -> DataFrame:
    """The types found in all rows of a table written as text, of some columns made less regular."""
    key = F.col("o_orderkey")
    orders = read(spark, folder, "orders").select(
        key,
        (key * 4_000_000_000).alias("big"),
        F.col("o_totalprice").alias("price"),
        F.to_date("o_orderdate").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        (key % 2 == 0).alias("even"),
        F.when(key % 7 != 0, key % 7).alias("gaps"),
        F.lit(None).cast("string").alias("empty"),
        F.when(key == F.lit(1), F.lit("x")).otherwise(key.cast("string")).alias("nearly"),
        F.col("o_orderpriority").alias("priority"),
    )
    path = f"{scratch_folder(spark)}/orders.csv"
    orders.write.csv(path, header=True, nullValue=NULL_TEXT)
    texts = spark.read.option("header", True).option("nullValue", NULL_TEXT).csv(path)
    return found_types(texts)


@query
def q_csv_base_table(spark: SparkSession, folder: str) -> DataFrame:
    """The race base table from CSV files, with no type but those found in them."""
    base_dir = scratch_folder(spark)
    for name, table in stand_in.race_tables(spark, folder).items():
        table.write.csv(f"{base_dir}/{name}.csv", header=True, nullValue=NULL_TEXT)
    tables = load_all(spark, base_dir, infer=True)
    base = race.race_base_table(race.clean_tables(tables, lap_order=stand_in.LAP_ORDER))
    texts = base.withColumns(
        {"date": F.col("date").cast("string"), **{c: F.col(c).cast("bigint") for c in ("driverId", "constructorId")}}
    )
    floats = ("fastestLapSpeed", "avg_lap_time_seconds", "avg_position_change", "position_change_index")
    return rounded(texts, 4, *floats)


DAMAGED = "part int, o_orderkey bigint, price double, day date, status string"


def _damaged_csv(spark: SparkSession, folder: str) -> CsvTable:
    """Orders as CSV lines, some with a field too many or too few, a bad price or a day that does not exist."""
    key, part = F.col("o_orderkey"), F.col("o_custkey") % 3
    price = F.when(key % 19 == 3, "n/a").otherwise(F.floor("o_totalprice").cast("string"))
    day = F.when(key % 23 == 4, "1997-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = [part.cast("string"), key.cast("string"), price, day, F.col("o_orderstatus")]
    line = F.when(key % 17 == 1, F.concat_ws(",", *fields, F.lit("more"))).when(
        key % 17 == 2, F.concat_ws(",", *fields[:3])
    ).otherwise(F.concat_ws(",", *fields))
    path = f"{scratch_folder(spark)}/orders.csv"
    lines = read(spark, folder, "orders").select(line.alias("value"), part.alias("folder"))
    lines.write.partitionBy("folder").text(path)
    schema = spark.createDataFrame([], DAMAGED).schema
    return read_csv(spark, f"{path}/*", schema, header=False)


@query
def q_csv_damage(spark: SparkSession, folder: str) -> DataFrame:
    """What could not be read, by folder of the files and column."""
    found = _damaged_csv(spark, folder).damage()
    where = F.regexp_extract("file", "folder=([0-9]+)", 1).cast("int").alias("folder")
    return found.groupBy(where, "column_name").agg(F.sum("n").alias("n"))


@query
def q_csv_rescued(spark: SparkSession, folder: str) -> DataFrame:
    """Every row that was read, and as text what was not."""
    rows = _damaged_csv(spark, folder).rows
    kept = {f"rescued_{c}": F.element_at("_rescued", c) for c in ("price", "day")}
    return rows.withColumns({**kept, "day": F.col("day").cast("string")}).withColumn(
        "line", F.element_at("_rescued", "_line")
    ).drop("_rescued", "_file")


# --- histories kept as state ------------------------------------------------------------------

NEW_FROM = "1997-06-01"


def _history(spark: SparkSession, folder: str) -> history.Advanced:
    """The state of all days before ``NEW_FROM``, written and read back, advanced by the days since then."""
    orders = read(spark, folder, "orders")
    new = F.to_date("o_orderdate") >= F.lit(NEW_FROM).cast("date")
    named = {"wins": R.flag(_finished())}
    day = F.to_date("o_orderdate").cast("string").alias("day")
    before, since = (orders.filter(part).select("o_custkey", day, "o_orderstatus") for part in (~new, new))
    path = f"{scratch_folder(spark)}/state"
    history.history_state(before, "o_custkey", "day", named).write.parquet(path)
    return history.advance(spark.read.parquet(path), since, "o_custkey", "day", named)


@query
def q_history_features(spark: SparkSession, folder: str) -> DataFrame:
    return history.rate(_history(spark, folder).features, "wins", "win_rate_before")


@query
def q_history_state(spark: SparkSession, folder: str) -> DataFrame:
    return _history(spark, folder).state
