"""Metrics against brute force and Spark's evaluators; encoding, training and scoring."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from racecast.models import metrics, training
from racecast.operators.dataset import split_by_hash
from racecast.operators.ordered import DEFAULT_SPLIT, Split
from racecast.plans import queries, race, stand_in

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(700):
        label = int(rnd.random() < 0.4)
        score = round(rnd.gauss(label, 1.5), 1) + 0.0  # the evaluator tells -0.0 from 0.0
        rows.append((i, i % 2, float(label), score, float(score > 0.8)))
    return spark.createDataFrame(rows, "id int, k int, label double, score double, prediction double")


def brute_auc(rows):
    pos = [r.score for r in rows if r.label == 1]
    neg = [r.score for r in rows if r.label == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("split", [DEFAULT_SPLIT, Split(rows_per_segment=9, sampled=3)])
def test_auc(scored, split):
    rows = scored.collect()
    assert metrics.auc(scored, split=split).first().auc == pytest.approx(brute_auc(rows))
    got = {r.k: r.auc for r in metrics.auc(scored, keys=["k"], split=split).collect()}
    assert got == pytest.approx({k: brute_auc([r for r in rows if r.k == k]) for k in (0, 1)})
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scored)
    assert metrics.auc(scored).first().auc == pytest.approx(spark_auc)


def test_auc_with_one_class_is_null(scored):
    assert metrics.auc(scored.filter("label = 1")).first().auc is None


def test_class_metrics(scored):
    got = metrics.class_metrics(metrics.confusion(scored)).first()
    names = {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall"}
    for mine, theirs in names.items():
        want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored)
        assert got[mine] == pytest.approx(want), mine
    assert got.weighted_recall == pytest.approx(got.accuracy)


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    got = metrics.class_metrics(metrics.confusion(df)).first()
    for mine, theirs in (("f1", "f1"), ("weighted_precision", "weightedPrecision")):
        assert got[mine] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))


def test_index_rule(spark):
    df = spark.createDataFrame([("y",), ("y",), ("x",), ("a",), (None,)], "c string").na.drop("any")
    got = training.fit_categories(df, ["c"]).transform(df).distinct().collect()
    assert {r.c: r.c_index for r in got} == {"y": 0.0, "a": 1.0, "x": 2.0}
    later = spark.createDataFrame([("new",), (None,), ("x",)], "c string")
    got = training.fit_categories(df, ["c"]).transform(later).collect()
    assert {r.c: r.c_index for r in got} == {"new": 3.0, None: 3.0, "x": 2.0}


def test_index_of_very_many_values(spark):
    df = spark.range(30_000).select(F.concat(F.lit("v"), F.floor(F.col("id") * 2 / 3).cast("string")).alias("c"))
    got = training.fit_categories(df, ["c"]).transform(df)
    assert got.agg(F.countDistinct("c_index"), F.min("c_index"), F.max("c_index")).first() == (20_000, 0, 19_999)


@pytest.fixture(scope="module")
def entries(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(400):
        text, x, z = rnd.choice("uvw"), rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, text, x, z, int(x + (text == "u") + rnd.gauss(0, 0.5) > 0.3)))
    return spark.createDataFrame(rows, "id int, t string, x double, z double, y int")


def test_models_report_names_and_unseen_values(spark, entries):
    train, test = split_by_hash(entries, ["id"])
    models = training.fit_models(train, "y", ["x", "z", "t"])
    assert set(models) == {"linear_svm", "logistic_regression", "decision_tree"}
    report = training.compare_models(models, train, test)
    rows = {(r.model, r.split): r for r in report.collect()}
    assert len(rows) == 6 and rows["logistic_regression", "test"].auc > 0.8
    assert rows["decision_tree", "train"].n == train.count()
    assert all(0 <= r[m] <= 1 for r in rows.values() for m in ("auc", "accuracy", "f1", "weighted_precision"))
    best = training.best_model(report).first()
    assert best.auc == max(r.auc for (_, part), r in rows.items() if part == "test")

    lr = models["logistic_regression"]
    assert training.feature_names(lr.transform(train))[:2] == ["x", "z"]
    ranked = training.feature_importance(lr, train).collect()
    assert len(ranked) == len(lr.stages[-1].coefficients) and [r.importance for r in ranked] == sorted(
        (r.importance for r in ranked), reverse=True
    )
    assert {r.feature: r.importance for r in ranked}["x"] > 1
    assert len(training.feature_importance(models["decision_tree"], train).collect()) == len(ranked)

    new = spark.createDataFrame([(1, "never seen", 3.0, 0.0, 1)], entries.schema)
    chance = training.predict_event(lr, new, ["id"]).first()
    assert chance.finish_probability > 0.8 and chance.prediction == 1.0
    with pytest.raises(ValueError, match="no probabilities"):
        training.predict_event(models["linear_svm"], new, ["id"])


def test_default_settings():
    models = training.default_classifiers()
    assert isinstance(models["linear_svm"], LinearSVC) and models["linear_svm"].getMaxIter() == 10
    assert models["linear_svm"].getRegParam() == 0.1
    assert isinstance(models["logistic_regression"], LogisticRegression)
    assert isinstance(models["decision_tree"], DecisionTreeClassifier) and models["decision_tree"].getMaxDepth() == 5


def test_null_number_is_refused(entries):
    gap = entries.withColumn("x", F.when(F.col("id") != 3, F.col("x")))
    with pytest.raises(Exception):
        training.fit_models(gap, "y", ["x", "z"], estimators={"tree": DecisionTreeClassifier()})


def test_cross_validation(entries):
    ready = training.fit_features(entries, "y", ["x", "z"]).transform(entries)
    model, table = training.cross_validate(ready, ["id"], folds=2, reg_params=[0.01, 1.0], elastic_net_params=[0.0])
    rows = table.collect()
    assert len(rows) == 2 and rows[0].mean_auc >= rows[1].mean_auc
    assert model.transform(ready).count() == 400


def test_race_models(spark):
    tables = stand_in.race_tables(spark, SF)
    clean = race.clean_tables(tables, fill_means=False, lap_order=stand_in.LAP_ORDER)
    features = ("points", "laps", "fastestLapSpeed", "winRate", "season_name")
    models, report = race.finish_models(
        race.race_base_table(clean), features, {"logistic_regression": LogisticRegression()}
    )
    assert {(r.model, r.split) for r in report.collect()} == {("logistic_regression", s) for s in ("train", "test")}
    upcoming = race.training_table(race.race_base_table(race.clean_tables(tables, lap_order=stand_in.LAP_ORDER)))
    chances = training.predict_event(models["logistic_regression"], upcoming, race.ENTRY)
    assert chances.columns == ["raceId", "driverId", "finish_probability", "prediction"]
    assert chances.filter("finish_probability between 0 and 1").count() == upcoming.count() > 100


class Parts(LogisticRegression):
    """Notes in how many parts the rows of a fit are read."""

    def fit(self, rows, params=None):
        self.sizes = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        return super().fit(rows, params)


def test_fit_reads_parts_of_bounded_size(spark, monkeypatch):
    """Decoded vectors are many times larger than their files, of which one task read up to 128 MB."""
    monkeypatch.setattr(training, "TASK_NUMBERS", 200, raising=False)
    rows = spark.range(0, 1000, 1, 2).select((F.col("id") % 3 % 2).alias("y"), F.col("id").alias("x"), (F.col("id") % 7).alias("z"))
    rows = rows.withColumn("t", F.concat(F.lit("v"), F.col("x") % 40))
    spy = Parts()
    training.fit_models(rows, "y", ["x", "z"], estimators={"spy": spy})
    assert sum(spy.sizes) == 1000 and max(spy.sizes) <= 150
    # A text feature's vector is wide, but sparse.
    training.fit_models(rows, "y", ["x", "t"], estimators={"spy": spy})
    assert sum(spy.sizes) == 1000 and max(spy.sizes) <= 75 and len(spy.sizes) == 20
    monkeypatch.setattr(training, "TASK_NUMBERS", 1 << 40, raising=False)
    training.fit_models(rows, "y", ["x", "z"], estimators={"spy": spy})
    assert len(spy.sizes) <= 2


def test_finish_models_keep_only_the_columns_used(spark, monkeypatch):
    kept = []
    base = race.race_base_table(race.clean_tables(stand_in.race_tables(spark, SF), False, lap_order=stand_in.LAP_ORDER))
    monkeypatch.setattr(race, "materialise", lambda df: kept.append(df) or df.persist())
    race.finish_models(base, ["raceId", "points", "max_position"], {"tree": DecisionTreeClassifier()})
    assert kept[0].columns == ["raceId", "driverId", "status", "points", "max_position"]


def test_race_importance_reads_the_joined_tables_once(spark, monkeypatch):
    seen = []
    fit = training.fit_models
    monkeypatch.setattr(training, "fit_models", lambda rows, *more: seen.append(rows) or fit(rows, *more))
    assert queries.q_race_importance(spark, SF).count() == 27
    plan = seen[0]._jdf.queryExecution().analyzed().toString()
    cached = seen[0]._jdf.queryExecution().withCachedData().toString()
    assert "Join" not in plan or "InMemoryRelation" in cached
