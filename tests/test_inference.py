"""Errors of coefficients against closed forms and a second computation; hashed features."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from racecast.models import hashing, inference, training

SURE = {"maxIter": 200, "tol": 1e-12}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x, z = rng.normal(size=800), rng.integers(0, 3, 800)
    y = rng.random(800) < 1 / (1 + np.exp(-(0.5 * x + 0.4 * z - 0.6)))
    return spark.createDataFrame([(float(a), int(b), int(c)) for a, b, c in zip(x, z, y)], "x double, z int, y int")


def test_against_numpy(rows):
    models = training.fit_models(rows, "y", ["x", "z"], estimators={"lr": LogisticRegression(**SURE)})
    got = {r.feature: r for r in inference.coefficient_table(models["lr"], rows).collect()}
    data = np.array([tuple(r) for r in rows.collect()])
    design = np.column_stack([data[:, 0], data[:, 1], np.ones(len(data))])
    beta = np.array([got[c].coefficient for c in ("x", "z", inference.INTERCEPT)])
    p = 1 / (1 + np.exp(-design @ beta))
    want = np.sqrt(np.diag(np.linalg.inv(design.T @ (design * (p * (1 - p))[:, None]))))
    assert [got[c].std_error for c in ("x", "z", inference.INTERCEPT)] == pytest.approx(want, rel=1e-9)
    assert got["x"].z == pytest.approx(got["x"].coefficient / got["x"].std_error)


def test_unsettled_coefficients_have_no_error(rows):
    both = rows.withColumns({"twice": F.col("x") * 2, "zero": F.lit(0.0)})
    models = training.fit_models(both, "y", ["x", "twice", "zero", "z"], estimators={"lr": LogisticRegression(**SURE)})
    got = {r.feature: r.std_error for r in inference.coefficient_table(models["lr"], both).collect()}
    assert got["x"] is None and got["twice"] is None and got["zero"] is None and got["z"] > 0


def test_hashed_feature_of_a_million_values_trains(spark):
    many = spark.range(1_000_000).select(
        F.concat(F.lit("v"), "id").alias("text"), (F.col("id") % 2).alias("y"), (F.col("id") % 2 + F.rand(1)).alias("x")
    )
    model = hashing.fit_hashed(many, "y", ["text"], ["x"], LogisticRegression(maxIter=3), size=4096)
    assert model.stages[-1].numFeatures <= 4096 + 3
    shared = hashing.collisions(many, "text", 4096)
    assert shared.agg(F.sum("n_values")).first()[0] == 1_000_000


def test_hashed_model_is_saved_and_takes_new_values(spark, tmp_path):
    train = spark.createDataFrame([("a", 1.0, 1), ("b", 0.0, 0), ("a", 0.5, 1), (None, 0.2, 0)], "t string, x double, y int")
    model = hashing.fit_hashed(train, "y", ["t"], ["x"], LogisticRegression(maxIter=5, regParam=0.1), size=16, portable=True)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    new = spark.createDataFrame([("never seen", 0.1), ("a", 0.9), (None, 0.0)], "t string, x double")
    one, two = ([r.prediction for r in m.transform(new).collect()] for m in (model, back))
    assert one == two and len(one) == 3


def test_collisions(spark):
    df = spark.createDataFrame([(t,) for t in ["a", "a", "b", "c", None]], "t string")
    one = hashing.collisions(df, "t", size=1, portable=True).collect()
    assert [tuple(r) for r in one] == [(1, 3, 4)]
    assert hashing.collisions(df.limit(0), "t").count() == 0
