"""Bootstrap intervals: same under any partitioning, and near what theory and plain resampling say."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from racecast.operators import explore


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(i, "ab"[i % 2], rng.gauss(10, 3) if i % 2 else rng.expovariate(0.2)) for i in range(800)]
    return spark.createDataFrame([*data, (800, "one", 5.0), (801, "none", None), (802, None, 1.0), (803, None, 2.0)], "i long, g string, x double")


def ends(df):
    return {r.g: (r.n, r.ci_low, r.ci_high) for r in df.collect()}


@pytest.mark.parametrize("portable", [False, True])
def test_same_under_any_partitioning(rows, portable):
    how = explore.Bootstrap(("i",), 100, portable=portable)
    first = ends(explore.mean_by(rows.repartition(1), ["g"], "x", "bootstrap", how))
    other = ends(explore.mean_by(rows.repartition(13, F.rand(5)), ["g"], "x", "bootstrap", how))
    assert first.keys() == other.keys() == {"a", "b", "one", None}
    for g in first:
        assert first[g] == pytest.approx(other[g], rel=1e-12)


def test_weights_are_poisson_and_independent(rows):
    means = explore.bootstrap_means(rows.withColumn("x", F.lit(1.0)), ["g"], "x", explore.Bootstrap(("i",), 50))
    assert {r["mean"] for r in means.collect()} == {1.0}
    assert len(explore.WEIGHT_LIMITS) == 12
    assert explore.WEIGHT_LIMITS[0] / explore.MODULUS == pytest.approx(math.exp(-1), abs=1e-9)


def test_near_plain_resampling(rows):
    got = ends(explore.mean_by(rows, ["g"], "x", "bootstrap", explore.Bootstrap(("i",), 1000)))
    for g in ("a", "b"):
        x = np.array([r.x for r in rows.filter(F.col("g") == g).collect()])
        draws = np.random.default_rng(1).choice(x, (4000, len(x))).mean(1)
        low, high = np.quantile(draws, [0.025, 0.975])
        assert got[g][1] == pytest.approx(low, abs=0.15 * (high - low))
        assert got[g][2] == pytest.approx(high, abs=0.15 * (high - low))
    assert got["one"] == (1, 5.0, 5.0)


def test_seed_and_level(rows):
    base, other = (ends(explore.mean_by(rows, ["g"], "x", "bootstrap", explore.Bootstrap(("i",), 50, seed=s))) for s in (1, 2))
    assert base["a"] != other["a"]
    narrow = ends(explore.mean_by(rows, ["g"], "x", "bootstrap", explore.Bootstrap(("i",), 50, level=0.5, seed=1)))
    assert base["a"][1] < narrow["a"][1] < narrow["a"][2] < base["a"][2]


def test_unknown_interval(rows):
    with pytest.raises(ValueError, match="interval"):
        explore.mean_by(rows, ["g"], "x", "exact")


def test_all_columns_are_the_default_row_key(rows):
    assert len(ends(explore.mean_by(rows, ["g"], "x", "bootstrap", explore.Bootstrap(replicates=20)))) == 4
