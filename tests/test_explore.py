"""Profiles and exploration tables against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from racecast.operators import dataset, explore, quality
from racecast.operators.ordered import DEFAULT_SPLIT, Split

SPLITS = [DEFAULT_SPLIT, Split(rows_per_segment=20, sampled=4)]


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        group = "hot" if i % 3 else rnd.choice(["a", "b", None])
        value = None if i % 40 == 0 else float("nan") if i % 41 == 0 else round(rnd.gauss(50, 20), 1)
        rows.append((i, group, value))
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(5)


def by_group(numbers):
    groups = {}
    for r in numbers.collect():
        if r.v is not None and not math.isnan(r.v):
            groups.setdefault(r.g, []).append(r.v)
    return groups


@pytest.mark.parametrize("split", SPLITS)
def test_box_stats(numbers, split):
    got = {r.g: r for r in explore.box_stats(numbers, "g", "v", split=split).collect()}
    want = by_group(numbers)
    assert set(got) == set(want)
    for g, values in want.items():
        v = np.array(values)
        q1, median, q3 = np.percentile(v, [25, 50, 75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        r = got[g]
        assert (r.n, r.low, r.high, r.n_outliers) == (len(v), v.min(), v.max(), len(v) - len(inside))
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, median, q3))
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())


def test_sketched_quartiles(numbers):
    got = {r.g: r for r in explore.quartiles(numbers, "g", "v", exact=False).collect()}
    for g, values in by_group(numbers).items():
        assert got[g].n == len(values) and abs(got[g].median - np.median(values)) < 1
    assert {r.g for r in explore.box_stats(numbers, "g", "v", exact=False).collect()} == set(got)


@pytest.mark.parametrize("bins", [1, 7, 20])
def test_histogram(numbers, bins):
    values = sum(by_group(numbers).values(), [])
    counts, edges = np.histogram(values, bins)
    got = explore.histogram(numbers, "v", bins).orderBy("bin").collect()
    assert [r.n for r in got] == list(counts)
    assert [r.low for r in got] + [got[-1].high] == pytest.approx(list(edges))


def test_histogram_of_one_value_and_of_none(spark):
    one = explore.histogram(spark.createDataFrame([(4,), (4,)], "x int"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in one] == [0, 0, 2, 0] and (one[0].low, one[-1].high) == (3.5, 4.5)
    assert explore.histogram(spark.createDataFrame([(None,)], "x int"), "x").count() == 0


def test_density(numbers):
    values = np.array(sum(by_group(numbers).values(), []))
    h = values.std(ddof=1) * len(values) ** -0.2
    x = np.linspace(values.min(), values.max(), 30)
    want = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * math.sqrt(2 * math.pi))
    got = explore.density_grid(numbers, "v", 30).orderBy("x").collect()
    assert [r.x for r in got] == pytest.approx(list(x)) and [r.density for r in got] == pytest.approx(list(want))


def test_mean_by(numbers):
    got = {r.g: r for r in explore.mean_by(numbers, ["g"], "v").collect()}
    for g, values in by_group(numbers).items():
        assert (got[g].n, got[g].mean, got[g].stddev) == pytest.approx((len(values), np.mean(values), np.std(values, ddof=1)))


def test_ranking_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, 5)], "k int, n int")
    assert [r.k for r in explore.top_k(df, "n", 3, "k").collect()] == [3, 1, 4]
    assert [r.k for r in explore.ranked(df, "n", "k").collect()] == [3, 1, 4, 2]


def test_wins_and_points(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (2, 4, None), (None, 1, 9)], "d int, pos int, p int")
    won = F.col("pos") == 1
    got = sorted(map(tuple, explore.wins_and_points(df, "d", won, "p").collect()))
    assert got == [(1, 1, 8), (2, None, 0)]
    named = df.withColumn("name", F.lit("x"))
    assert list(map(tuple, explore.wins_by(named, "d", won, "name").collect())) == [(1, "x", 1)]


def test_value_and_pair_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (None, "a")], "x int, y string")
    assert list(map(tuple, explore.pair_counts(df, "x", "y").collect())) == [(1, "a", 2)]
    assert sorted(map(tuple, explore.value_counts(df, "y").collect())) == [("a", 3)]


def test_profiles(numbers):
    nulls = {r.column_name: r.n_null for r in quality.null_profile(numbers).collect()}
    values = by_group(numbers)
    assert nulls["v"] == 900 - sum(map(len, values.values())) and nulls["id"] == 0
    distinct = {r.column_name: r.n_distinct for r in quality.cardinality(numbers, ["id", "g"]).collect()}
    assert distinct == {"id": 900, "g": 3}
    rough = {r.column_name: r.n_distinct for r in quality.cardinality(numbers, ["id", "g"], approximate=True).collect()}
    assert rough["g"] == 3 and abs(rough["id"] - 900) < 100
    described = {r.column_name: r for r in quality.describe(numbers, ["id", "g"]).collect()}
    assert (described["id"].mean, described["id"].max_value, described["g"].max_text) == (449.5, 899.0, "hot")


def test_impute(spark):
    df = spark.createDataFrame([(1, 10, 1.0), (None, None, float("nan")), (3, 20, None), (4, 11, 2.0)], "z int, m int, d double")
    got = quality.impute(df, zero=["z"], mean=["m", "d"]).collect()
    assert [tuple(r) for r in got] == [(1, 10, 1.0), (0, 13, 1.5), (3, 20, 1.5), (4, 11, 2.0)]
    train = spark.createDataFrame([(100, 9.0)], "m int, d double")
    other = quality.impute(df, mean=["m"], means=quality.imputation_means(train, ["m"]))
    assert [r.m for r in other.collect()] == [10, 100, 20, 11]


def test_split_is_stable_and_complete(numbers):
    for portable in (False, True):
        train, test = dataset.split_by_hash(numbers, ["id"], portable=portable)
        ids = {r.id for r in train.collect()}
        assert ids == {r.id for r in dataset.split_by_hash(numbers.repartition(9), ["id"], portable=portable)[0].collect()}
        assert not ids & {r.id for r in test.collect()} and len(ids) + test.count() == 900
        assert 0.62 < len(ids) / 900 < 0.78
        sizes = {r.split: r.n for r in dataset.split_sizes(numbers, ["id"], portable=portable).collect()}
        assert sizes == {"train": len(ids), "test": 900 - len(ids)}


def test_base_table_keeps_entries_all_tables_know(spark):
    entries = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "r int, d int")
    laps = spark.createDataFrame([(1, 1, 9), (2, 1, 8)], "R int, D int, laps int")
    names = spark.createDataFrame([(1, "x"), (2, "y")], "d int, name string")
    base = dataset.base_table(entries, [(names, "d"), (laps, ["r", "d"])])
    assert base.columns == ["r", "d", "name", "laps"]
    assert sorted(map(tuple, base.collect())) == [(1, 1, "x", 9), (2, 1, "x", 8)]
    assert dataset.base_table(entries, [(laps, ["r", "d"])], how="left").count() == 3


def test_binned_density_is_within_its_bound(spark):
    import random

    rng = random.Random(6)
    values = [rng.gauss(0, 1) for _ in range(3000)] + [rng.expovariate(1) for _ in range(2000)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v is not None and v == v]
    for bins in (50, 400):
        exact = {round(r.x, 9): r.density for r in explore.density_grid(df, "x", 60, bandwidth=0.2).collect()}
        binned = {round(r.x, 9): r.density for r in explore.density_binned(df, "x", 60, bins, 0.2).collect()}
        bound = explore.binning_error((max(known) - min(known)) / bins, 0.2)
        assert exact.keys() == binned.keys()
        off = max(abs(exact[x] - binned[x]) for x in exact)
        assert 0 < off <= bound


def test_binned_density_has_one_row_a_bin(spark):
    df = spark.range(20_000).selectExpr("double(id) / 7 AS x")
    plan = explore.density_binned(df, "x", 10, 64)
    assert plan.count() == 10
    assert explore.density_binned(df.limit(0), "x").count() == 0


def test_cardinality_in_one_scan(spark):
    rows = [(1, 0.0, "a", b"\x80", None), (1, -0.0, "b", b"\x81", None), (2, 1.5, None, b"\x80", None), (None, 1.5, "a", None, None)]
    df = spark.createDataFrame(rows, "i int, x double, s string, b binary, n string")
    got = {r.column_name: r.n_distinct for r in quality.cardinality(df, one_scan=True).collect()}
    assert got == {r.column_name: r.n_distinct for r in quality.cardinality(df).collect()} == {"i": 2, "x": 2, "s": 2, "b": 2, "n": 0}
    text = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = quality.cardinality(text, one_scan=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
