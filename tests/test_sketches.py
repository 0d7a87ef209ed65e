"""Sketches of parts, united, against exact answers over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from racecast.operators import explore, quality, sketches


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = [
        (i % 5, rng.randint(1, 20_000), f"name {rng.randint(1, 300)}", rng.choice("ab"), rng.gauss(0, 1) if i % 50 else None)
        for i in range(30_000)
    ]
    return spark.createDataFrame(data, "part int, many long, few string, g string, x double")


def test_distinct_counts_of_united_parts(rows):
    kept = sketches.distinct_sketches(rows, by=["part"])
    assert kept.count() == 5 * 4
    got = {r.column_name: (r.n, r.n_distinct) for r in sketches.distinct_estimates(sketches.united(kept)).collect()}
    exact = {r.column_name: r.n_distinct for r in quality.cardinality(rows.drop("part")).collect()}
    known = {c: rows.filter(F.col(c).isNotNull()).count() for c in exact}
    assert {c: n for c, (n, _) in got.items()} == known
    for c, n in exact.items():
        assert got[c][1] == pytest.approx(n, rel=3 * sketches.DISTINCT_ERROR, abs=1)


def test_union_is_the_sketch_of_all_rows(rows):
    parts = sketches.distinct_estimates(sketches.united(sketches.distinct_sketches(rows, ["many"], ["part"]))).first()
    whole = sketches.distinct_estimates(sketches.distinct_sketches(rows, ["many"])).first()
    assert parts.n_distinct == pytest.approx(whole.n_distinct, rel=sketches.DISTINCT_ERROR)


def test_one_pass_over_all_columns(rows):
    plan = sketches.distinct_sketches(rows.select("many", "few", "x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Expand" not in plan


def test_quartiles_of_two_halves(rows):
    kept = sketches.quantile_sketches(rows.withColumn("half", F.col("part") < 2), "g", "x", ["half"])
    got = {r.g: r for r in sketches.sketched_quartiles(sketches.united_quantiles(kept, "g"), "g").collect()}
    exact = {r.g: r for r in explore.quartiles(rows, "g", "x").collect()}
    assert got.keys() == exact.keys()
    for g, r in got.items():
        values = sorted(v.x for v in rows.filter((F.col("g") == g) & F.col("x").isNotNull()).collect())
        assert (r.n, r.low, r.high) == (len(values), values[0], values[-1]) == (exact[g].n, exact[g].low, exact[g].high)
        for name, share in explore.QUARTILES.items():
            below = sum(v < r[name] for v in values) / len(values)
            assert abs(below - share) <= sketches.RANK_ERROR


def test_empty_table(rows):
    none = rows.limit(0)
    assert sketches.quantile_sketches(none, "g", "x").count() == 0
    got = sketches.distinct_estimates(sketches.united(sketches.distinct_sketches(none, ["few"], ["part"])))
    assert got.count() == 0
