"""Frequent keys and salted joins: results against plain joins, and how evenly tasks are loaded."""

import json
import os
import statistics
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from racecast.operators import features, skew

SHARP = skew.Skew(share=0.05)


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows has one key, a tenth has none, and many rows are copies."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(12_000).select(key.cast("int").alias("k"), (F.col("id") % 4).alias("v"))


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(400).select("id", F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name")).drop("id")


def as_set(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("how", skew.KEPT_LEFT)
def test_salted_join_equals_plain_join(rows, names, how):
    got = skew.salted_join(rows, names, ["k"], how, SHARP)
    want = rows.join(names, ["k"], how)
    assert got.columns == want.columns
    assert as_set(got) == as_set(want)


def test_null_safe(rows, spark):
    far = spark.createDataFrame([(None, "none"), (7, "seven")], "k int, name string")
    got = skew.salted_join(rows, far, ["k"], "left", SHARP, null_safe=True)
    want = rows.join(far.withColumnRenamed("k", "f"), F.col("k").eqNullSafe(F.col("f")), "left").drop("f")
    assert as_set(got) == as_set(want)


def test_other_joins_are_refused(rows, names):
    with pytest.raises(ValueError, match="left rows"):
        skew.salted_join(rows, names, ["k"], "full")


def test_heavy_keys_are_few_and_right(rows):
    found = skew.heavy_keys(rows, ["k"], SHARP)
    hashes = {r.h: r.k for r in rows.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert {hashes[h] for h, _ in found} == {7, None}
    assert skew.heavy_keys(rows.filter("k <> 7"), ["k"], SHARP) == []


def test_shares_too_small_for_the_sketch_are_refused(rows):
    with pytest.raises(ValueError, match="tracked"):
        skew.heavy_hitters(rows, ["k"], share=0.001, tracked=1_000)


def test_no_heavy_key_plans_the_plain_join(rows, names):
    even = rows.filter("k <> 7")
    plan = skew.salted_join(even, names, ["k"], "inner", SHARP)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan


def test_heavy_hitters_are_exact(rows):
    got = {r.k: r.n for r in skew.heavy_hitters(rows, ["k"], share=0.05).collect()}
    counts = {r.k: r["count"] for r in rows.groupBy("k").count().collect()}
    assert got == {k: n for k, n in counts.items() if n >= 0.05 * 12_000}


def test_empty_tables(rows, names):
    assert skew.salted_join(rows.limit(0), names, ["k"], "left", SHARP).count() == 0
    assert skew.heavy_hitters(rows.limit(0), ["k"]).count() == 0


def test_users_of_the_join(rows):
    for heavy in (None, SHARP):
        success = features.group_success(rows, "k", "v", 0, heavy=heavy)
        assert success.columns == ["k", "v", "group_success"]
    assert as_set(features.group_success(rows, "k", "v", 0, heavy=SHARP)) == as_set(features.group_success(rows, "k", "v", 0, heavy=None))
    got, want = (features.experience(rows, "k", "v", heavy=h) for h in (SHARP, None))
    assert got.columns == want.columns and as_set(got) == as_set(want)


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[2])
from pyspark.sql import SparkSession, functions as F
from racecast.operators import skew
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", "file://" + sys.argv[1]).config("spark.eventLog.rolling.enabled", "false")
    .config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "16")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1").config("spark.sql.adaptive.enabled", "false").getOrCreate())
key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 5000)
rows = spark.range(0, 300_000, 1, 200).select(key.alias("k"), F.lit("copy").alias("v"))
far = spark.range(-5000, 5000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
skew.salted_join(rows, far, ["k"], "inner").write.format("noop").mode("overwrite").save()
spark.stop()
"""


def task_sizes(folder):
    """Rows read from shuffles by each task of the stage that reads most, from Spark's event log."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", SCRIPT, str(folder), repo], check=True, timeout=300, capture_output=True)
    sizes = {}
    (log,) = os.listdir(folder)
    for line in open(f"{folder}/{log}"):
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            sizes.setdefault(event["Stage ID"], []).append(read)
    return max(sizes.values(), key=sum)


def test_no_task_reads_twice_the_median(tmp_path):
    """A third of the rows are copies of one row; the plain join would read them in one of its 16 tasks."""
    sizes = task_sizes(tmp_path)
    assert len(sizes) == 16 and sum(sizes) > 300_000
    assert max(sizes) <= 2 * statistics.median(sizes)


@pytest.mark.parametrize("heavy", [None, SHARP])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_merge_with_null_keys(spark, rows, how, heavy):
    from racecast.operators.dataset import base_table

    far = spark.createDataFrame([(None, "none"), (7, "seven"), (9999, "other")], "k int, name string")
    got = base_table(rows, [(far, "k")], how=how, heavy=heavy, null_safe=True)
    want = [(r.k, r.v, {None: "none", 7: "seven"}.get(r.k)) for r in rows.collect() if how == "left" or r.k in (None, 7)]
    assert got.columns == ["k", "v", "name"] and as_set(got) == sorted(map(repr, want))
    assert base_table(rows, [(far, "k")], how="inner").filter("k is null").count() == 0


def test_full_merge_with_null_keys_keeps_both_sides(spark):
    from racecast.operators.dataset import base_table

    one = spark.createDataFrame([(None, 1), (1, 2)], "k int, a int")
    two = spark.createDataFrame([(None, 3), (2, 4)], "k int, b int")
    got = {tuple(r) for r in base_table(one, [(two, "k")], how="full", null_safe=True).collect()}
    assert got == {(None, 1, 3), (1, 2, None), (2, None, 4)}
