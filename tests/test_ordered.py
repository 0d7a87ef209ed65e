"""Ordered operators against brute force, with and without cut keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from racecast import session
from racecast.operators import ordered as O
from racecast.operators.features import experience, position_change, win_rate_as_of

SPLITS = [O.DEFAULT_SPLIT, O.Split(rows_per_segment=40, sampled=8), O.Split(3, 3), O.Split(20, 4, broadcast_cuts=0)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, NULL keys, NULL values, ties in t."""
    rnd = random.Random(5)
    rows = []
    for i in range(1500):
        key = 0 if i % 3 == 0 else (None if i % 50 == 1 else rnd.randrange(1, 60))
        rows.append((i, key, rnd.randrange(400), rnd.choice([None, 1, 2, 3, 4, 5])))
    return spark.createDataFrame(rows, "id int, k int, t int, v int").repartition(7)


def as_set(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("split", SPLITS)
def test_previous_value(skewed, split):
    plain = skewed.withColumn("p", F.lag("v", 1).over(Window.partitionBy("k").orderBy("t", "id")))
    got = O.previous_value(skewed, ["k"], ["t", "id"], "v", "p", split)
    assert as_set(got, "id", "k", "t", "v", "p") == as_set(plain, "id", "k", "t", "v", "p")
    assert got.columns == [*skewed.columns, "p"]


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_total(skewed, split, keys):
    per = skewed.groupBy(*keys, "t").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy(*keys).orderBy("t")
    plain = per.withColumns({"cum_s": F.sum("s").over(over), "cum_n": F.sum("n").over(over)})
    got = O.running_total(skewed, keys, ["t"], {"s": "v", "n": F.lit(1)}, split)
    columns = [*keys, "t", "s", "n", "cum_s", "cum_n"]
    assert as_set(got, *columns) == as_set(plain, *columns)


@pytest.mark.parametrize("split", SPLITS)
def test_experience(skewed, split):
    over = Window.partitionBy("k").orderBy("t")
    plain = skewed.withColumn("e", F.count("t").over(over))
    got = experience(skewed, "k", "t", "e", split)
    assert as_set(got, "id", "k", "t", "e") == as_set(plain, "id", "k", "t", "e")


def segment_sizes(df, keys, order, split):
    cuts = O.find_cuts(df, keys, order, split)
    tagged = O.with_segments(df.select(*keys, *order).distinct(), keys, order, cuts)
    return [r["count"] for r in tagged.groupBy(*keys, O.SEG).count().collect()]


def test_cuts_are_found_and_repeatable(skewed):
    split = O.Split(rows_per_segment=50, sampled=10)
    cuts = O.cut_points(skewed, ["k"], ["t", "id"], split)
    assert {r.k for r in cuts.collect()} == {0}
    again = O.cut_points(skewed.repartition(3), ["k"], ["t", "id"], split)
    assert as_set(cuts, *cuts.columns) == as_set(again, *again.columns)
    sizes = segment_sizes(skewed.filter("k = 0"), ["k"], ["t", "id"], split)
    assert len(sizes) == cuts.count() and sum(sizes) == skewed.filter("k = 0").count()


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_a_task_sorts_as_many_rows_whatever_the_table(spark, n):
    """A third of the rows on one key; the largest sort does not grow with the table."""
    df = spark.range(n).select((F.col("id") % 3).alias("m"), "id")
    df = df.select(F.when(F.col("m") == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    sizes = segment_sizes(df, ["k"], ["t"], O.Split(rows_per_segment=1_600, sampled=64))
    assert max(sizes) < 2 * 1_600


def test_ties_are_counted_before_the_sort(spark):
    """Forty rows for each (key, event): what is sorted are the events, cut where they are too many."""
    df = spark.range(80_000).select(F.lit(1).alias("k"), F.floor(F.col("id") / 40).alias("t"))
    split = O.Split(rows_per_segment=200, sampled=20)
    assert max(segment_sizes(df, ["k"], ["t"], split)) < 2 * 200
    got = experience(df, "k", "t", split=split).groupBy("t").agg(F.min("experience").alias("a"), F.max("experience").alias("b"))
    assert got.filter("a <> (t + 1) * 40 or b <> a").count() == 0 and got.count() == 2_000


def test_light_tables_take_the_plain_window(skewed):
    text = O.previous_value(skewed, ["k"], ["t", "id"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and text.count("Window") == 1


@pytest.mark.parametrize("shared", [True, False])
def test_intermediates_are_dropped(spark, skewed, tmp_path, monkeypatch, shared):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path) if shared else None)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with session.intermediates():
        got = O.previous_value(skewed, ["k"], ["t", "id"], "v", split=O.Split(20, 4))
        assert got.count() == 1500
        assert bool(list(tmp_path.rglob("*.parquet"))) == shared
    assert not list(tmp_path.rglob("*.parquet"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_experience_counts_peers(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 3)], "d int, r int")
    assert sorted(r.experience for r in experience(df, "d", "r").collect()) == [1, 3, 3, 4]


def test_position_change_is_per_race(spark):
    laps = [(1, 9, 1, 5), (1, 9, 2, 4), (2, 9, 1, 7), (2, 9, 2, 9)]
    df = spark.createDataFrame(laps, "race int, driver int, lap int, pos int")
    got = position_change(df, ["race", "driver"], ["lap"], "pos")
    assert as_set(got, "race", "lap", "position_change") == [(1, 1, -1), (1, 2, 1), (2, 1, -1), (2, 2, -2)]


@pytest.mark.parametrize("split", SPLITS)
def test_win_rate_as_of(skewed, split):
    rows = [tuple(r) for r in skewed.filter("k is not null").select("k", "t", "v").collect()]
    want = []
    for k, t in sorted({(k, t) for k, t, _ in rows}):
        races = len({u for j, u, _ in rows if j == k and u < t})
        wins = sum(v == 1 for j, u, v in rows if j == k and u < t)
        want.append((k, t, wins, races))
    got = win_rate_as_of(skewed.filter("k is not null"), "k", "t", F.col("v") == 1, split)
    assert sorted(map(tuple, got.select("k", "t", "wins_before", "races_before").collect())) == want
