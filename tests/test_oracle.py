"""Every registered query against its SQL on the smallest test tables, and what its plan may hold."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import connect, difference

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))
HEAVY = {"q_model_report", "q_cross_validate", "q_race_model_report", "q_race_top_features", "q_best_model", "q_race_importance"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["o_custkey", "total_wins", "total_races", "win_rate"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, con, name):
    assert difference(spark, SF, con, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n not in HEAVY])
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(ORACLES) if n.startswith("q_")])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow", text)


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_scans_are_pruned_and_filtered(spark):
    text = formatted(QUERIES["q_filter_rows"](spark, SF))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThan(o_totalprice,100000.0)" in text
    assert "o_orderdate" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_win_rate_is_one_pruned_scan(spark):
    text = formatted(QUERIES["q_win_rate"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<(\S+)>", text)
    assert len(schemas) == 1 and len(schemas[0].split(",")) == 3


def test_direct_summary_of_single_order_column_needs_no_sort(spark):
    from racecast.operators.features import position_summary_direct

    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("p", F.floor("value").cast("int"))
    text = formatted(position_summary_direct(events, ["user_id"], ["event_id"], "p"))
    assert "HashAggregate" in text and "Sort" not in text and "Window" not in text
