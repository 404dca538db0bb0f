"""Source rules that keep the operators distributed."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent
SOURCES = [*ROOT.glob("tablelab/**/*.py"), *ROOT.glob("catalog/*.py")]
FORBIDDEN = ["toPandas(", "localCheckpoint", "crossJoin", ".rdd", "toLocalIterator", "monotonically_increasing_id"]


@pytest.mark.parametrize("word", FORBIDDEN)
def test_no_driver_or_unstable_calls(word):
    assert [p.name for p in SOURCES if word in p.read_text()] == []


def test_no_row_at_a_time_python_functions():
    assert [p.name for p in SOURCES if re.search(r"F\.udf\(|@udf", p.read_text())] == []


def test_fill_and_outlier_plans_do_not_use_a_cross_join(spark):
    from tablelab.operators import missing

    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 5 = 0 THEN id END AS x")
    plan = missing.fill_missing(df, "ffill", ["x"], order_by=["id"], rows_per_bucket=500)._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"cluster", "size", "percent", "mean_value", "mean_spend", "mode"} <= set(rows[0].asDict())
