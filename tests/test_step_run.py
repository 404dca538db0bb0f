"""The steps of a preparation, run and counted in one pass each."""

from pyspark.sql import functions as F

from tablelab.plans import prepare


def table(spark, n):
    rows = spark.range(n).repartition(4)
    return rows.select(
        "id",
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 101).cast("double")).alias("a"),
        F.when(F.col("id") % 5 == 0, float("nan")).otherwise((F.col("id") % 13).cast("double")).alias("b"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("c"),
    )


def test_run_equals_plan_and_audit(spark):
    df = table(spark, 700)
    prep = prepare.fit_preparation(df, ["id"], outlier_method="iqr")
    out, audit = prepare.run_steps(df, prep)
    assert sorted(map(str, out.collect())) == sorted(map(str, prep.transform(df).collect()))
    rows = audit.orderBy("position").collect()
    names = ["position", "step", "rows_before", "rows_after", "cols_before", "cols_after", "nulls_after"]
    assert [tuple(r[n] for n in names) for r in rows] == [tuple(r) for r in prepare.step_audit(df, prep).orderBy("position").collect()]
    assert rows[0]["nulls_before"] == 100 + 140 and rows[0]["nulls_after"] == 0
    assert set(rows[0]["details"]) == {"a", "b"} and set(rows[2]["details"]) == {"c"}
    assert all(r["columns_treated"] == len(r["details"]) for r in rows)
    assert rows[0]["seconds"] > 0 and rows[3]["seconds"] == 0


def test_steps_without_rules_and_empty_table(spark):
    df = table(spark, 50)
    idle = prepare.fit_preparation(df, ["id"], missing=None, outlier_treatment=None, encode=None, dates=False, scale=None)
    out, audit = prepare.run_steps(df, idle)
    assert out.count() == 50 and {r["seconds"] for r in audit.where("position > 2").collect()} == {0.0}
    assert {r["nulls_after"] for r in audit.collect()} == {8 + 10}
    _, audit = prepare.run_steps(df.limit(0), idle)
    assert [(r["rows_before"], r["rows_after"], r["nulls_after"]) for r in audit.collect()] == [(0, 0, 0)] * 5
