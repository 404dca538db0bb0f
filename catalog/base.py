"""Registry of runnable queries and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.functions.columns import ref

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison; adding zero turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(ref(f.name), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def r(expression: str, name: str, digits: int = 6) -> str:
    """SQL twin of :func:`rounded` for one expression."""
    return f'round({expression}, {digits}) + 0.0 AS "{name}"'


def union_all(parts) -> str:
    return " UNION ALL ".join(parts)


def when_key(df: DataFrame, column: str, hit: Column, value: Column | None = None) -> Column:
    kept = F.when(~hit, ref(column))
    return (kept if value is None else kept.otherwise(value)).alias(column)


# Events with planted gaps: shares that reach every branch of the automatic fill.
def events_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        "event_id",
        when_key(e, "ts", k % 25 == 3),
        when_key(e, "user_id", k % 200 == 1),
        when_key(e, "event_type", k % 15 == 2),
        when_key(e, "value", k % 20 == 0),
        when_key(e, "props", k % 10 != 0),
    )


GAPS = """gaps AS (SELECT event_id,
 CASE WHEN event_id % 25 = 3 THEN NULL ELSE ts END AS ts,
 CASE WHEN event_id % 200 = 1 THEN NULL ELSE user_id END AS user_id,
 CASE WHEN event_id % 15 = 2 THEN NULL ELSE event_type END AS event_type,
 CASE WHEN event_id % 20 = 0 THEN NULL ELSE value END AS value,
 CASE WHEN event_id % 10 <> 0 THEN NULL ELSE props END AS props FROM events)"""


# Events with planted extremes.
def events_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    value = F.when(k % 250 == 0, F.col("value") * 100).when(k % 20 != 1, F.col("value"))
    return e.select("event_id", "event_type", F.col("user_id").cast("double").alias("user_id"), value.alias("value"))


EXTREMES = """extremes AS (SELECT event_id, event_type, CAST(user_id AS DOUBLE) AS user_id,
 CASE WHEN event_id % 250 = 0 THEN value * 100 WHEN event_id % 20 <> 1 THEN value END AS value FROM events)"""


def text_time(column: str) -> Column:
    return F.date_format(ref(column), "yyyy-MM-dd HH:mm:ss")


def sql_time(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"


# Customers with what they ordered: the input of the end-to-end segmentation.
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_quantity", "l_linestatus")
    paid = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    per_order = lines.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", paid).otherwise(0.0)).alias("spend_open"),
        F.sum(F.when(F.col("l_linestatus") == "F", paid).otherwise(0.0)).alias("spend_final"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_discount").alias("discounts"),
        F.count(F.lit(1)).alias("lines"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    per_customer = joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("total_price"),
        F.sum("spend_open").alias("spend_open"),
        F.sum("spend_final").alias("spend_final"),
        F.sum("quantity").alias("quantity"),
        (F.sum("discounts") / F.sum("lines")).alias("mean_discount"),
        F.max("o_orderdate").alias("last_order"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return customers.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


FEATURES = """per_order AS (SELECT l_orderkey,
 sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice * (1 - l_discount) ELSE 0.0 END) AS spend_open,
 sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice * (1 - l_discount) ELSE 0.0 END) AS spend_final,
 sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey),
features AS (SELECT c_custkey, c_mktsegment, c_acctbal, count(o_orderkey) AS n_orders, sum(o_totalprice) AS total_price,
 sum(spend_open) AS spend_open, sum(spend_final) AS spend_final, sum(quantity) AS quantity
 FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN per_order ON o_orderkey = l_orderkey
 GROUP BY c_custkey, c_mktsegment, c_acctbal)"""
