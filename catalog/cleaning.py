"""Queries over missing values, outliers, encoding, date parts and scaling (M, O, E, D, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import EXTREMES, GAPS, events_extremes, events_gaps, query, r, rounded, sql_time, table, text_time
from tablelab.operators import dates, encode, missing, outliers, scale

FILL_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _filled(spark, sf, strategy, columns=("user_id", "event_type", "value"), **options):
    gaps = events_gaps(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    out = missing.fill_missing(gaps, strategy, list(columns), **options)
    return rounded(out.select(*FILL_COLUMNS))


def _fill_sql(user_id, event_type, value):
    return f"""WITH {GAPS} SELECT event_id, round(CAST({user_id} AS DOUBLE), 6) + 0.0 AS user_id, {event_type} AS event_type,
    round({value}, 6) + 0.0 AS value FROM gaps"""


@query("m01_fill_mean", _fill_sql("coalesce(user_id, (SELECT avg(user_id) FROM gaps))", "event_type", "coalesce(value, (SELECT avg(value) FROM gaps))"))
def m01(spark, sf):
    return _filled(spark, sf, "mean")


@query("m02_fill_median", _fill_sql("coalesce(CAST(user_id AS DOUBLE), (SELECT quantile_cont(user_id, 0.5) FROM gaps))", "event_type", "coalesce(value, (SELECT quantile_cont(value, 0.5) FROM gaps))"))
def m02(spark, sf):
    return _filled(spark, sf, "median")


def _mode(column):
    return f"(SELECT {column} FROM gaps WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"


@query(
    "m03_fill_mode",
    f"WITH {GAPS} SELECT event_id, coalesce(user_id, {_mode('user_id')}) AS user_id, coalesce(event_type, {_mode('event_type')}) AS event_type, round(coalesce(value, {_mode('value')}), 6) + 0.0 AS value FROM gaps",
)
def m03(spark, sf):
    return _filled(spark, sf, "mode")


def _last(column, order):
    return f"last_value({column} IGNORE NULLS) OVER (ORDER BY event_id {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _ordered_sql(order):
    return f"""WITH {GAPS} SELECT event_id, {_last('user_id', order)} AS user_id, {_last('event_type', order)} AS event_type,
    round({_last('value', order)}, 6) + 0.0 AS value FROM gaps"""


@query("m04_fill_forward", _ordered_sql("ASC"))
def m04(spark, sf):
    return _filled(spark, sf, "ffill", order_by=["event_id"])


@query("m05_fill_backward", _ordered_sql("DESC"))
def m05(spark, sf):
    return _filled(spark, sf, "bfill", order_by=["event_id"])


@query(
    "m04_fill_forward_per_user",
    """SELECT event_id, user_id, round(last_value(CASE WHEN event_id % 20 <> 0 THEN value END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) + 0.0 AS value FROM events""",
)
def m04_user(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 20 != 0, F.col("value")).alias("value"))
    filled = missing.fill_missing(e, "ffill", ["value"], order_by=["ts", "event_id"], partition_by=["user_id"])
    return rounded(filled.drop("ts"))


# The same in many range buckets, the plan of large tables.
@query("m04_fill_forward_buckets", _ordered_sql("ASC"))
def m04_buckets(spark, sf):
    return _filled(spark, sf, "ffill", order_by=["event_id"], rows_per_bucket=100)


@query("m05_fill_backward_buckets", _ordered_sql("DESC"))
def m05_buckets(spark, sf):
    return _filled(spark, sf, "bfill", order_by=["event_id"], rows_per_bucket=100)


@query(
    "m06_fill_zero",
    f"WITH {GAPS} SELECT event_id, coalesce(user_id, 0) AS user_id, event_type, round(coalesce(value, 0), 6) + 0.0 AS value FROM gaps",
)
def m06(spark, sf):
    return _filled(spark, sf, "zero")


@query(
    "m07_fill_constant",
    f"WITH {GAPS} SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, coalesce(event_type, 'unknown') AS event_type, round(value, 6) + 0.0 AS value FROM gaps",
)
def m07(spark, sf):
    filled = _filled(spark, sf, "constant", constant_value="unknown")
    return filled.withColumn("user_id", F.col("user_id").cast("double"))


AUTO = f"""WITH {GAPS},
timed AS (SELECT event_id, coalesce({_last('ts', 'ASC')}, {_last('ts', 'DESC')}) AS ts, user_id, event_type, value FROM gaps),
alive AS (SELECT * FROM timed WHERE user_id IS NOT NULL)
SELECT event_id, {sql_time('ts', 'ts')}, user_id,
 coalesce(event_type, (SELECT event_type FROM alive WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type,
 round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM alive)), 6) + 0.0 AS value FROM alive"""


@query("m08_fill_auto", AUTO)
def m08(spark, sf):
    filled = missing.fill_missing(events_gaps(spark, sf), "auto", order_by=["event_id"])
    return rounded(filled.withColumn("ts", text_time("ts")))


@query("m09_fill_datetime", f"WITH {GAPS} SELECT event_id, strftime(coalesce({_last('ts', 'ASC')}, {_last('ts', 'DESC')}), '%Y-%m-%d %H:%M:%S') AS ts FROM gaps")
def m09(spark, sf):
    gaps = events_gaps(spark, sf).select("event_id", "ts")
    return missing.fill_datetime(gaps, ["ts"], ["event_id"]).withColumn("ts", text_time("ts"))


@query(
    "m10_missing_report",
    f"""WITH {GAPS}, alive AS (SELECT * FROM gaps WHERE user_id IS NOT NULL)
    SELECT 'ts' AS "column", 'ffill_bfill' AS strategy, CAST(NULL AS VARCHAR) AS fill_value, count(*) - count(ts) AS missing_before, 0.0::DOUBLE AS missing_after FROM gaps
    UNION ALL SELECT 'user_id', 'drop_rows', NULL, count(*) - count(user_id), 0 FROM gaps
    UNION ALL SELECT 'event_type', 'mode', (SELECT event_type FROM alive WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1), count(*) - count(event_type), 0 FROM alive
    UNION ALL SELECT 'value', 'median', CAST(round((SELECT quantile_cont(value, 0.5) FROM alive), 6) AS VARCHAR), count(*) - count(value), 0 FROM alive
    UNION ALL SELECT 'props', 'drop_column', NULL, count(*) - count(props), NULL FROM alive""",
)
def m10(spark, sf):
    gaps = events_gaps(spark, sf)
    rules = missing.fit_fill(gaps, "auto")
    for rule in rules:
        if isinstance(rule.fill_value, float):
            rule.fill_value = round(rule.fill_value, 6)
    report = missing.missing_report(gaps, missing.apply_fill(gaps, rules, order_by=["event_id"]), rules)
    return report.withColumn("missing_after", F.col("missing_after").cast("double"))


# ---- outliers

NUMBERS = ["user_id", "value"]


def _iqr(column, k=1.5, source="extremes"):
    q1, q3 = (f"(SELECT quantile_cont({column}, {p}) FROM {source})" for p in (0.25, 0.75))
    return f"({q1} - {k} * ({q3} - {q1}))", f"({q3} + {k} * ({q3} - {q1}))", q1, q3


def _iqr_rows(columns, source="extremes"):
    rows = []
    for c in columns:
        lo, hi, q1, q3 = _iqr(c, source=source)
        hit = f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})"
        rows.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, {hit} AS outliers, {r(f'{hit} / count({c}) * 100', 'percent')}, {r(lo, 'lower')}, "
            f"{r(hi, 'upper')}, {r(q1, 'q1')}, {r(q3, 'q3')} FROM {source}"
        )
    return " UNION ALL ".join(rows)


@query("o01_detect_iqr", f"WITH {EXTREMES} SELECT * FROM ({_iqr_rows(NUMBERS)}) WHERE outliers > 0")
def o01(spark, sf):
    rows = events_extremes(spark, sf)
    found = outliers.reported(outliers.detect(rows, NUMBERS, "iqr"))
    return rounded(outliers.detection_table(rows, found).select("column", "n", "outliers", "percent", "lower", "upper", "q1", "q3"))


def _z(column):
    mean, std = f"(SELECT avg({column}) FROM extremes)", f"(SELECT stddev_samp({column}) FROM extremes)"
    return f"abs(({column} - {mean}) / {std})", mean, std


def _z_rows():
    rows = []
    for c in NUMBERS:
        z, mean, std = _z(c)
        hit = f"count(*) FILTER (WHERE {z} > 3)"
        rows.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, {hit} AS outliers, {r(f'{hit} / count({c}) * 100', 'percent')}, {r(mean, 'mean')}, {r(std, 'std')}, {r(f'max({z})', 'max_z')} FROM extremes"
        )
    return " UNION ALL ".join(rows)


@query("o02_detect_zscore", f"WITH {EXTREMES} SELECT * FROM ({_z_rows()}) WHERE outliers > 0")
def o02(spark, sf):
    rows = events_extremes(spark, sf)
    found = outliers.reported(outliers.detect(rows, NUMBERS, "zscore"))
    return rounded(outliers.detection_table(rows, found).select("column", "n", "outliers", "percent", "mean", "std", "max_z"))


@query("o03_detect_isolation")
def o03(spark, sf):
    rows = events_extremes(spark, sf)
    found = outliers.detect(rows, ["value"], "isolation_forest", key=["event_id"])
    return outliers.detection_table(rows, found).select(
        "column", "method", "n", "outliers", "percent", "score_min", "score_max", "score_mean", "score_std"
    )


LO, HI, _, _ = _iqr("value")


@query("o04_outlier_rows", f"WITH {EXTREMES} SELECT event_id, 'value' AS \"column\", round(value, 6) + 0.0 AS value FROM extremes WHERE value < {LO} OR value > {HI}")
def o04(spark, sf):
    rows = events_extremes(spark, sf)
    return rounded(outliers.outlier_rows(rows, outliers.detect(rows, NUMBERS, "iqr"), ["event_id"]))


def _treated(spark, sf, treatment, method="iqr", **options):
    rows = events_extremes(spark, sf)
    return rounded(outliers.handle_outliers(rows, NUMBERS, method, treatment, key=["event_id"], **options).drop("event_type"))


@query("o05_treat_remove", f"WITH {EXTREMES} SELECT event_id, user_id, round(value, 6) + 0.0 AS value FROM extremes WHERE NOT coalesce(value < {LO} OR value > {HI}, false)")
def o05(spark, sf):
    return _treated(spark, sf, "remove")


CAPPED = f"WITH {EXTREMES} SELECT event_id, user_id, round(CASE WHEN value < {{lo}} THEN {{lo}} WHEN value > {{hi}} THEN {{hi}} ELSE value END, 6) + 0.0 AS value FROM extremes"


@query("o06_treat_cap_iqr", CAPPED.format(lo=LO, hi=HI))
def o06(spark, sf):
    return _treated(spark, sf, "cap")


MEAN, STD = "(SELECT avg(value) FROM extremes)", "(SELECT stddev_samp(value) FROM extremes)"


@query("o07_treat_cap_zscore", CAPPED.format(lo=f"({MEAN} - 3 * {STD})", hi=f"({MEAN} + 3 * {STD})"))
def o07(spark, sf):
    return _treated(spark, sf, "cap", "zscore", threshold=2.5)


@query("o08_treat_cap_fallback", CAPPED.format(lo=LO, hi=HI))
def o08(spark, sf):
    rows = events_extremes(spark, sf)
    found = outliers.detect(rows, ["value"], "isolation_forest", key=["event_id"])
    return rounded(outliers.apply_treatment(rows, outliers.fit_treatment(rows, found, "cap")).drop("event_type"))


@query(
    "o09_treat_impute",
    f"WITH {EXTREMES} SELECT event_id, user_id, round(CASE WHEN value < {LO} OR value > {HI} THEN (SELECT quantile_cont(value, 0.5) FROM extremes) ELSE value END, 6) + 0.0 AS value FROM extremes",
)
def o09(spark, sf):
    return _treated(spark, sf, "impute")


@query(
    "o10_treat_log",
    f"WITH {EXTREMES} SELECT event_id, user_id, round(ln(value + (SELECT CASE WHEN min(value) <= 0 THEN abs(min(value)) + 1 ELSE 0 END FROM extremes)), 6) + 0.0 AS value FROM extremes",
)
def o10(spark, sf):
    return _treated(spark, sf, "transform")


@query(
    "o11_treat_sqrt",
    f"WITH {EXTREMES} SELECT event_id, user_id, round(sqrt(value + (SELECT CASE WHEN min(value) < 0 THEN abs(min(value)) + 1 ELSE 0 END FROM extremes)), 6) + 0.0 AS value FROM extremes",
)
def o11(spark, sf):
    return _treated(spark, sf, "transform", transform_method="sqrt")


@query(
    "o12_treat_auto",
    f"""WITH {EXTREMES}, share AS (SELECT count(*) FILTER (WHERE value < {LO} OR value > {HI}) / count(value) AS s FROM extremes)
    SELECT event_id, user_id, round(CASE WHEN s < 0.05 THEN CASE WHEN value < {LO} THEN {LO} WHEN value > {HI} THEN {HI} ELSE value END
    WHEN s < 0.15 THEN CASE WHEN value < {LO} OR value > {HI} THEN (SELECT quantile_cont(value, 0.5) FROM extremes) ELSE value END
    ELSE ln(value + (SELECT CASE WHEN min(value) <= 0 THEN abs(min(value)) + 1 ELSE 0 END FROM extremes)) END, 6) + 0.0 AS value FROM extremes, share""",
)
def o12(spark, sf):
    return _treated(spark, sf, "auto")


@query(
    "o13_handle_outliers",
    f"""WITH {EXTREMES}, found AS (SELECT * FROM ({_iqr_rows(NUMBERS)}) WHERE outliers > 0), total AS (SELECT count(*) AS rows FROM extremes),
    kept AS (SELECT count(*) AS rows FROM extremes WHERE NOT coalesce(value < {LO} OR value > {HI}, false))
    SELECT 'iqr' AS method, CAST(sum(outliers) AS BIGINT) AS total_outliers, count(*) AS columns_hit,
    round(sum(outliers) / (any_value(total.rows) * count(*)) * 100, 6) + 0.0 AS overall_percent, any_value(total.rows) AS rows_before,
    any_value(kept.rows) AS rows_after, any_value(total.rows) - any_value(kept.rows) AS rows_removed FROM found, total, kept""",
)
def o13(spark, sf):
    rows = events_extremes(spark, sf)
    found = outliers.detect(rows, NUMBERS, "auto", key=["event_id"])
    treated = outliers.apply_treatment(rows, outliers.fit_treatment(rows, found, "remove"))
    return rounded(outliers.outlier_summary(rows, found, rows.count(), treated.count()))


# ---- encoding

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "e01_one_hot",
    "SELECT c_custkey, "
    + ", ".join(f"coalesce(c_nationkey <> 3 AND c_mktsegment = '{s}', false) AS \"c_mktsegment_{s}\"" for s in SEGMENTS)
    + " FROM customer",
)
def e01(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment"))
    return encode.one_hot(c)


def _codes(column):
    return f"(SELECT {column} AS v, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS code FROM parts WHERE {column} IS NOT NULL GROUP BY {column})"


PARTS = "parts AS (SELECT p_partkey, p_name, p_type, CASE WHEN p_size % 7 <> 0 THEN p_brand END AS p_brand FROM part)"


def _parts(spark, sf):
    brand = F.when(F.col("p_size") % 7 != 0, F.col("p_brand")).alias("p_brand")
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_type", brand)


@query(
    "e02_label_encode",
    f"WITH {PARTS} SELECT p_partkey, n.code AS p_name, t.code AS p_type, CAST(b.code AS DOUBLE) AS p_brand FROM parts LEFT JOIN {_codes('p_name')} n ON p_name = n.v LEFT JOIN {_codes('p_type')} t ON p_type = t.v LEFT JOIN {_codes('p_brand')} b ON p_brand = b.v",
)
def e02(spark, sf):
    coded = encode.label_encode(_parts(spark, sf), order_by=["p_partkey"])
    return coded.withColumn("p_brand", F.col("p_brand").cast("double"))


@query(
    "e03_frequency_encode",
    f"""WITH {PARTS} SELECT p_partkey, p_name, p_type, round(CASE WHEN p_brand IS NOT NULL THEN count(p_brand) OVER (PARTITION BY p_brand) / (SELECT count(p_brand) FROM parts) END, 8) + 0.0 AS p_brand FROM parts""",
)
def e03(spark, sf):
    return rounded(encode.frequency_encode(_parts(spark, sf), ["p_brand"]), 8)


@query(
    "e04_encode_auto",
    f"WITH {PARTS} SELECT p_partkey, n.code AS p_name, CAST(b.code AS DOUBLE) AS p_brand, "
    + ", ".join(f"p_type = '{t}' AS \"p_type_{t}\"" for t in TYPES)
    + f" FROM parts LEFT JOIN {_codes('p_name')} n ON p_name = n.v LEFT JOIN {_codes('p_brand')} b ON p_brand = b.v",
)
def e04(spark, sf):
    coded = encode.encode(_parts(spark, sf), order_by=["p_partkey"])
    return coded.withColumn("p_brand", F.col("p_brand").cast("double"))


# ---- date parts

DATE_SQL = {
    "year": "CAST(year(o_orderdate) AS INTEGER)",
    "month": "CAST(month(o_orderdate) AS INTEGER)",
    "day": "CAST(day(o_orderdate) AS INTEGER)",
    "dayofweek": "CAST(isodow(o_orderdate) - 1 AS INTEGER)",
    "is_weekend": "CAST(isodow(o_orderdate) >= 6 AS INTEGER)",
    "is_month_start": "CAST(day(o_orderdate) = 1 AS INTEGER)",
    "is_month_end": "CAST(CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS INTEGER)",
}


def _date_query(position, part):
    @query(f"d0{position}_date_{part}", f"SELECT o_orderkey, {DATE_SQL[part]} AS o_orderdate_{part} FROM orders")
    def run(spark, sf):
        orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
        return dates.add_date_part(orders, "o_orderdate", part).drop("o_orderdate")

    return run


for _i, _part in enumerate(dates.PARTS, start=1):
    _date_query(_i, _part)


@query(
    "d08_date_features",
    "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS o_orderdate FROM orders) SELECT o_orderkey, "
    + ", ".join(f"CAST({f'coalesce({e}, 0)' if p.startswith('is_') else e} AS DOUBLE) AS o_orderdate_{p}" for p, e in DATE_SQL.items())
    + " FROM o",
)
def d08(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    parts = dates.date_features(orders).drop("o_orderdate")
    return parts.select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in parts.columns[1:]])


# ---- scaling

SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scale_sql(center, width):
    cells = ", ".join(
        f"round(({c} - {center.format(c=c)}) / {width.format(c=c)}, 6) + 0.0 AS {c}" for c in SCALED
    )
    return f"SELECT l_orderkey, l_linenumber, {cells}, CAST(0 AS DOUBLE) AS fixed FROM lineitem"


def _scaled(spark, sf, method):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *SCALED, F.lit(0.7).alias("fixed"))
    return rounded(scale.scale(lines, method, exclude=["l_orderkey", "l_linenumber"]))


@query("f01_scale_standard", _scale_sql("(SELECT avg({c}) FROM lineitem)", "(SELECT stddev_pop({c}) FROM lineitem)"))
def f01(spark, sf):
    scaled = _scaled(spark, sf, "standard")
    return scaled.withColumn("fixed", F.round("fixed", 6) + F.lit(0.0))


@query("f02_scale_minmax", _scale_sql("(SELECT min({c}) FROM lineitem)", "(SELECT max({c}) - min({c}) FROM lineitem)"))
def f02(spark, sf):
    return _scaled(spark, sf, "minmax")


@query(
    "f03_scale_robust",
    _scale_sql("(SELECT quantile_cont({c}, 0.5) FROM lineitem)", "(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM lineitem)"),
)
def f03(spark, sf):
    return _scaled(spark, sf, "robust")


@query(
    "f03_scale_parameters",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", 'robust' AS method, {r(f'quantile_cont({c}, 0.5)', 'center')}, {r(f'quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)', 'scale')}, {r(f'min({c})', 'minimum')}, {r(f'max({c})', 'maximum')} FROM lineitem"
        for c in SCALED
    ),
)
def f03_parameters(spark, sf):
    lines = table(spark, sf, "lineitem").select(*SCALED)
    return rounded(scale.scale_table(lines, scale.fit_scale(lines, "robust")))
