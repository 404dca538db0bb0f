"""Queries over sources, projections and profiling (S, P, A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, r, rounded, sql_time, table, text_time, union_all
from tablelab.operators import profile, select
from tablelab.sources import files
from tablelab.session import scratch_path

PART_DDL = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
PART_NA = "SELECT p_partkey, p_name, p_brand, CASE WHEN p_size % 7 <> 0 THEN p_type END AS p_type, p_size, p_retailprice FROM part"


@query("s01_read_csv", PART_NA)
def s01(spark, sf):
    path = scratch_path(spark, "part") + ".csv"
    part = table(spark, sf, "part")
    files.write_csv(part.withColumn("p_type", F.when(F.col("p_size") % 7 == 0, "NA").otherwise(F.col("p_type"))), path)
    return files.read_table(spark, path, schema=PART_DDL)


@query("s02_read_json", PART_NA)
def s02(spark, sf):
    path = scratch_path(spark, "part") + ".json"
    part = table(spark, sf, "part")
    part.withColumn("p_type", F.when(F.col("p_size") % 7 != 0, F.col("p_type"))).write.json(path)
    return files.read_table(spark, path, schema=PART_DDL, lines=True)


@query("s03_write_csv", f"SELECT o_orderkey, o_orderstatus, o_totalprice, {sql_time('o_orderdate', 'o_orderdate')} FROM orders")
def s03(spark, sf):
    path = scratch_path(spark, "orders") + ".csv"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    files.write_csv(orders, path)
    back = files.read_csv(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz")
    return back.withColumn("o_orderdate", text_time("o_orderdate"))


@query("s04_write_json", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment FROM customer")
def s04(spark, sf):
    path = scratch_path(spark, "customer") + ".json"
    customer = table(spark, sf, "customer")
    files.write_json(customer.withColumn("c_mktsegment", F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment"))), path)
    return files.read_json(spark, path, customer.schema, lines=True)


@query("s05_write_predictions", 'SELECT vec_id, label AS "cluster", count(*) OVER (PARTITION BY label) AS size FROM embeddings')
def s05(spark, sf):
    path = scratch_path(spark, "labelled") + ".csv"
    labelled = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("prediction"))
    sizes = files.write_predictions(labelled, path)
    return files.read_csv(spark, path, "vec_id bigint, cluster int").join(sizes, "cluster").select("vec_id", "cluster", "size")


@query("p01_select_numeric", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def p01(spark, sf):
    return select.select_numeric(table(spark, sf, "lineitem"))


@query("p02_select_categorical", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def p02(spark, sf):
    return select.select_categorical(table(spark, sf, "part"), keep=["p_partkey"])


@query("p03_drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def p03(spark, sf):
    return select.drop_columns(table(spark, sf, "customer"), ["c_name", "not_there"])


@query("p04_split_target", "SELECT doc_id, lang, source, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def p04(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    features, target = select.split_target(rows, "quality", ["doc_id"])
    return features.join(target, "doc_id")


@query("p05_bool_to_int", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_totalprice > 200000 AS INTEGER) AS is_large FROM orders")
def p05(spark, sf):
    return select.model_inputs(table(spark, sf, "orders").withColumn("is_large", F.col("o_totalprice") > 200000))


@query("p06_parse_timestamp", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate FROM orders")
def p06(spark, sf):
    text = F.when(F.col("o_orderkey") % 10 == 0, "no date").otherwise(F.col("o_orderdate").cast("string"))
    orders = table(spark, sf, "orders").select("o_orderkey", text.alias("o_orderdate"))
    return select.parse_timestamp(orders, "o_orderdate").withColumn("o_orderdate", text_time("o_orderdate"))


def _scored_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


@query("p07_drop_null_rows", "SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def p07(spark, sf):
    return select.drop_null_rows(_scored_documents(spark, sf), ["quality"])


@query("p08_drop_sparse_columns", "SELECT event_id, user_id, value FROM events")
def p08(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "value", "props")
    return select.drop_sparse_columns(e.withColumn("props", F.when(F.col("event_id") % 10 == 0, F.col("props"))))


@query("p09_align_to_source", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(c_nationkey % 3 AS INTEGER) AS prediction FROM customer WHERE c_acctbal > 0")
def p09(spark, sf):
    source = table(spark, sf, "customer")
    kept = source.where(F.col("c_acctbal") > 0)
    labelled = kept.select("c_custkey", (F.col("c_nationkey") % 3).cast("int").alias("prediction"))
    return select.align_to_source(source, labelled, ["c_custkey"])


@query(
    "p10_sample_split",
    """SELECT CASE WHEN CAST('0x' || substr(md5('42|' || o_orderkey), 1, 7) AS BIGINT) < 0.2 * 268435456 THEN 'test' ELSE 'train' END AS side,
    count(*) AS n, round(avg(o_totalprice), 6) + 0.0 AS mean_price FROM orders GROUP BY 1""",
)
def p10(spark, sf):
    train, test = select.sample_split(table(spark, sf, "orders"), ["o_orderkey"])
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return rounded(sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean_price")))


@query("p11_group_filter", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'click'")
def p11(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return select.group_filter(e, "event_type", "click")


LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_TYPES = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]


def _shape_sql():
    kinds = [k for _, k in PART_TYPES]
    return union_all(
        f"SELECT '{c}' AS \"column\", {i} AS position, '{k}' AS type, (SELECT count(*) FROM part) AS n_rows, "
        f"{len(kinds)} AS n_columns, {kinds.count(k)} AS columns_of_type"
        for i, (c, k) in enumerate(PART_TYPES)
    )


@query("a01_table_shape", _shape_sql())
def a01(spark, sf):
    return profile.table_shape(table(spark, sf, "part"))


SCORED = "(SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"
SCORED_TYPES = [("doc_id", "bigint"), ("lang", "string"), ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]


def _missing_sql(source, types):
    total = " + ".join(f"(count(*) - count({c}))" for c, _ in types)
    return union_all(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"{r(f'(count(*) - count({c})) / count(*) * 100', 'percent', 2)}, '{k}' AS type, {total} AS total_missing FROM {source}"
        for c, k in types
    )


@query("a02_missing_stats", _missing_sql(SCORED, SCORED_TYPES))
def a02(spark, sf):
    return rounded(profile.missing_stats(_scored_documents(spark, sf)))


@query(
    "a02_most_missing",
    f'SELECT * FROM ({_missing_sql(SCORED, SCORED_TYPES)}) WHERE missing > 0 ORDER BY missing DESC, "column" LIMIT 5',
)
def a02_top(spark, sf):
    return rounded(profile.most_missing(_scored_documents(spark, sf)))


def _numeric_sql(source, columns, digits=6):
    parts = []
    for c in columns:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({x}) AS n, {r(f'avg({x})', 'mean', digits)}, {r(f'stddev_samp({x})', 'std', digits)}, "
            f"{r(f'min({x})', 'min', digits)}, {r(f'max({x})', 'max', digits)}, {r(f'quantile_cont({x}, 0.5)', 'median', digits)}, "
            f"{r(f'quantile_cont({x}, 0.25)', 'q1', digits)}, {r(f'quantile_cont({x}, 0.75)', 'q3', digits)}, "
            f"{r(f'skewness({x})', 'skew', digits)}, {r(f'kurtosis({x})', 'kurtosis', digits)}, "
            f"count(*) FILTER (WHERE {x} = 0) AS zeros, {r(f'count(*) FILTER (WHERE {x} = 0) / count({x}) * 100', 'zeros_percent', digits)} "
            f"FROM {source}"
        )
    return union_all(parts)


@query("a03_numeric_stats", _numeric_sql("lineitem", LINE_NUMBERS))
def a03(spark, sf):
    return rounded(profile.numeric_stats(table(spark, sf, "lineitem")))


def _categorical_sql(source, columns):
    return union_all(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_count, count(*) - count({c}) AS missing_count, "
        f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top_value, "
        f"(SELECT max(n) FROM (SELECT count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})) AS top_count, "
        f"round((SELECT max(n) FROM (SELECT count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})) / count({c}) * 100, 6) + 0.0 AS top_percent "
        f"FROM {source}"
        for c in columns
    )


PART_GAPS = "(SELECT p_name, p_brand, CASE WHEN p_size % 7 <> 0 THEN p_type END AS p_type FROM part)"


def _part_gaps(spark, sf):
    p_type = F.when(F.col("p_size") % 7 != 0, F.col("p_type")).alias("p_type")
    return table(spark, sf, "part").select("p_name", "p_brand", p_type)


@query("a04_categorical_stats", _categorical_sql(PART_GAPS, ["p_name", "p_brand", "p_type"]))
def a04(spark, sf):
    return rounded(profile.categorical_stats(_part_gaps(spark, sf)))


@query(
    "a05_top_values",
    union_all(
        f"(SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rank "
        f"FROM {PART_GAPS} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 10)"
        for c in ["p_name", "p_brand", "p_type"]
    ),
)
def a05(spark, sf):
    return profile.top_values(_part_gaps(spark, sf))


DOUBLED = "(SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 50 = 0)"


def _doubled(spark, sf):
    c = table(spark, sf, "customer")
    return c.unionByName(c.where(F.col("c_custkey") % 50 == 0))


@query(
    "a06_duplicate_stats",
    f"""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, {r('sum(n - 1) / sum(n) * 100', 'duplicate_percent')}
    FROM (SELECT count(*) AS n FROM {DOUBLED} GROUP BY ALL)""".replace("SELECT count(*) AS n FROM", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, count(*) AS n FROM"),
)
def a06(spark, sf):
    return rounded(profile.duplicate_stats(_doubled(spark, sf)))


@query(
    "a07_duplicate_rows",
    """SELECT event_id, user_id, event_type FROM (SELECT event_id, user_id, event_type,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn > 1""",
)
def a07(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return profile.duplicate_rows(e, ["event_id"])


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *CORRELATED]


def _correlation_sql():
    parts = []
    for i, a in enumerate(NUMBERS):
        for j, b in enumerate(NUMBERS):
            value = f"corr({a}, {b})" if i != j else "avg(1.0)"
            high = f"abs({value}) > 0.8" if i < j else "false"
            parts.append(f"SELECT '{a}' AS col1, '{b}' AS col2, {r(value, 'correlation')}, {high} AS is_high FROM {LINE_GAPS}")
    return union_all(parts)


LINE_GAPS = "(SELECT * REPLACE (CASE WHEN l_linenumber <> 7 THEN l_quantity END AS l_quantity, CASE WHEN l_suppkey % 9 <> 0 THEN l_extendedprice END AS l_extendedprice) FROM lineitem)"


@query("a08_correlation_matrix", _correlation_sql())
def a08(spark, sf):
    """All numeric columns, two of them with gaps."""
    rows = table(spark, sf, "lineitem").withColumns(
        {
            "l_quantity": F.when(F.col("l_linenumber") != 7, F.col("l_quantity")),
            "l_extendedprice": F.when(F.col("l_suppkey") % 9 != 0, F.col("l_extendedprice")),
        }
    )
    return rounded(profile.correlation_matrix(rows))


@query(
    "a08_correlation_wide",
    f"""WITH v AS (SELECT vec_id, embedding FROM embeddings), s AS (SELECT i, j,
    corr(CASE WHEN vec_id % 64 <> i THEN CAST(embedding[i + 1] AS DOUBLE) END, CASE WHEN vec_id % 64 <> j THEN CAST(embedding[j + 1] AS DOUBLE) END) AS c
    FROM v, range(64) AS a(i), range(64) AS b(j) GROUP BY i, j)
    SELECT 'e' || i AS col1, 'e' || j AS col2, {r('CASE WHEN i = j THEN 1.0 ELSE c END', 'correlation')}, i < j AND abs(c) > 0.8 AS is_high FROM s""",
)
def a08_wide(spark, sf):
    """All 64 components, each with gaps of its own: 2,080 pairs in one scan."""
    cells = [F.when(F.col("vec_id") % 64 != i, F.get("embedding", F.lit(i)).cast("double")).alias(f"e{i}") for i in range(64)]
    return rounded(profile.correlation_matrix(table(spark, sf, "embeddings").select(*cells)))


def _histogram_sql(source, columns, bins=30):
    return union_all(
        f"""SELECT '{c}' AS "column", CAST(b AS INTEGER) AS bin, round(lo + (hi - lo) * b / {bins}, 6) + 0.0 AS "left", coalesce(n, 0) AS n,
        round(mean, 6) + 0.0 AS mean, round(median, 6) + 0.0 AS median FROM
        (SELECT min({c}) AS lo, max({c}) AS hi, avg({c}) AS mean, quantile_cont({c}, 0.5) AS median FROM {source}), range(0, {bins}) AS g(b)
        LEFT JOIN (SELECT least(floor(({c} - (SELECT min({c}) FROM {source})) / ((SELECT max({c}) FROM {source}) - (SELECT min({c}) FROM {source})) * {bins}), {bins - 1}) AS slot,
        count(*) AS n FROM {source} GROUP BY 1) ON slot = b"""
        for c in columns
    )


@query("a09_histogram", _histogram_sql("lineitem", CORRELATED))
def a09(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "lineitem").select(*CORRELATED)))


@query(
    "a10_density_curve",
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS w FROM events),
    g AS (SELECT b, lo + (hi - lo) * b / 199 AS x, n, w FROM s, range(0, 200) AS t(b))
    SELECT 'value' AS "column", CAST(b AS INTEGER) AS point, round(x, 6) + 0.0 AS x,
    round(sum(exp(-0.5 * ((x - value) / w) * ((x - value) / w))) / (any_value(n) * any_value(w) * sqrt(2 * pi())), 10) + 0.0 AS density
    FROM g, events GROUP BY b, x""",
)
def a10(spark, sf):
    curve = profile.density_curve(table(spark, sf, "events"), ["value"])
    return curve.withColumn("x", F.round("x", 6)).withColumn("density", F.round("density", 10) + F.lit(0.0))


def _box_sql(source, columns):
    parts = []
    for c in columns:
        q1, q3 = f"(SELECT quantile_cont({c}, 0.25) FROM {source})", f"(SELECT quantile_cont({c}, 0.75) FROM {source})"
        stats = [("min", f"min({c})"), ("q1", f"quantile_cont({c}, 0.25)"), ("median", f"quantile_cont({c}, 0.5)"), ("mean", f"avg({c})"),
                 ("q3", f"quantile_cont({c}, 0.75)"), ("max", f"max({c})"), ("iqr", f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")]
        parts.append(
            f"SELECT '{c}' AS \"column\", {', '.join(r(e, n) for n, e in stats)}, "
            f"count(*) FILTER (WHERE {c} < {q1} - 1.5 * ({q3} - {q1}) OR {c} > {q3} + 1.5 * ({q3} - {q1})) AS outliers FROM {source}"
        )
    return union_all(parts)


@query("a11_boxplot_stats", _box_sql("lineitem", CORRELATED))
def a11(spark, sf):
    return rounded(profile.boxplot_stats(table(spark, sf, "lineitem").select(*CORRELATED)))


@query("a12_scatter_sample", "SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)")
def a12(spark, sf):
    return profile.scatter_sample(_scored_documents(spark, sf))


@query(
    "a13_type_advice",
    union_all(
        [
            f"""SELECT '{c}' AS "column", CASE WHEN max({c}) < 256 THEN 'uint8' ELSE 'uint16' END AS advice, CAST(min({c}) AS DOUBLE) AS min,
            CAST(max({c}) AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS distinct_ratio FROM part HAVING min({c}) >= 0 AND max({c}) < 65535"""
            for c in ("p_partkey", "p_size", "p_retailprice")
        ]
        + [
            f"""SELECT '{c}' AS "column", 'dictionary' AS advice, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
            round(count(DISTINCT {c}) / count(*), 6) + 0.0 AS distinct_ratio FROM part HAVING count(DISTINCT {c}) / count(*) < 0.5"""
            for c in ("p_name", "p_brand", "p_type")
        ]
    ),
)
def a13(spark, sf):
    return rounded(profile.type_advice(table(spark, sf, "part")))


def _report_sql():
    def melt(section, label, metrics, source):
        casts = ", ".join(f'CAST("{m}" AS DOUBLE) AS "{m}"' for m in metrics)
        names = ", ".join(f'"{m}"' for m in metrics)
        return (
            f"SELECT '{section}' AS section, \"column\", metric, round(value, 6) + 0.0 AS value FROM "
            f'(SELECT {label} AS "column", {casts} FROM ({source})) UNPIVOT (value FOR metric IN ({names}))'
        )

    kinds = [("c_custkey", "bigint"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]
    shape = union_all(
        f"SELECT '{c}' AS \"column\", {i} AS position, (SELECT count(*) FROM customer) AS n_rows, 4 AS n_columns, 1 AS columns_of_type"
        for i, (c, _) in enumerate(kinds)
    )
    numbers = ["c_custkey", "c_nationkey", "c_acctbal"]
    advice = union_all(
        [f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS distinct_ratio FROM customer HAVING min({c}) >= 0 AND max({c}) < 65535" for c in numbers]
        + ["SELECT 'c_mktsegment' AS \"column\", CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, count(DISTINCT c_mktsegment) / count(*) AS distinct_ratio FROM customer HAVING count(DISTINCT c_mktsegment) / count(*) < 0.5"]
    )
    top = "SELECT 'c_mktsegment / ' || CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) AS VARCHAR) AS \"column\", count(*) AS n FROM customer GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment LIMIT 10"
    pairs = union_all(
        f"SELECT '{a} / {b}' AS \"column\", {f'corr({a}, {b})' if a != b else "avg(1.0)"} AS correlation FROM customer" for a in numbers for b in numbers
    )
    stats = ["n", "mean", "std", "min", "max", "median", "q1", "q3", "skew", "kurtosis", "zeros", "zeros_percent"]
    return union_all(
        [
            melt("shape", '"column"', ["position", "n_rows", "n_columns", "columns_of_type"], shape),
            melt("missing", '"column"', ["missing", "percent", "total_missing"], _missing_sql("customer", kinds)),
            melt("duplicates", "''", ["duplicate_rows", "duplicate_percent"], "SELECT 0 AS duplicate_rows, 0.0 AS duplicate_percent"),
            melt("types", '"column"', ["min", "max", "distinct_ratio"], advice),
            melt("numeric", '"column"', stats, _numeric_sql("customer", numbers, 9)),
            melt("categorical", '"column"', ["unique_count", "missing_count", "top_count", "top_percent"], _categorical_sql("customer", ["c_mktsegment"])),
            melt("top_values", '"column"', ["n"], top),
            melt("correlation", '"column"', ["correlation"], pairs),
        ]
    )


@query("a14_profile_report", _report_sql())
def a14(spark, sf):
    report = profile.profile_report(table(spark, sf, "customer"), ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    number = F.expr("try_cast(value AS double)")
    return rounded(report.withColumn("value", number).where(F.col("value").isNotNull()))
