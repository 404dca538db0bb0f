"""Registered queries of this subpackage and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.llm import decontaminate, exact_search, extract, language, licenses, neardup, packing, quality, secrets, spelling, toolcalls, toxicity, vector_codes
from tablelab.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


@query("op2_minhash_forest")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query("op4_tool_calls")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the table; user turns become calls, assistant turns their results."""
    return toolcalls.link(toolcalls.from_turns(table(spark, sf_dir, "conversations")), toolcalls.TURN_SCHEMAS)


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("found")


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


OP8_SQL = r"""
WITH w AS (SELECT doc_id, rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM (SELECT doc_id, text, row_number() OVER () AS rid FROM documents)),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_to_string(words[i:i + 9], ' ') AS win, least(len(words), 10) AS size FROM b,
  LATERAL (SELECT unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (SELECT doc_id, rid, i, size, array_to_string(words[i:i + size - 1], ' ') AS win FROM w, sizes,
  LATERAL (SELECT unnest(range(1, len(words) - size + 2)) AS i)),
found AS (SELECT rid, i, windows.size AS size, item_id FROM spots JOIN windows ON spots.win = windows.win AND spots.size = windows.size),
hit AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM found, LATERAL (SELECT unnest(range(size)) AS k) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""


@query("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spans=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


OP10_SQL = """
WITH v AS (SELECT vec_id, row_number() OVER () AS rid, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, q.rid AS qid, c.vec_id AS vec_id,
  CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.rid <> c.rid AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


@query("op10_exact_topk", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_k(table(spark, sf_dir, "embeddings"))


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).drop("difference")


def _op12_sql() -> str:
    """Codebooks b0 to b2 and the assignments a0 to a2, each from the one before."""

    def assigned(k: int) -> str:
        distance = "list_sum([z[1] * z[1] FOR z IN [[y[1] - y[2]] FOR y IN list_zip(p.p, b.p)]])"
        return f"""a{k} AS MATERIALIZED (SELECT rid, j, m.e AS e, m.d AS d FROM (SELECT rid, j, min({{'d': CAST({distance} AS BIGINT), 'e': e}}) AS m
  FROM p JOIN b{k} b USING (j) GROUP BY rid, j))"""

    def replaced(k: int) -> str:
        return f"""s{k} AS (SELECT j, e, i, sum(x) AS s, count(*) AS n FROM (SELECT a.j AS j, a.e AS e, unnest(p.p) AS x, unnest(range(len(p.p))) AS i
  FROM a{k - 1} a JOIN p ON p.rid = a.rid AND p.j = a.j) GROUP BY j, e, i),
m{k} AS (SELECT j, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS p FROM s{k} GROUP BY j, e),
b{k} AS MATERIALIZED (SELECT b.j AS j, b.e AS e, coalesce(m.p, b.p) AS p FROM b{k - 1} b LEFT JOIN m{k} m ON m.j = b.j AND m.e = b.e)"""

    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS rid, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT rid, j, v[j * (len(v) // 16) + 1:(j + 1) * (len(v) // 16)] AS p FROM v, LATERAL (SELECT unnest(range(16)) AS j)),
f AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM v),
b0 AS MATERIALIZED (SELECT j, e, p FROM f JOIN p USING (rid) WHERE e < 64),
{assigned(0)},
{replaced(1)},
{assigned(1)},
{replaced(2)},
{assigned(2)},
books AS (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY j, e)) AS sha FROM b2),
coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY j) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM v JOIN coded USING (rid), books"""


@query("op12_vector_codes", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


__all__ = ["F", "ORACLE", "QUERIES"]
