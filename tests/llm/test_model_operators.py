"""Language, tool calls, quality rules, exact search and the pipeline on small planted tables."""

import json
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tablelab.llm import exact_search, language, quality, toolcalls
from tablelab.llm.queries import ORACLE, QUERIES
from tests.oracle import DATA, connect, differences

SF = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


# ---- op3

WORDS = {"en": "the house and the garden of the town", "de": "das haus und der garten der stadt nicht", "fr": "la maison et le jardin de la ville"}


def test_language_of_pages(spark):
    training = spark.createDataFrame([(WORDS[k] + f" {i}", k) for k in WORDS for i in range(30)] + [(None, "en"), ("x", None)], "text string, lang string")
    page = "<html lang='{}'><body><p>{}</p></body></html>"
    rows = [(i, f"http://h{i % 3}.{k}.example.{k}/x", page.format(k, WORDS[k])) for i, k in enumerate(["en", "de", "fr"] * 10)]
    rows += [(100, "http://a.b.de/", page.format("en", WORDS["de"])), (101, None, WORDS["fr"]), (102, "no url", None), (103, "", "<p>12 34</p>"), (103, "", "<p>12 34</p>"), (None, "http://h1.de.example.de/", "<p>stadt</p>")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, lang_id string")
    got = language.identify_pages(pages, training).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(by[i].lang_id == k for i, k in enumerate(["en", "de", "fr"] * 10))
    assert by[100].lang_id == "de" and by[100].declared == "en" and by[101].lang_id == "fr" and by[None].lang_id == "de"
    assert by[102].lang_id is None and by[102].confidence == 0 and by[103].lang_id is None
    assert all(abs(sum(r.posterior.values()) - 1) < 1e-9 for r in got)
    assert language.identify_pages(pages.limit(0), training).count() == 0
    assert all(r.lang_id is None for r in language.identify_pages(pages, training.limit(0)).collect())


def test_evidence_decides_where_text_is_silent(spark):
    training = spark.createDataFrame([(WORDS[k], k) for k in WORDS for _ in range(20)], "text string, lang string")
    known = [(i, "http://site.example.de/x", f"<html lang=de><p>{WORDS['de']}") for i in range(60)] + [(i + 60, "http://other.example.com/", f"<html lang=en><p>{WORDS['en']}") for i in range(60)]
    pages = spark.createDataFrame([*known, (500, "http://site.example.de/y", "<p>zzzz"), (501, "http://other.example.com/y", "<p>zzzz")], "page_id long, url string, html string")
    by = {r.page_id: r for r in language.identify_pages(pages, training).collect()}
    assert by[500].lang_id == "de" and by[501].lang_id == "en"


def test_trigram_model_is_the_counted_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    languages, model = language.fit_text_model(docs)
    rows = docs.collect()
    want = np.full((len(languages), language.FEATURES), 0.5)
    for r in rows:
        code, _ = language.trigram_codes([r.text or ""])
        want[languages.index(r.lang)] += np.bincount(code, minlength=language.FEATURES + 1)[: language.FEATURES]
    want = np.log(want / want.sum(1, keepdims=True))
    assert np.allclose(model[:, :-1], want - want.mean(0), atol=1e-4)


# ---- op4

SCHEMAS = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": ["integer", "object"]}, "b": {"type": "number", "maximum": 5}}, "additionalProperties": False}}


def message(conv, turn, kind, call=None, name=None, args=None, content=None):
    return (conv, turn, kind, None, name, call, content, args, "extra", 1)


def test_more_languages_than_a_shard(spark):
    # The rarest of 70 languages keep their row.
    texts = [(f"{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + i % 7)}qx " * 12, f"l{i:02d}", "s") for i in range(70) for _ in range(1 if i in (3, 69) else 2)]
    docs = spark.createDataFrame(texts, "text string, lang string, source string")
    languages, model = language.fit_text_model(docs)
    assert languages == [f"l{i:02d}" for i in range(70)] and model.shape[0] == 70
    rows = language.with_evidence(docs, languages, model).collect()
    assert all(languages[int(np.argmax(r.evidence))] == r.lang and len(r.evidence) == 70 for r in rows)


def test_tool_calls(spark):
    rows = [
        message(1, 0, "message", content="hé \u0001"), message(1, 1, "call", "x", "add", '{"b": 2.0, "a": 1}'), message(1, 2, "result", "x", content="3"),
        message(2, 0, "call", "p", "add", '{"a": {"$ref": "q"}}'), message(2, 1, "call", "q", "add", '{"a": 1, "b": 9}'), message(2, 2, "result", "q", content="1"), message(2, 3, "result", "p"),
        message(3, 0, "call", "r", "add", '{"a": {"$ref": "s"}}'), message(3, 1, "call", "s", "add", '{"a": {"$ref": "r"}}'),
        message(4, 0, "call", "k", "none", "{"), message(4, 1, "call", "k", "add", '{"a": 1}'), message(4, 2, "result", "lone"), message(4, 3, "call", None, "add", '{"a": {"$ref": "gone"}}'),
        message(None, None, None), message(5, 1, "call", "m", "add", '{"a": {"$ref": "gone"}}'), message(6, 0, "result", "t"), message(6, 1, "call", "t", "add", '{"a": 1}'),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, kind string, role string, name string, call_id string, content string, arguments string, linked string, level int")
    by = {(r.conv_id, r.turn): r for r in toolcalls.link(table, SCHEMAS).collect()}
    assert len(by) == len(rows)
    assert by[1, 1].json == '{"role":"assistant","tool_calls":[{"function":{"arguments":{"a":1,"b":2},"name":"add"},"id":"x","type":"function"}]}'
    assert by[1, 0].json == '{"content":"hé \\u0001","role":null}' and by[1, 1].linked and by[1, 2].linked and by[1, 2].valid and by[1, 1].level == 0
    assert (by[2, 1].level, by[2, 0].level, by[2, 2].level, by[2, 3].level) == (0, 1, 0, 1)
    assert by[2, 1].errors == ["$.b: out of range"] and by[2, 0].valid and by[2, 0].linked
    assert "cycle" in by[3, 0].errors and by[3, 1].level is None
    assert "arguments are no JSON" in by[4, 0].errors or "unknown tool" in by[4, 0].errors
    assert by[4, 1].errors[0] == "repeated identifier" and by[4, 2].errors == ["no call"] and "no identifier" in by[4, 3].errors
    assert by[None, None].kind == "message" and "needed call is missing" in by[5, 1].errors and by[6, 0].errors == ["result before call"]
    assert all(toolcalls.canonical(json.loads(r.json)) == r.json for r in by.values())
    assert toolcalls.link(table.limit(0), SCHEMAS).count() == 0


def test_turns_of_the_table(spark):
    rows = QUERIES["op4_tool_calls"](spark, SF).collect()
    turns = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()}
    assert len(rows) == len(turns) and all(r.valid or r.errors for r in rows)
    for r in rows:
        turn, body = turns[r.conv_id, r.turn], json.loads(r.json)
        if turn.role == "user":
            given = body["tool_calls"][0]["function"]["arguments"]
            assert given["prompt"] == turn.text and r.linked == ((r.conv_id, r.turn + 1) in turns and turns[r.conv_id, r.turn + 1].role == "assistant")
        else:
            assert body["content"] == turn.text


# ---- op9


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    rows = QUERIES["op9_quality_rules"](spark, f"{DATA}/sf0.01").join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate([None, "", "a b", "A!! B!! " * 9000, "the text"])] + [(None, "x", "s"), (1, "", "s")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.classify(docs, quality.fit(docs, none)).collect()
    assert len(rows) == 7 and {r.score for r in rows} == {0.5} and {r.predicted for r in rows} == {1}
    one = spark.createDataFrame([(i, 1) for i in range(5)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert {r.predicted for r in quality.classify(docs, quality.fit(docs, one)).collect()} == {1}
    assert quality.classify(docs.limit(0), quality.fit(docs, none)).count() == 0
    model = quality.RuleModel(0.0, ((quality.Rule((("exclaims", True, 0.5), ("n_words", True, 2.0))), -4.0),))
    assert [r.predicted for r in sorted(quality.classify(docs.where("doc_id > 1"), model).collect(), key=lambda r: r.doc_id)] == [1, 0, 1]


# ---- op10


@pytest.mark.parametrize("scale", [256, 1 << 40])
def test_exact_search_against_brute_force(spark, scale):
    draw = np.random.default_rng(5)
    vectors = [(int(i), [float(x) for x in v]) for i, v in zip(range(0, 3000, 5), np.round(draw.normal(size=(600, 6)), 2))]
    vectors += [(i, [0.5] * 6) for i in range(10_000, 10_400)] + [(50, [1.0, 2.0]), (100, None), (150, [None, 1.0]), (200, [float("nan")] * 6), (250, [float("inf")] * 6), (None, [1.0] * 6), (300, []), (50, [0.1] * 6), (50, [0.1] * 6)]
    table = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, score int").repartition(3)
    got = {}
    for r in exact_search.top_k(table, scale=scale).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = {}
    for n, (q, a) in enumerate(good):
        if q % 50 == 0:
            found = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for m, (i, b) in enumerate(good) if m != n and len(a) == len(b))[:5]
            want.setdefault(q, []).extend((k + 1, i, -s) for k, (s, i) in enumerate(found))
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items() if x}
    assert exact_search.top_k(table.limit(0)).count() == 0


# ---- pipeline


def test_pipeline_stages(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    row = base.first().asDict()
    more = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 5), (9003, row["text"], row["lang"], "s", row["n_chars"]), (9004, "my password=abcdef99 is this one and the other", "en", "s", 1)], base.schema)
    docs = base.unionByName(more)
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            docs = docs.checkpoint()
            ids[name] = {r.doc_id for r in docs.collect()}
    assert not {9001, 9002} & ids["language_id"] and 9003 in ids["language_id"] and 9003 not in ids["near_dedup"]
    assert ids["secret_scan"] == ids["benchmark_decontamination"] and 9004 in ids["secret_scan"]
    assert {r.doc_id for r in docs.collect()} == ids["secret_scan"]


def test_pipeline_drops_copies_at_a_share_of_80(spark):
    base = [f"w{i}" for i in range(104)]
    near, far = list(base), list(base)
    near[30] = near[70] = "x"  # 90 of 110 shingles: 0.82
    far[20] = far[50] = far[80] = "y"  # 85 of 115: 0.74
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate((base, near, far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()} == {0, 2}
