"""Arguments and identifiers that once ended a job; tokens in common surroundings."""

import base64
import json

import pytest

from tablelab.llm import secrets, toolcalls

SCHEMA = "conv_id {} , turn {}, kind string, role string, name string, call_id string, content string, arguments string"
DEEP = '{"a":' * 900 + "1" + "}" * 900


def test_surrogates_depth_and_text_ids(spark):
    rows = []
    for i, given in enumerate([r'{"a":"\ud800"}', r'{"\udfff":{"$ref":"\ud800x"}}', DEEP, "[" * 100_000, r'{"a":"😀"}', '{"b":2,"a":1}']):
        rows.append((f"conv-{i}", "0", "call", None, "add", f"c{i}", None, given))
        rows.append((f"conv-{i}", "1", "result", None, None, f"c{i}", "done", None))
    rows.append(("conv-x", "soon", "message", "user", None, None, "hi", None))
    got = {(r.conv_id, r.kind): r for r in toolcalls.link(spark.createDataFrame(rows, SCHEMA.format("string", "string")), {"add": {"type": "object"}}).collect()}
    assert len(got) == 13 and got["conv-x", "message"].turn is None
    for i in (0, 1, 2, 4, 5):
        call = got[f"conv-{i}", "call"]
        assert call.linked and call.valid == (i != 1)
        if i != 2:
            body = json.loads(call.json)
            assert body["tool_calls"][0]["function"]["arguments"] == json.loads(rows[2 * i][7]) and list(body) == sorted(body)
            assert call.json == toolcalls.canonical(body)
    assert DEEP in got["conv-2", "call"].json and "needed call is missing" in got["conv-1", "call"].errors
    assert "arguments are no JSON" in got["conv-3", "call"].errors


def test_turns_of_text(spark):
    turns = spark.createDataFrame([("a", "0", "user", "hello"), ("a", "1", "assistant", "yes"), ("a", "2", "user", "more"), ("b", None, "user", None)], "conv_id string, turn string, role string, text string")
    got = toolcalls.link(toolcalls.from_turns(turns), toolcalls.TURN_SCHEMAS).collect()
    assert len(got) == 4 and sum(r.linked for r in got) == 2


def token(head=b'{"alg":"HS256"}'):
    return ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (head, b'{"sub":"1"}', b"signature"))


@pytest.mark.parametrize("before", ["", "session_", "production.auth.", "Bearer ", "ey_", "x-", "token=", "eyJhbGci_"])
@pytest.mark.parametrize("head", [b'{"alg":"HS256"}', b'{ "alg": "HS256" }', b'{\n "alg":"none"}'])
def test_tokens_in_common_surroundings(before, head):
    text = f"see {before}{token(head)} there"
    start = len("see ") + len(before)
    assert [s for s in secrets.spans_of(text) if s[2] == "jwt"] == [(start, start + len(token(head)), "jwt")]


def test_no_tokens_in_words():
    assert secrets.token_spans(f"they{token()} " + "ey-" * 50_000 + " eyJhbGciOiJ.x.y") == []
