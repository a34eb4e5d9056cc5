"""The HTTP side: routes, errors, and a chat client against a stub."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from types import SimpleNamespace

import pytest

from millrace import serving
from millrace.operators import healing
from millrace.operators.retrieval import RagAnswer


def call(server, path, body=None):
    request = urllib.request.Request(f"http://127.0.0.1:{server.server_port}{path}", None if body is None else json.dumps(body).encode())
    try:
        with urllib.request.urlopen(request, timeout=10) as got:
            return got.status, got.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode()


@pytest.fixture
def server():
    source = SimpleNamespace(score=0.5, metadata=SimpleNamespace(rating=4.0, asin="a"), document="d" * 300)

    def ask(question, least):
        if question == "fail":
            raise KeyError(question)
        return RagAnswer(question, f"{question} {least}", [source])

    made = serving.serve(serving.metrics_route(lambda: "pipeline_attempts_total 1\n") | serving.answer_routes(ask, lambda: {"status": "ok", "chunks": 3}))
    yield made
    made.shutdown()


def test_routes(server):
    assert call(server, "/metrics") == (200, "pipeline_attempts_total 1\n")
    assert json.loads(call(server, "/health?x=1")[1]) == {"status": "ok", "chunks": 3}
    status, found = call(server, "/ask", {"question": "why", "min_rating": 4})
    found = json.loads(found)
    assert status == 200 and found["answer"] == "why 4" and found["sources"] == [{"rank": 1, "score": 0.5, "rating": 4.0, "asin": "a", "text": "d" * 200}]


def test_refusals(server):
    assert call(server, "/none")[0] == 404 and call(server, "/ask")[0] == 404
    assert call(server, "/ask", {"question": 7})[0] == 400 and call(server, "/ask", [1])[0] == 400
    assert call(server, "/ask", {"question": "fail"}) == (500, '{"error": "KeyError"}')


def test_chat_client():
    def complete(body):
        return {"choices": [{"message": {"content": f"{body['model']} {body['temperature']} {body['messages'][0]['content']} {body['messages'][1]['content']}"}}]}

    stub = serving.serve({("POST", "/v1"): complete})
    client = serving.ChatClient(f"http://127.0.0.1:{stub.server_port}/v1", "m")
    assert client.complete("be brief", "hello") == "m 0.2 be brief hello"
    stub.shutdown()


def test_decisions_under_a_schema(spark):
    """The schema is sent and obeyed by a server that knows it; one that fails, or strays from it, escalates."""
    asked = []

    def complete(body):
        user = body["messages"][1]["content"]
        asked.append((user, body["response_format"]["json_schema"]["schema"]))
        if user.startswith("Down"):
            raise KeyError(user)
        menu = asked[-1][1]["properties"]["decision"]["enum"]
        return {"choices": [{"message": {"content": json.dumps({"decision": "sing" if user.startswith("Stray") else menu[1], "reason": user})}}]}

    stub = serving.serve({("POST", "/v1"): complete})
    call = serving.decision_call(serving.ChatClient(f"http://127.0.0.1:{stub.server_port}/v1", "m"), "choose")
    kinds = ["Odd", "Odd", "Stray", "Down", "KeyError"]
    failed = spark.createDataFrame([(i, k, "m", 1) for i, k in enumerate(kinds)], "id long, error_type string, error_message string, attempt_count long")
    got = {r.id: r.decision for r in healing.decisions(failed, llm_call=call).collect()}
    stub.shutdown()
    assert got == {0: "retry_with_failover", 1: "retry_with_failover", 2: "escalate", 3: "escalate", 4: "escalate"}
    assert sorted(u for u, _ in asked) == ["Down: m", "Odd: m", "Stray: m"]  # each once, and none that the rules decide
    assert all(s == serving.DECISION_SCHEMA and s["required"] == ["decision", "reason"] and s["additionalProperties"] is False for _, s in asked)
