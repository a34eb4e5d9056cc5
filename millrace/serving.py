"""HTTP on the driver: metrics for scrapers, health and answers, and a client for chat models. Standard library alone."""

from __future__ import annotations

import json
import threading
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from millrace.operators.healing import MENU
from millrace.operators.retrieval import RagAnswer, source_rows

#: Fixed value: the port that scrapers of the pipeline expect.
METRICS_PORT = 9464
#: Bytes of a request's body, at most.
MOST_BYTES = 1 << 20


def serve(routes: dict[tuple[str, str], Callable[[dict], object]], port: int = 0, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """Answer (method, path) by a function of the request's JSON object: text as it is, anything else as JSON.

    An unknown route is 404, a body that isn't a JSON object or that the function refuses by
    ValueError 400, another failure 500. Runs in the background until ``shutdown()``; port 0 takes a free one.
    """

    class Handler(BaseHTTPRequestHandler):
        def answer(self) -> None:
            route = routes.get((self.command, self.path.partition("?")[0]))
            if route is None:
                return self.send(404, {"error": "no such page"})
            try:
                size = int(self.headers.get("Content-Length") or 0)
                if size > MOST_BYTES:
                    raise ValueError("the request is too long")
                body = json.loads(self.rfile.read(size) or b"{}")
                if not isinstance(body, dict):
                    raise ValueError("not a JSON object")
                return self.send(200, route(body))
            except ValueError as e:
                return self.send(400, {"error": str(e)})
            except Exception as e:  # noqa: BLE001  the server goes on
                return self.send(500, {"error": type(e).__name__})

        do_GET = do_POST = answer

        def send(self, status: int, found: object) -> None:
            text = isinstance(found, str)
            raw = (found if text else json.dumps(found)).encode()
            self.send_response(status)
            self.send_header("Content-Type", "text/plain; version=0.0.4" if text else "application/json")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *_: object) -> None:
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server


def metrics_route(exposition: Callable[[], str]) -> dict:
    return {("GET", "/metrics"): lambda _: exposition()}


def answer_routes(ask: Callable[[str, float | None], RagAnswer], health: Callable[[], dict]) -> dict:
    """``GET /health``, and ``POST /ask`` with ``question`` and an optional ``min_rating``: the question, its answer and the sources as clients see them."""

    def asked(body: dict) -> dict:
        question, least = body.get("question"), body.get("min_rating")
        if not isinstance(question, str) or not (least is None or isinstance(least, (int, float))):
            raise ValueError("question must be a string and min_rating a number")
        found = ask(question, least)
        return {"question": found.question, "answer": found.answer, "sources": source_rows(found)}

    return {("GET", "/health"): lambda _: health(), ("POST", "/ask"): asked}


@dataclass
class ChatClient:
    """A chat model behind the usual completions interface; ``complete`` is what answering, judging and healing take."""

    url: str
    model: str
    key: str = ""
    temperature: float = 0.2
    seconds: float = 60.0

    def complete(self, system: str, user: str, schema: dict | None = None) -> str:
        """The answer's text; with a JSON schema the server is asked to give nothing but JSON that fits it."""
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        body = {"model": self.model, "temperature": self.temperature, "messages": messages}
        if schema is not None:
            body["response_format"] = {"type": "json_schema", "json_schema": {"name": "answer", "strict": True, "schema": schema}}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        with urllib.request.urlopen(request, timeout=self.seconds) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]


def menu_schema(field: str, *texts: str) -> dict:
    """A JSON schema of objects with exactly these fields: ``field``, which is on the healer's menu, and strings."""
    kinds = {field: {"type": "string", "enum": list(MENU)}} | {t: {"type": "string"} for t in texts}
    return {"type": "object", "properties": kinds, "required": list(kinds), "additionalProperties": False}


#: The fields of a decision on a failure.
DECISION_SCHEMA = menu_schema("decision", "reason")


def decision_call(client: ChatClient, instructions: str) -> Callable[[str, str], str]:
    """What ``healing.decisions`` takes as ``llm_call``: a model asked for a decision under its schema.

    The answer goes back as it came. The healer reads it on its own terms, so a server that
    knows no schemas, fails or answers something else escalates.
    """
    return lambda kind, said: client.complete(instructions, f"{kind}: {said}", schema=DECISION_SCHEMA)
