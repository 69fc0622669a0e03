"""The read and query services over HTTP: routes to functions that return (status, body, headers)."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, unquote, urlsplit

from ..model import METRICS
from .service import QueryService, ReadApi, Reply

Handler = Callable[[dict[str, str], dict], Reply]


def _number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else default if text is None else 0


def read_routes(api: ReadApi) -> dict[str, Handler]:
    tenant = lambda q: {"tenant": q["tenant"]} if "tenant" in q else {}
    summary = lambda q, _: api.summary(q["entity"], day=q.get("day"), **tenant(q))
    history = lambda q, _: api.history(q["entity"], days=_number(q.get("days"), 7), **tenant(q))
    return {
        "GET /healthz": lambda q, _: (200, {"status": "ok"}, {}), "GET /metrics": lambda q, _: (200, METRICS.exposition(), {"Content-Type": "text/plain"}),
        "GET /entities/{entity}": summary, "GET /entities/{entity}/history": history,
        "GET /tenants/{tenant}/entities/{entity}": summary, "GET /tenants/{tenant}/entities/{entity}/history": history,
    }


def query_routes(service: QueryService) -> dict[str, Handler]:
    def submit(q: dict[str, str], body: dict) -> Reply:
        sql = body.get("sql")
        return service.submit(sql, body.get("user") or q.get("x-user")) if isinstance(sql, str) else (422, {"detail": "sql is missing"}, {})

    return {
        "GET /healthz": lambda q, _: service.health(), "GET /metrics": lambda q, _: service.metrics(), "GET /v1/policy": lambda q, _: service.policy(),
        "GET /v1/decisions": lambda q, _: service.decisions(_number(q.get("limit"), 50)), "GET /v1/summary": lambda q, _: service.summary(), "POST /v1/queries": submit,
    }


def serve(routes: dict[str, Handler], host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """A server for the routes; the caller runs and closes it. Every request is counted and timed by its route."""
    table = [(r.split(" ")[0], re.compile(re.sub(r"{(\w+)}", r"(?P<\1>[^/]+)", r.split(" ")[1])), r, f) for r, f in routes.items()]

    class Requests(BaseHTTPRequestHandler):
        def reply(self) -> None:
            url, began = urlsplit(self.path), time.time()
            found = next(((m, r, f) for method, pattern, r, f in table if method == self.command and (m := pattern.fullmatch(url.path))), None)
            if found is None:
                route, (status, body, headers) = "none", (404, {"detail": "no such path"}, {})
            else:
                match, route, f = found
                query = {k.lower(): v for k, v in self.headers.items() if k.lower() == "x-user"} | {k: v[-1] for k, v in parse_qs(url.query).items()} | {k: unquote(v) for k, v in match.groupdict().items()}
                try:
                    raw = self.rfile.read(int(self.headers.get("Content-Length") or 0))
                    sent = json.loads(raw) if raw else {}
                    status, body, headers = f(query, sent if isinstance(sent, dict) else {})
                except ValueError:
                    status, body, headers = 422, {"detail": "the body is no JSON"}, {}
                except Exception as e:
                    status, body, headers = 500, {"detail": str(e)[:500]}, {}
            METRICS.inc("sm_http_requests_total", path=route, status=str(status))
            METRICS.observe("sm_http_seconds", time.time() - began, path=route)
            data = body.encode() if isinstance(body, str) else json.dumps(body, default=str).encode()
            self.send_response(status)
            for k, v in ({"Content-Type": "application/json", "Content-Length": str(len(data))} | headers).items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = reply

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Requests)
