"""An optional JSON-RPC front end over HTTP. Queries run one after the other; one that takes too long is cancelled."""

from __future__ import annotations

import json
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as TooLate
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from girder.plans.args import QueryError
from girder.plans.registry import BY_NAME, catalog
from girder.sources.model import Model, Session

PROTOCOL, VERSION, TIMEOUT_S = "2024-11-05", "0.2.0", 30.0


class Dispatcher:
    def __init__(self, model: Model, session: Session, timeout_s: float = TIMEOUT_S):
        self.model, self.session, self.timeout_s = model, session, timeout_s
        self._pool = ThreadPoolExecutor(1)

    def __call__(self, body: str) -> str:
        """The answer to a request. A body that isn't JSON raises."""
        request = json.loads(body)
        if not isinstance(request, dict):
            raise ValueError("The request is not an object.")
        number, method = request.get("id"), request.get("method")
        try:
            if method == "initialize":
                return self._ok(number, {"protocolVersion": PROTOCOL, "capabilities": {"tools": {}}, "serverInfo": {"name": "girder", "version": VERSION}})
            if method == "tools/list":
                return self._ok(number, {"tools": catalog()})
            if method == "tools/call":
                return self._call(number, request)
            return self._error(number, -32601, f"Method not found: {method or ''}")
        except Exception as e:
            return self._error(number, -32603, str(e))

    def _call(self, number, request: dict) -> str:
        if "params" not in request:
            return self._error(number, -32602, "Missing params.")
        params = request["params"]
        if (name := params.get("name")) not in BY_NAME:
            return self._error(number, -32601, f"Unknown tool: {name or ''}")
        args = params.get("arguments")
        try:
            text, failed = self._run(name, args if isinstance(args, dict) else {}), {}
        except QueryError as e:
            text, failed = str(e), {"isError": True}
        return self._ok(number, {"content": [{"type": "text", "text": text}], **failed})

    def _run(self, name: str, args: dict) -> str:
        spark, tag = self.model.spark, f"query-{uuid.uuid4().hex}"

        def work() -> str:
            spark.addTag(tag)
            try:
                return BY_NAME[name].run(self.model, self.session, args).text()
            finally:
                spark.removeTag(tag)

        waiting = self._pool.submit(work)
        try:
            return waiting.result(self.timeout_s)
        except TooLate:
            waiting.cancel()
            spark.interruptTag(tag)
            raise TimeoutError("The query took too long.") from None

    @staticmethod
    def _ok(number, result: dict) -> str:
        return json.dumps({"jsonrpc": "2.0", "id": number, "result": result}, ensure_ascii=False, separators=(",", ":"))

    @staticmethod
    def _error(number, code: int, message: str) -> str:
        return json.dumps({"jsonrpc": "2.0", "id": number, "error": {"code": code, "message": message}}, ensure_ascii=False, separators=(",", ":"))


def serve(model: Model, session: Session, host: str = "127.0.0.1", port: int = 0, token: str | None = None) -> ThreadingHTTPServer:
    """Starts serving on a thread of its own; stop it with shutdown(). GET is a health check; with a token, every request must bear it."""
    dispatch = Dispatcher(model, session)

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, status: int, body: bytes = b"", kind: str = "text/plain") -> None:
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def _allowed(self) -> bool:
            if token is not None and self.headers.get("Authorization") != f"Bearer {token}":
                self._answer(401)
                return False
            return True

        def do_GET(self) -> None:  # noqa: N802
            if self._allowed():
                self._answer(200)

        def do_POST(self) -> None:  # noqa: N802
            if not self._allowed():
                return
            try:
                body = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode()
                self._answer(200, dispatch(body).encode(), "application/json")
            except Exception as e:
                self._answer(500, str(e).encode())

        def _refused(self) -> None:
            if self._allowed():
                self._answer(405)

        do_PUT = do_DELETE = do_PATCH = do_HEAD = do_OPTIONS = _refused  # noqa: N815

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
