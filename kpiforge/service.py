"""The plans behind HTTP, for those who call them so: a thin shell around cli with the standard library's server.

GET /liveness and /running; POST /infer, /curate, /extract, /rules and /locate with a JSON object of the function's
arguments. One run at a time; a run that fails answers 500 with its message.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession

from . import cli
from .sources.readers import extracted_json
from .sources.writers import by_report


def _infer(spark: SparkSession, out: str, extractions: str | None = None, kpis: str | None = None, sectors: str = "OG,CM,CU", pages: str | None = None, mode: str = "ML") -> DataFrame | None:
    return cli.infer(spark, extractions, kpis, out, sectors.split(","), pages=pages, mode=mode)


def _rules(spark: SparkSession, pages: str, out: str) -> DataFrame | None:
    return cli.infer(spark, None, None, out, [], pages=pages, mode="RB")


def _curate(spark: SparkSession, annotations: str, extractions: str, kpis: str, out: str, ratio: int = 1, seed: int = 42) -> DataFrame:
    return cli.curate(spark, annotations, extractions, kpis, out, ratio, seed)


def _extract(spark: SparkSession, extractions: str, out: str) -> DataFrame:
    """Extracted JSON files as paragraphs by report."""
    rows = extracted_json(spark, extractions)
    by_report(rows, out)
    return rows


ROUTES: dict[str, Callable[..., DataFrame | None]] = {"/infer": _infer, "/rules": _rules, "/curate": _curate, "/extract": _extract, "/locate": cli.locate}


def serve(spark: SparkSession, port: int, routes: dict[str, Callable[..., DataFrame | None]] = ROUTES) -> ThreadingHTTPServer:
    """A server on this machine; call its serve_forever()."""
    busy = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def _say(self, code: int, **facts: object) -> None:
            body = json.dumps(facts, default=str).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self) -> None:  # noqa: N802
            if self.path == "/liveness":
                self._say(200, alive=True)
            elif self.path == "/running":
                self._say(200, running=busy.locked())
            else:
                self._say(404, error=f"no {self.path}")

        def do_POST(self) -> None:  # noqa: N802
            run = routes.get(self.path.rstrip("/"))
            if run is None:
                self._say(404, error=f"no {self.path}")
                return
            if not busy.acquire(blocking=False):
                self._say(409, error="another run is going on")
                return
            try:
                size = int(self.headers.get("Content-Length") or 0)
                run(spark, **json.loads(self.rfile.read(size) or b"{}"))
                self._say(200, done=self.path)
            except Exception as e:  # noqa: BLE001  whatever a run fails of is the caller's to know
                self._say(500, error=str(e)[:2000])
            finally:
                busy.release()

        def log_message(self, *args: object) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
