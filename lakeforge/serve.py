"""The lake over HTTP: read-only JSON.  ``answer`` is the whole of it; ``serve`` only carries it."""

from __future__ import annotations

import json
from datetime import date
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any
from urllib.parse import parse_qs, unquote, urlsplit

from lakeforge import tools
from lakeforge.lake import Lake
from lakeforge.operators.storage import heatmap
from lakeforge.registry import DATASETS, dataset
from lakeforge.state import State
from lakeforge.stats import Stats

HEATMAP_SYMBOLS = 200


def answer(lake: Lake, target: str, today: date | None = None) -> tuple[int, Any]:
    """Status and body of a GET."""
    url = urlsplit(target)
    parts = [unquote(p) for p in url.path.strip("/").split("/")]
    asked = {k: v[-1] for k, v in parse_qs(url.query).items()}
    try:
        found = _answer(lake, parts, asked, today or date.today())
    except (KeyError, FileNotFoundError) as e:
        return 404, {"error": str(e)}
    except (ValueError, PermissionError) as e:
        return 400, {"error": str(e)}
    return (404, {"error": url.path}) if found is None else (200, found)


def _answer(lake: Lake, parts: list[str], asked: dict[str, str], today: date) -> Any:
    if parts[:1] != ["api"]:
        return None
    page = {"limit": int(asked.get("limit", tools.DEFAULT_ROWS)), "offset": int(asked.get("offset", 0))}
    match parts[1:]:
        case ["health"]:
            return tools.health(lake, today)
        case ["tiers"]:
            return sorted({d.tier for d in DATASETS.values()})
        case ["datasets"]:
            return lake.catalogue()
        case ["datasets", name]:
            return tools.describe_dataset(name)
        case ["datasets", name, "dates"]:
            return tools.date_options(lake, name)
        case ["datasets", name, "partitions"]:
            dataset(name)
            return _rows(Stats(lake).partitions().where(f"dataset = '{name}'").orderBy("partition"))
        case ["datasets", name, "provenance"]:
            dataset(name)
            return _rows(Stats(lake).provenance_of_periods(name).orderBy("partition", "source", "data_version"))
        case ["datasets", name, "rows"]:
            how: dict[str, Any] = {k: asked[k] for k in ("as_of", "adjust") if k in asked}
            if "symbol" in asked:
                how["symbols"] = [asked["symbol"]]
            return tools.period_rows(lake, name, asked["period"], **page, **how) if "period" in asked else tools.query_dataset(lake, name, **page, **how)
        case ["runs"]:
            return State(lake.spark, lake.root).runs()
        case ["runs", run]:
            return next((r for r in State(lake.spark, lake.root).runs() if r["run"] == run), None)
        case ["quality"]:
            from lakeforge.quality.audit import audit

            return _rows(audit(lake, asked["datasets"].split(",") if "datasets" in asked else None))
        case ["heatmap"]:
            bars = lake.load("daily_bars", symbols=asked["symbols"].split(",")[:HEATMAP_SYMBOLS])
            return _rows(heatmap(bars, lake.scan("trading_calendar", must_exist=False).where("is_trading")).orderBy("symbol", "month_date"))
    return None


def _rows(df: Any) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.limit(tools.MOST_ROWS).toLocalIterator()]


def serve(lake: Lake, port: int = 8000, host: str = "127.0.0.1") -> None:
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, body = answer(lake, self.path)
            data = json.dumps(body, default=str).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

    ThreadingHTTPServer((host, port), Handler).serve_forever()
