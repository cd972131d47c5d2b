"""python -m lakeforge ROOT COMMAND ..."""

from __future__ import annotations

import argparse
import json
from datetime import date

from lakeforge import tools
from lakeforge.lake import Lake
from lakeforge.quality.audit import audit, verify
from lakeforge.session import drop_cuts, session
from lakeforge.state import State
from lakeforge.stats import Stats


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeforge")
    p.add_argument("root")
    sub = p.add_subparsers(dest="command", required=True)
    for name, about in (("catalogue", "all datasets"), ("runs", "runs and their state"), ("health", "fresh and stale datasets"), ("stale", "datasets to fetch again")):
        sub.add_parser(name, help=about)
    for name, about in (("describe", "schema and key"), ("repartition", "rewrite to the configured periods"), ("dates", "periods that exist"), ("coverage", "first and last day"), ("due", "sessions without rows")):
        sub.add_parser(name, help=about).add_argument("dataset")
    sub.choices["repartition"].add_argument("--dry-run", action="store_true")
    for x in ("--start", "--end"):
        sub.choices["due"].add_argument(x, required=True)
    c = sub.add_parser("compact", help="merge a run's staged rows")
    c.add_argument("dataset")
    c.add_argument("run")
    sub.add_parser("clean", help="delete staged runs").add_argument("--keep", nargs="*", default=[])
    q = sub.add_parser("query", help="one SELECT over the views")
    q.add_argument("--sql", required=True)
    q.add_argument("--limit", type=int, default=tools.DEFAULT_ROWS)
    r = sub.add_parser("rows", help="a page of a period")
    r.add_argument("dataset")
    r.add_argument("period")
    r.add_argument("--limit", type=int, default=tools.DEFAULT_ROWS)
    s = sub.add_parser("symbol", help="instruments by code or name")
    s.add_argument("text")
    for name, about in (("audit", "findings"), ("verify", "gaps"), ("stats", "stored statistics, rebuilt where they are stale")):
        sub.add_parser(name, help=about).add_argument("datasets", nargs="*")
    v = sub.add_parser("serve", help="JSON over HTTP")
    v.add_argument("--port", type=int, default=8000)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "describe":
        print(json.dumps(tools.describe_dataset(a.dataset), indent=1))
        return 0
    spark = session()
    try:
        print(json.dumps(_run(Lake(spark, a.root), a), indent=1, default=str))
    finally:
        drop_cuts(spark)
    return 0


def _run(lake: Lake, a: argparse.Namespace) -> object:
    spark, today = lake.spark, date.today()
    calendar = lambda: lake.scan("trading_calendar", must_exist=False).where("is_trading").select("trade_date")
    marks = lambda: {n: m for n in tools.DATASETS if (m := State(spark, a.root).mark(n))}
    match a.command:
        case "catalogue":
            return lake.catalogue(calendar())
        case "runs":
            return State(spark, a.root).runs()
        case "health":
            return tools.health(lake, today, marks())
        case "stale":
            return tools.stale_datasets(lake, today, marks())
        case "dates":
            return tools.date_options(lake, a.dataset)
        case "coverage":
            return lake.coverage(a.dataset, calendar())
        case "due":
            from lakeforge.operators.backfill import due_days

            return [r.asDict() for r in due_days(calendar(), lake.scan(a.dataset, must_exist=False), a.start, a.end).orderBy("trade_date").toLocalIterator()]
        case "query":
            lake.views()
            return tools.run_sql(lake, a.sql, a.limit)
        case "rows":
            return tools.period_rows(lake, a.dataset, a.period, a.limit)
        case "symbol":
            return tools.resolve_symbol(lake, a.text)
        case "audit":
            return [r.asDict() for r in audit(lake, a.datasets or None).toLocalIterator()]
        case "verify":
            return [g for d in a.datasets for g in verify(lake, d, calendar(), today)]
        case "stats":
            return Stats(lake).rebuild(a.datasets or None)
        case "clean":
            return lake.clear_staging(set(a.keep))
        case "compact":
            return lake.compact(a.dataset, a.run)
        case "repartition":
            return lake.repartition(a.dataset, a.dry_run)
        case "serve":
            from lakeforge.serve import serve

            return serve(lake, a.port)
    raise ValueError(a.command)


if __name__ == "__main__":
    raise SystemExit(main())
