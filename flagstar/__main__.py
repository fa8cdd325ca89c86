"""Command line: run the hospital layers on a folder of CSV files, or show its marts.

    python -m flagstar layers --source-dir data/source --root data/lake [--as-of 2024-01-02]
                              [--load-date 2024-01-02] [--strict] [--on-orphan warn|fail]
    python -m flagstar marts --root data/lake [--specialty Cardiologia ...] [--clean-only]
    python -m flagstar checks --root data/lake

``layers`` expects ``pacientes.csv``, ``doctores.csv``, ``citas.csv`` and
``resultados_lab.csv`` (a missing one is reported as MISSING). It prints one
JSON line per stage and exits non-zero when a stage fails.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from flagstar.plans import hospital as H
from flagstar.plans.medallion import run_layers
from flagstar.session import get_session
from flagstar.sources.landing import tables_ready

ALL_ROWS = 2**31 - 32  # marts are report-sized
SOURCE_FILES = {name: f"{name}.csv" for name in H.BRONZE_SCHEMAS}


def _layers(args) -> int:
    spark = get_session(app_name="flagstar-layers")
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
    sources = {name: f"{args.source_dir.rstrip('/')}/{file}" for name, file in SOURCE_FILES.items()}
    statuses = run_layers(
        spark, args.root.rstrip("/"), H.domain(as_of), sources=sources,
        load_date=args.load_date or as_of.isoformat(), strict=args.strict, on_orphan=args.on_orphan,
    )
    for s in statuses:
        detail = {k: v for k, v in s.detail.items() if k != "trace"}
        print(json.dumps({"stage": s.stage, "ok": s.ok, "seconds": round(s.seconds, 2), "detail": detail}, default=str))
    return 0 if all(s.ok for s in statuses) and len(statuses) == 3 else 1


def _marts(args) -> int:
    spark = get_session(app_name="flagstar-marts")
    gold = f"{args.root.rstrip('/')}/gold"
    if not tables_ready(spark, gold, H.GOLD_TABLES):
        print(f"Gold tables are missing under {gold}; run `python -m flagstar layers` first.", file=sys.stderr)
        return 2
    marts = H.dashboard_marts(spark, gold, args.specialty or None, args.clean_only, args.top)
    for name, df in marts.items():
        print(f"== {name}")
        df.show(args.rows, truncate=False)
    return 0


def _checks(args) -> int:
    spark = get_session(app_name="flagstar-checks")
    rows = H.contract_checks(spark, args.root.rstrip("/")).collect()
    for r in rows:
        print(json.dumps(r.asDict()))
    return 0 if all(r["passed"] for r in rows) else 1


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m flagstar")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("layers", help="CSV -> Bronze -> Silver -> Gold")
    p.add_argument("--source-dir", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--as-of")
    p.add_argument("--load-date")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--on-orphan", choices=("warn", "fail"), default="warn")
    p.set_defaults(fn=_layers)
    m = sub.add_parser("marts", help="KPIs and chart tables over Gold")
    m.add_argument("--root", required=True)
    m.add_argument("--specialty", action="append")
    m.add_argument("--clean-only", action="store_true")
    m.add_argument("--top", type=int, default=10)
    m.add_argument("--rows", type=int, default=ALL_ROWS, help="rows shown of each mart (default: all)")
    m.set_defaults(fn=_marts)
    c = sub.add_parser("checks", help="data contract of a written lake (one JSON line per check)")
    c.add_argument("--root", required=True)
    c.set_defaults(fn=_checks)
    args = parser.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
