"""Command line: full refresh of the warehouse and data-quality checks.

    python -m rollcall.cli run   --sf-dir DIR --out DIR [--as-of YYYY-MM-DD] [--select NAME ...]
    python -m rollcall.cli test  --sf-dir DIR --out DIR [--as-of YYYY-MM-DD] [--select CHECK ...]

``run`` writes every table dataset (or the selected ones with what they read)
below ``--out`` in dependency order, each once, facts and measures partitioned
by school year and all tables clustered by tenant and year (S8).  They take the
place of the tables of the run before when all are written (S5, see
``sources.store``).  A table with a NULL in its grain stops the run before that.
``test`` runs the checks and appends the violating rows, tagged with the run,
to ``--out/_audit`` (S9); it prints how many this run found.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import uuid

from .config import Config
from .plans.registry import DATASETS, Warehouse, load_all
from .session import build_session
from .sources.sinks import append_audit, audit
from .sources.staging import Staging
from .sources.store import Store


def _config(args) -> Config:
    return Config(as_of=dt.date.fromisoformat(args.as_of) if args.as_of else None)


def run(args) -> dict:
    spark = build_session(args.master)
    load_all()
    refresh = Store(spark, args.out).begin()
    wh = Warehouse(spark, Staging(spark, args.sf_dir), _config(args), table_root=refresh.root, lay_out=True)
    for n in args.select or [n for n, d in DATASETS.items() if d.materialized == "table" or d.kind == "qc"]:
        wh.table(n)
    broken = {n: seen for n, seen in wh.observed.items() if any(v for k, v in seen.items() if k.startswith("null:"))}
    if broken:
        raise SystemExit(f"NULLs in the grain, tables not taken over: {json.dumps(broken)}")
    for n in wh.observed:
        refresh.add(n)
    refresh.finish()
    return {n: seen["rows"] for n, seen in wh.observed.items()}


def test(args) -> dict:
    from .plans.checks import CHECKS
    spark = build_session(args.master)
    load_all()
    cfg = _config(args)
    wh = Warehouse(spark, Staging(spark, args.sf_dir), cfg, table_root=f"{args.out}/_check_inputs/{uuid.uuid4().hex}")
    run_id = uuid.uuid4().hex
    return {name: append_audit(audit(CHECKS[name].fn(wh), name, CHECKS[name].severity, cfg.as_of, run_id), f"{args.out}/_audit")
            for name in args.select or list(CHECKS)}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="rollcall")
    p.add_argument("command", choices=["run", "test"])
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", default=None)
    p.add_argument("--master", default=None)
    p.add_argument("--select", nargs="*", default=None)
    args = p.parse_args(argv)
    result = run(args) if args.command == "run" else test(args)
    print(json.dumps(result, indent=1))


if __name__ == "__main__":
    main()
