"""Write DATASETS.md: every registered dataset, check and query (run: python tests/gen_inventory.py)."""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from rollcall.plans.checks import CHECKS  # noqa: E402
from rollcall.plans.registry import DATASETS, load_all  # noqa: E402


def main() -> None:
    load_all()
    queries = E.queries()
    oracle = E.oracle_sql()
    by_ds = {}
    for q, ds in {**E.DATASET_QUERIES, **E.CUSTOM_QUERIES}.items():
        by_ds.setdefault(ds, []).append(q)
    lines = ["# DATASETS — generated from the registry (`python tests/gen_inventory.py`)", "",
             f"{len(DATASETS)} datasets, {len(CHECKS)} checks, {len(queries)} registered queries "
             f"({len(oracle)} with a DuckDB oracle).", "",
             "| Dataset | Domain | Kind | Materialized | Grain | Registered query |", "|---|---|---|---|---|---|"]
    for name, d in sorted(DATASETS.items(), key=lambda x: (x[1].domain, x[1].kind, x[0])):
        doc = (d.fn.__doc__ or "").strip().splitlines()[0] if d.fn.__doc__ else ""
        qs = ", ".join(f"`{q}`" for q in by_ds.get(name, [])) or "(input of others)"
        lines.append(f"| `{name}` | {d.domain} | {d.kind} | {d.materialized} | {', '.join(d.grain)} | {qs} |")
    lines += ["", "| Check | Severity | Registered query |", "|---|---|---|"]
    for name, c in sorted(CHECKS.items()):
        q = f"dq_{name}"
        lines.append(f"| `{name}` | {c.severity} | {'`' + q + '`' if q in queries else 'library only'} |")
    lines += ["", "Analyst queries: " + ", ".join(f"`{q}`" for q in sorted(queries) if q.startswith("q")), ""]
    with open(os.path.join(ROOT, "DATASETS.md"), "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
