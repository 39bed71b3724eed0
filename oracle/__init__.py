"""DuckDB oracle SQL for the differential correctness check.

``ORACLE[name]`` is a complete SQL statement over the driver's tables (views
``region nation customer supplier part orders lineitem events ...``).
"""

from __future__ import annotations

from . import checks, core, domains, programs  # noqa: F401  (registers CTEs)
from .base import assemble

ORACLE: dict[str, str] = {}


def final(name: str, source: str, bigint: tuple[str, ...] = (), double: tuple[str, ...] = (),
          lists: tuple[str, ...] = (), exclude: tuple[str, ...] = (), json_lists: tuple[str, ...] = ()) -> None:
    """Register ``SELECT * FROM source`` with engine-neutral column types."""
    reps = [f"CAST({c} AS BIGINT) AS {c}" for c in bigint]
    reps += [f"CAST({c} AS DOUBLE) AS {c}" for c in double]
    reps += [f"array_to_string({c}, ',') AS {c}" for c in lists]
    reps += [f"array_to_string(list_sort(list_transform({c}, lambda x: CAST(to_json(x) AS VARCHAR))), ';') AS {c}"
             for c in json_lists]
    sel = "*"
    if exclude:
        sel += f" EXCLUDE ({', '.join(exclude)})"
    if reps:
        sel += f" REPLACE ({', '.join(reps)})"
    ORACLE[name] = assemble(f"SELECT {sel} FROM {source}", source)


from . import constraints, queries  # noqa: E402,F401

for _group in constraints.GROUPS:
    for _kind, _sql in (("keys", constraints.keys_sql), ("references", constraints.references_sql)):
        _text, _needs = _sql(_group)
        ORACLE[f"dq_d3{2 if _kind == 'keys' else 3}_{_kind}_{_group}"] = assemble(_text, *sorted(_needs))
