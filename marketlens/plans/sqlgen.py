"""Small helpers that render fixed values (label maps, literal rows) as DuckDB SQL for the oracles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def case_map(expr: str, mapping: Mapping, keep_unknown: bool) -> str:
    """``CASE expr WHEN k THEN label ... ELSE <expr as text | NULL> END``."""
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    other = f"CAST({expr} AS VARCHAR)" if keep_unknown else "NULL"
    return f"CASE {expr} {whens} ELSE {other} END"


def values(rows: Sequence[Sequence], columns: Sequence[str], types: Sequence[str]) -> str:
    """A typed inline table: ``(SELECT CAST(c1 AS t1) AS n1, ... FROM (VALUES ...) v(c1, ...))``."""
    raw = [f"c{i}" for i in range(len(columns))]
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    sel = ", ".join(f"CAST({r} AS {t}) AS {n}" for r, n, t in zip(raw, columns, types))
    return f"(SELECT {sel} FROM (VALUES {body}) v({', '.join(raw)}))"
