"""Small generators of oracle SQL text (DuckDB dialect) for repeated shapes."""

from __future__ import annotations

from collections.abc import Sequence


def q(name: str) -> str:
    return '"' + name + '"'


def long_union(src: str, cols: Sequence[str], by: Sequence[str] = (), value: str = "x",
               dropna: bool = True) -> str:
    """``by..., column_name, x`` rows of numeric columns of ``src``."""
    sel_by = "".join(f"{q(b)}, " for b in by)
    parts = []
    for c in cols:
        where = f" WHERE {q(c)} IS NOT NULL" if dropna else ""
        parts.append(f"SELECT {sel_by}'{c}' AS column_name, CAST({q(c)} AS DOUBLE) AS {value} FROM {src}{where}")
    return "\nUNION ALL\n".join(parts)


def quantiles(src: str, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> str:
    """Exact linear-interpolated quantiles: ``by..., column_name, q, value``."""
    keys = [*map(q, by), "column_name"]
    part = ", ".join(keys)
    probs_sql = ", ".join(f"({float(p)!r}::DOUBLE)" for p in probs)
    return f"""(
  SELECT {part}, pq AS q,
         v0 + (v1 - v0) * (pq * (n - 1) - floor(pq * (n - 1))) AS value, n
  FROM (
    SELECT {part}, p.pq, max(n) AS n,
           max(CASE WHEN k = floor(p.pq * (n - 1)) THEN x END) AS v0,
           max(CASE WHEN k = ceil(p.pq * (n - 1)) THEN x END) AS v1
    FROM (
      SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY x) - 1 AS k,
             count(*) OVER (PARTITION BY {part}) AS n
      FROM ({long_union(src, cols, by)}) lu
    ) ranked CROSS JOIN (VALUES {probs_sql}) p(pq)
    GROUP BY {part}, p.pq
  ) s
)"""


def unpivot_body(names: Sequence[str], value_name: str, name_col: str = "column_name",
                 src: str = "r") -> str:
    """(name, value) rows from a one-row CTE ``src`` with one column per name."""
    parts = [f"SELECT '{n}' AS {name_col}, {q(n)} AS {value_name} FROM {src}" for n in names]
    return "\nUNION ALL\n".join(parts)
