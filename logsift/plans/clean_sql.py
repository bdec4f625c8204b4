"""DuckDB SQL pieces for the cleaning oracles (sequential rules as CTE chains)."""

from __future__ import annotations

from logsift.contracts import CRITICAL_FIELDS, K8S_LOG, MAX_MISSING_PCT, OUTLIER_FIELDS

# Java-regex classes of functions/text.py written for RE2 (ASCII-equal).
WS_RE2 = r"[\t\n\x0B\f\r \x{1c}-\x{1f}\x{85}\p{Z}]+"
CTRL_RE2 = r"[\x00-\x08\x0B-\x1F\x7F-\x9F\p{Cf}\p{Co}]"


def text_clean_sql(expr: str, n: int | None = None) -> str:
    if n is None:
        return (f"trim(regexp_replace(regexp_replace({expr}, '{CTRL_RE2}', '', 'g'), "
                f"'{WS_RE2}', ' ', 'g'))")
    return (f"trim(substring(trim(regexp_replace(regexp_replace({expr}, '{CTRL_RE2}', '', 'g'), "
            f"'{WS_RE2}', ' ', 'g')), 1, {n}))")


def q(c: str) -> str:
    return f'"{c}"'


def missing_chain(src: str, present: list[str], prefix: str = "m") -> tuple[str, str]:
    """CTEs replaying the critical-field rule then the non-nullable drops.

    Returns (cte text, name of the last CTE)."""
    ctes, prev = [], src
    i = 0
    for f in CRITICAL_FIELDS:
        if f not in present:
            continue
        i += 1
        name = f"{prefix}{i}"
        ctes.append(f"""{name} AS (SELECT * FROM {prev} WHERE NOT ({q(f)} IS NULL AND
  (SELECT CAST(count(*) - count({q(f)}) AS DOUBLE) * 100 / count(*) FROM {prev}) > {MAX_MISSING_PCT}))""")
        prev = name
    rest = [r.name for r in K8S_LOG if r.name in present and r.name not in CRITICAL_FIELDS and not r.nullable]
    if rest:
        i += 1
        name = f"{prefix}{i}"
        cond = " AND ".join(f"{q(f)} IS NOT NULL" for f in rest)
        ctes.append(f"{name} AS (SELECT * FROM {prev} WHERE {cond})")
        prev = name
    return ",\n".join(ctes), prev


def missing_log_sql(src: str, present: list[str]) -> str:
    """Rows of the missing-value log (removed_rows steps) for the log contract."""
    parts, prev, step_exprs = [], src, []
    ctes = []
    i = 0
    for f in CRITICAL_FIELDS:
        if f not in present:
            continue
        i += 1
        name = f"k{i}"
        ctes.append(f"""{name}_p AS (SELECT CAST(count(*) - count({q(f)}) AS DOUBLE) * 100 / count(*) AS pct,
   count(*) - count({q(f)}) AS miss FROM {prev}),
{name} AS (SELECT * FROM {prev} WHERE NOT ({q(f)} IS NULL AND (SELECT pct FROM {name}_p) > {MAX_MISSING_PCT}))""")
        step_exprs.append((f, f"{name}_p", name, "crit"))
        prev = name
    for r in K8S_LOG:
        f = r.name
        if f not in present or f in CRITICAL_FIELDS or r.nullable:
            continue
        i += 1
        name = f"k{i}"
        ctes.append(f"""{name}_p AS (SELECT count(*) - count({q(f)}) AS miss FROM {prev}),
{name} AS (SELECT * FROM {prev} WHERE {q(f)} IS NOT NULL)""")
        step_exprs.append((f, f"{name}_p", name, "rest"))
        prev = name
    for ordn, (f, p, name, kind) in enumerate(step_exprs):
        cond = f"(SELECT pct FROM {p}) > {MAX_MISSING_PCT}" if kind == "crit" else f"(SELECT miss FROM {p}) > 0"
        parts.append(f"""SELECT {ordn} AS ord, '{f}' AS field, 'removed_rows' AS action,
  CAST((SELECT miss FROM {p}) AS BIGINT) AS "count",
  CAST((SELECT count(*) FROM {src}) - (SELECT count(*) FROM {name}) AS BIGINT) AS rows_removed_cumulative
  WHERE {cond}""")
    body = "\nUNION ALL\n".join(parts)
    return ",\n".join(ctes), f"""SELECT row_number() OVER (ORDER BY ord) AS step_no, field, action, "count",
  rows_removed_cumulative FROM ({body}) u"""


def clean_chain(src: str, present: list[str], k: float = 3.0) -> tuple[str, str]:
    """missing -> text -> dedup -> cap; returns (ctes, final cte name).

    Timestamps in the views are already TIMESTAMP, so parsing keeps them.
    """
    mc, last = missing_chain(src, present)
    txt = text_clean_sql('message')
    ctes = [mc, f"""t1 AS (SELECT * REPLACE ({txt} AS message), message AS _old_message FROM {last})""",
            f"""d1 AS (SELECT * EXCLUDE (_old_message) FROM t1 WHERE log_id IN (
   SELECT min(log_id) FROM t1 GROUP BY date_trunc('second', "timestamp"), pod_name, message))"""]
    qs = ", ".join(f"quantile_cont(CAST({f} AS DOUBLE), 0.25) AS {f}_q1, quantile_cont(CAST({f} AS DOUBLE), 0.75) AS {f}_q3"
                   for f in OUTLIER_FIELDS)
    ctes.append(f"b1 AS (SELECT {qs} FROM d1)")
    caps = []
    for f in OUTLIER_FIELDS:
        lo = f"({f}_q1 - {k} * ({f}_q3 - {f}_q1))"
        hi = f"({f}_q3 + {k} * ({f}_q3 - {f}_q1))"
        caps.append(f"CASE WHEN {f} IS NULL THEN NULL WHEN {f}_q3 - {f}_q1 = 0 THEN CAST({f} AS DOUBLE) ELSE greatest(least(CAST({f} AS DOUBLE), {hi}), {lo}) END AS {f}")
    ctes.append(f"c1 AS (SELECT d1.* REPLACE ({', '.join(caps)}) FROM d1, b1)")
    return ",\n".join(ctes), "c1"


def outlier_count_sql(rel: str, k: float = 3.0, guard: bool = True) -> str:
    parts = []
    for f in OUTLIER_FIELDS:
        g = f" AND {f}_q3 - {f}_q1 <> 0" if guard else ""
        parts.append(f"(SELECT count(*) FROM {rel}, b1 WHERE ({f} < {f}_q1 - {k} * ({f}_q3 - {f}_q1) "
                     f"OR {f} > {f}_q3 + {k} * ({f}_q3 - {f}_q1)){g})")
    return " + ".join(parts)
