"""Profiling queries: missing values, numeric/text/column profiles, counts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from logsift.operators import stats as S
from logsift.operators.quantiles import quantile_long, select_ranks
from logsift.plans.oracle_views import with_views
from logsift.plans.registry import query
from logsift.plans.views import LOG_DATA_COLUMNS, dup_logs, logs, table

LOG_COLS_SQL = ", ".join(f'"{c}"' if c == "timestamp" else c for c in LOG_DATA_COLUMNS)


def _missing_sql(src: str, cols_types: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, t) in enumerate(cols_types):
        q = f'"{c}"'
        parts.append(f"SELECT {i} AS ordinal, '{c}' AS \"column\", '{t}' AS dtype, "
                     f"CAST(count(*) - count({q}) AS BIGINT) AS missing_count, "
                     f"CAST(count({q}) AS BIGINT) AS non_missing_count, "
                     f"coalesce(round(CAST(count(*) - count({q}) AS DOUBLE) * 100 / nullif(count(*), 0), 2), 0.0) "
                     f"AS missing_pct FROM {src}")
    return "\nUNION ALL\n".join(parts)


LOG_TYPES = [("log_id", "bigint"), ("timestamp", "timestamp"), ("log_level", "string"), ("server_id", "string"),
             ("pod_name", "string"), ("namespace", "string"), ("message", "string"),
             ("container_name", "string"), ("node_name", "string"), ("service", "string"),
             ("cpu_usage_percent", "double"), ("memory_usage_mb", "double"), ("network_bytes", "bigint"),
             ("is_anomaly", "bigint"), ("anomaly_type", "string")]


@query("missing_stats", with_views(_missing_sql("logs", LOG_TYPES), "logs"))
def q_missing_stats(spark, sf):
    """D1 + H24 over the log view."""
    return S.missing_stats(logs(spark, sf))


@query("missing_overall", with_views(f"""
SELECT CAST(max(missing_count + non_missing_count) AS BIGINT) AS total_rows,
       CAST(sum(missing_count) AS BIGINT) AS total_missing,
       coalesce(round(CAST(sum(missing_count) AS DOUBLE) * 100
                      / nullif(max(missing_count + non_missing_count) * {len(LOG_TYPES)}, 0), 2), 0.0)
         AS overall_missing_pct,
       string_agg(CASE WHEN missing_count > 0 THEN "column" END, ',' ORDER BY ordinal) AS columns_with_missing
FROM m""", "logs", more=f"m AS ({_missing_sql('logs', LOG_TYPES)})"))
def q_missing_overall(spark, sf):
    """D2 over the log view."""
    return S.missing_overall(logs(spark, sf))


def _numeric_profile_sql(src: str, cols: list[str], k: float, guard: bool) -> str:
    parts = []
    for c in cols:
        g = "AND q3 - q1 <> 0" if guard else ""
        parts.append(f"""
SELECT '{c}' AS "column", round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median,
       round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max,
       round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.75), 6) AS q75,
       (SELECT count(*) FROM (SELECT CAST({c} AS DOUBLE) AS y FROM {src}) t2,
          (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
           FROM {src}) qq
        WHERE (y < q1 - {k} * (q3 - q1) OR y > q3 + {k} * (q3 - q1)) {g}) AS outliers_iqr
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {src}) t""")
    return "\nUNION ALL\n".join(parts)


LOG_NUMERIC = ["cpu_usage_percent", "memory_usage_mb", "network_bytes", "is_anomaly"]
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_profile_logs", with_views(_numeric_profile_sql("logs", LOG_NUMERIC, 3.0, True), "logs"))
def q_numeric_profile_logs(spark, sf):
    """D3 + D4 + H14 (k=3, guarded) over the log view."""
    return S.numeric_profile(logs(spark, sf), LOG_NUMERIC, 3.0, True)


@query("numeric_profile_lineitem", _numeric_profile_sql("lineitem", LINEITEM_NUMERIC, 3.0, True))
def q_numeric_profile_lineitem(spark, sf):
    """D3 + D4 + H14 over lineitem."""
    return S.numeric_profile(table(spark, sf, "lineitem"), LINEITEM_NUMERIC, 3.0, True)


def _text_profile_sql(src: str, cols: list[str]) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {src}" for c in cols)
    return f"""
, long AS ({long}),
vc AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY "column", value),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rn FROM vc)
SELECT "column", count(*) AS unique_count, max(CASE WHEN rn = 1 THEN value END) AS most_frequent,
       round(CAST(sum(length(value) * n) AS DOUBLE) / sum(n), 6) AS avg_length,
       CAST(max(length(value)) AS BIGINT) AS max_length
FROM r GROUP BY "column"
"""


LOG_STRINGS = ["log_level", "server_id", "pod_name", "namespace", "message", "service", "anomaly_type"]


def _ctes(text: str) -> tuple[str, str]:
    """Split '<, cte defs> SELECT ...' into (defs, body)."""
    i = text.index("\nSELECT")
    return text[:i].lstrip().lstrip(","), text[i:]


_tp_logs = _ctes(_text_profile_sql("logs", LOG_STRINGS))
_tp_conv = _ctes(_text_profile_sql("conversations", ["role", "text"]))


@query("text_profile_logs", with_views(_tp_logs[1], "logs", more=_tp_logs[0]))
def q_text_profile_logs(spark, sf):
    """D5 + D6 over the log view's string columns."""
    return S.text_profile(logs(spark, sf), LOG_STRINGS)


@query("text_profile_conversations", "WITH " + _tp_conv[0] + _tp_conv[1])
def q_text_profile_conversations(spark, sf):
    """D5 + D6 over whole conversation texts."""
    return S.text_profile(table(spark, sf, "conversations"), ["role", "text"])


CUSTOMER_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                  ("c_acctbal", "double"), ("c_mktsegment", "string")]


def _column_profile_sql(src, cols_types):
    parts = []
    for c, t in cols_types:
        num = t in ("bigint", "int", "double")
        agg = (lambda f: f"round({f}(CAST({c} AS DOUBLE)), 6)") if num else (lambda f: "CAST(NULL AS DOUBLE)")
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
  count(*) - count({c}) AS null_count,
  coalesce(round(CAST(count(*) - count({c}) AS DOUBLE) * 100 / nullif(count(*), 0), 2), 0.0) AS null_pct,
  count(DISTINCT {c}) AS "unique", {agg('avg')} AS mean, {agg('min')} AS min, {agg('max')} AS max FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@query("column_profile_customer", _column_profile_sql("customer", CUSTOMER_TYPES))
def q_column_profile_customer(spark, sf):
    """J12 + D9 over customer."""
    return S.column_profile(table(spark, sf, "customer"))


@query("value_counts_level", with_views("""
SELECT log_level, n, round(CAST(n AS DOUBLE) * 100 / sum(n) OVER (), 2) AS pct
FROM (SELECT log_level, count(*) AS n FROM logs GROUP BY log_level) g""", "logs"))
def q_value_counts_level(spark, sf):
    """Frequency table of log levels."""
    return S.value_counts(logs(spark, sf), "log_level")


@query("duplicate_rows", with_views(f"""
SELECT CAST(sum(c) AS BIGINT) AS total_rows, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows,
       coalesce(round(CAST(sum(c - 1) AS DOUBLE) * 100 / sum(c), 2), 0.0) AS duplicate_pct
FROM (SELECT count(*) AS c FROM dup_logs GROUP BY {LOG_COLS_SQL}) g""", "dup_logs"))
def q_duplicate_rows(spark, sf):
    """D8 (+E3 semantics): full-row duplicates over the log columns."""
    return S.duplicate_rows(dup_logs(spark, sf), list(LOG_DATA_COLUMNS))


ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("schema_info_orders", """
WITH long AS (SELECT o_orderkey AS pos, 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
              UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders),
f AS (SELECT "column", value, min(pos) AS first FROM long WHERE value IS NOT NULL GROUP BY "column", value),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY first) AS rn FROM f),
s AS (SELECT "column", string_agg(value, '|' ORDER BY first) AS sample_values FROM r WHERE rn <= 3 GROUP BY "column"),
d AS (SELECT "column", count(*) AS unique_values FROM f GROUP BY "column"),
t AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(ORDERS_TYPES)) + """)
      v(ordinal, "column", dtype))
SELECT t.ordinal, t."column", t.dtype, d.unique_values, s.sample_values
FROM t LEFT JOIN d USING ("column") LEFT JOIN s USING ("column")""")
def q_schema_info_orders(spark, sf):
    """D26 + D10: types, distinct counts and first-seen samples of orders."""
    return S.schema_info(table(spark, sf, "orders"), "o_orderkey", 3)


@query("basic_stats_orders", """
SELECT count(*) AS num_rows, CAST(6 AS BIGINT) AS num_columns,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS column_names FROM orders""")
def q_basic_stats_orders(spark, sf):
    """D27."""
    return S.basic_stats(table(spark, sf, "orders"))


@query("sample_values_priority", """
SELECT o_orderpriority, min(o_orderkey) AS _first FROM orders WHERE o_orderpriority IS NOT NULL
GROUP BY o_orderpriority ORDER BY _first LIMIT 5""")
def q_sample_values_priority(spark, sf):
    """First five distinct priorities by first appearance (top-k is the feature)."""
    return S.sample_values(table(spark, sf, "orders"), "o_orderpriority", 5, "o_orderkey")


QB_PS = [0.01, 0.25, 0.5, 0.75, 0.95, 0.99]
QB_NAMES = ["p01", "q25", "median", "q75", "p95", "p99"]


def _quantile_bounds_sql():
    parts = []
    for c in LINEITEM_NUMERIC:
        qs = ", ".join(f"round(quantile_cont({c}, {p}), 6) AS {n}" for p, n in zip(QB_PS, QB_NAMES))
        parts.append(f"SELECT '{c}' AS \"column\", {qs} FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@query("quantile_bounds", _quantile_bounds_sql())
def q_quantile_bounds(spark, sf):
    """D3 exact quantiles over lineitem."""
    q = quantile_long(table(spark, sf, "lineitem"), LINEITEM_NUMERIC, QB_PS, QB_NAMES)
    return q.select("column", *[F.round(n, 6).alias(n) for n in QB_NAMES])


@query("quantile_bounds_rank", _quantile_bounds_sql())
def q_quantile_bounds_rank(spark, sf):
    """D3 exact order statistics at given ranks, interpolated in Spark."""
    rows = table(spark, sf, "lineitem")
    n = rows.count()
    places = [p * (n - 1) for p in QB_PS]
    ranks = sorted({int(f(x)) for x in places for f in (math.floor, math.ceil)})
    _, at = select_ranks(rows, LINEITEM_NUMERIC, lambda _: F.array(*[F.lit(r).cast("long") for r in ranks]))
    known = spark.createDataFrame([(c, r, v) for (c, r), v in at.items()], "column string, rank long, v double")
    one = lambda r: F.max(F.when(F.col("rank") == int(r), F.col("v")))
    q = known.groupBy("column").agg(*[
        F.round(one(math.floor(x)) + (one(math.ceil(x)) - one(math.floor(x))) * (x - math.floor(x)), 6).alias(m) for x, m in zip(places, QB_NAMES)])
    return q.select("column", *QB_NAMES)


@query("time_range_events", """
SELECT min(ts) AS first_ts, max(ts) AS last_ts, span_days, count(*) AS total,
       CAST(CASE WHEN span_days > 0 THEN floor(count(*) / span_days) ELSE 0 END AS BIGINT) AS per_day
FROM events, (SELECT CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) AS BIGINT) AS span_days
              FROM events) s
GROUP BY span_days""")
def q_time_range_events(spark, sf):
    """D17 + H13 over events."""
    return S.time_range(table(spark, sf, "events"), "ts")


@query("label_stats", """
SELECT count(*) AS n, count(*) FILTER (WHERE toxic = 0) AS n_label0, count(*) FILTER (WHERE toxic = 1) AS n_label1,
       coalesce(round(CAST(count(*) FILTER (WHERE toxic = 1) AS DOUBLE) * 100 / count(*), 2), 0.0) AS anomaly_pct,
       coalesce(round(CAST(abs(count(*) FILTER (WHERE toxic = 0) - count(*) FILTER (WHERE toxic = 1)) AS DOUBLE)
                      * 100 / count(*), 2), 0.0) AS class_imbalance
FROM labels""")
def q_label_stats(spark, sf):
    """D11 with label = toxic."""
    return S.label_stats(table(spark, sf, "labels").withColumnRenamed("toxic", "label"))


@query("label_summary", """
SELECT quality, count(*) AS n, count(*) FILTER (WHERE toxic = 0) AS normal, CAST(sum(toxic) AS BIGINT) AS anomalous,
       coalesce(round(CAST(sum(toxic) AS DOUBLE) * 100 / count(*), 2), 0.0) AS anomaly_rate
FROM labels GROUP BY quality""")
def q_label_summary(spark, sf):
    """Per-group label counts (group = quality)."""
    return S.label_summary(table(spark, sf, "labels").withColumnRenamed("toxic", "label"), "quality")
