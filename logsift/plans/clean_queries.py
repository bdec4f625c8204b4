"""Outlier, duplicate, missing-value, text, time, cleaning and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.contracts import K8S_LOG, OUTLIER_FIELDS, Contract, FieldRule
from logsift.functions import outlier as O
from logsift.functions import text as TX
from logsift.functions.time import iso_utc, parse_ts, to_ntz
from logsift.operators import clean as C
from logsift.operators import dedup as D
from logsift.operators import stats as S
from logsift.operators import validate as V
from logsift.operators.positions import with_position
from logsift.operators.quantiles import quantile_values
from logsift.plans import clean_sql as CS
from logsift.plans.oracle_views import with_views
from logsift.plans.registry import query
from logsift.plans.views import LOG_DATA_COLUMNS, dup_logs, logs, table

LOG_NUMERIC = ["cpu_usage_percent", "memory_usage_mb", "network_bytes"]
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LOG_PRESENT = ["log_id"] + list(LOG_DATA_COLUMNS)


# --- H14, H15 ---------------------------------------------------------------

def _iqr_table(df, cols, k, guard):
    qs = quantile_values(df, cols, [0.25, 0.75])
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        q1, q3 = qs[c]
        aggs.append(F.count_if(O.iqr_flag(F.col(c).cast("double"), F.lit(q1), F.lit(q3), k, guard)).alias(c))
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(qs[c][0]).cast("double").alias("q1"),
                             F.lit(qs[c][1]).cast("double").alias("q3"), F.col(c).alias("outliers")) for c in cols])
    out = row.select("_n", F.inline(arr))
    lo, hi = O.iqr_bounds("q1", "q3", k)
    return out.select("column", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"),
                      F.round(lo, 6).alias("lower"), F.round(hi, 6).alias("upper"), "outliers",
                      F.round(F.col("outliers") * 100.0 / F.col("_n"), 2).alias("outlier_pct"))


def _iqr_sql(src, cols, k, guard):
    parts = []
    for c in cols:
        g = "AND q3 - q1 <> 0" if guard else ""
        parts.append(f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q1 - {k} * (q3 - q1), 6) AS lower, round(q3 + {k} * (q3 - q1), 6) AS upper,
  count(*) FILTER (WHERE (CAST({c} AS DOUBLE) < q1 - {k} * (q3 - q1) OR CAST({c} AS DOUBLE) > q3 + {k} * (q3 - q1)) {g})
    AS outliers,
  round(count(*) FILTER (WHERE (CAST({c} AS DOUBLE) < q1 - {k} * (q3 - q1) OR CAST({c} AS DOUBLE) > q3 + {k} * (q3 - q1)) {g})
    * 100.0 / count(*), 2) AS outlier_pct
FROM {src}, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
             FROM {src}) qq GROUP BY q1, q3""")
    return "\nUNION ALL\n".join(parts)


@query("iqr_outliers_clean", with_views(_iqr_sql("logs", LOG_NUMERIC, 3.0, True), "logs"))
def q_iqr_outliers_clean(spark, sf):
    """H14 cleaning preset: k=3, IQR=0 guarded."""
    return _iqr_table(logs(spark, sf), LOG_NUMERIC, 3.0, True)


@query("iqr_outliers_audit", _iqr_sql("lineitem", LINEITEM_NUMERIC, 1.5, False))
def q_iqr_outliers_audit(spark, sf):
    """H14 audit preset: k=1.5, unguarded."""
    return _iqr_table(table(spark, sf, "lineitem"), LINEITEM_NUMERIC, 1.5, False)


@query("zscore_outliers", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", round(m, 6) AS mean, round(sd, 6) AS std,
  count(*) FILTER (WHERE sd <> 0 AND abs(({c} - m) / sd) > 3.0) AS outliers
FROM lineitem, (SELECT avg({c}) AS m, stddev_samp({c}) AS sd FROM lineitem) s GROUP BY m, sd""" for c in LINEITEM_NUMERIC))
def q_zscore_outliers(spark, sf):
    """|z| > 3 with ddof=1."""
    li = table(spark, sf, "lineitem")
    st = li.agg(*[x for c in LINEITEM_NUMERIC
                  for x in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]).first()
    row = li.agg(*[F.count_if(O.zscore_flag(c, F.lit(st[f"m_{c}"]), F.lit(st[f"s_{c}"]), 3.0)).alias(f"o_{c}")
                   for c in LINEITEM_NUMERIC])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.round(F.lit(st[f"m_{c}"]), 6).alias("mean"),
                             F.round(F.lit(st[f"s_{c}"]), 6).alias("std"), F.col(f"o_{c}").alias("outliers"))
                    for c in LINEITEM_NUMERIC])
    return row.select(F.inline(arr))


# --- H16-H18, I6 --------------------------------------------------------------

def _bounds_sql(src, cols, extra=""):
    return ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_q3"
                     + (f", quantile_cont(CAST({c} AS DOUBLE), 0.01) AS {c}_p01, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS {c}_p99" if extra else "")
                     for c in cols)


def _has_out(c, k=3.0):
    return (f"(SELECT count(*) FROM logs, b WHERE {c}_q3 - {c}_q1 <> 0 AND "
            f"(CAST({c} AS DOUBLE) < {c}_q1 - {k} * ({c}_q3 - {c}_q1) OR CAST({c} AS DOUBLE) > {c}_q3 + {k} * ({c}_q3 - {c}_q1))) > 0")


def _cap_sql():
    sel = ", ".join(f"""round(CASE WHEN {c} IS NULL THEN NULL WHEN {_has_out(c)}
  THEN greatest(least(CAST({c} AS DOUBLE), {c}_q3 + 3.0 * ({c}_q3 - {c}_q1)), {c}_q1 - 3.0 * ({c}_q3 - {c}_q1))
  ELSE CAST({c} AS DOUBLE) END, 6) AS {c}""" for c in LOG_NUMERIC)
    return with_views(f"SELECT log_id, {sel} FROM logs, b", "logs", more=f"b AS (SELECT {_bounds_sql('logs', LOG_NUMERIC)} FROM logs)")


@query("cap_outliers", _cap_sql())
def q_cap_outliers(spark, sf):
    """I6 + H16: cap the configured fields at k=3 IQR bounds when they have outliers."""
    df, _ = C.cap_outliers(logs(spark, sf), LOG_NUMERIC)
    return df.select("log_id", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in LOG_NUMERIC])


def _winsor_sql():
    sel = ", ".join(f"""round(CASE WHEN {c} IS NULL THEN NULL WHEN {_has_out(c)}
  THEN greatest(least(CAST({c} AS DOUBLE), {c}_p99), {c}_p01) ELSE CAST({c} AS DOUBLE) END, 6) AS {c}"""
                    for c in LOG_NUMERIC)
    return with_views(f"SELECT log_id, {sel} FROM logs, b", "logs",
                      more=f"b AS (SELECT {_bounds_sql('logs', LOG_NUMERIC, True)} FROM logs)")


@query("winsorise", _winsor_sql())
def q_winsorise(spark, sf):
    """Cap at p1/p99 when the field has outliers."""
    df = C.winsorise(logs(spark, sf), LOG_NUMERIC)
    return df.select("log_id", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in LOG_NUMERIC])


@query("drop_outliers", with_views("SELECT log_id FROM logs, b WHERE NOT (" + " OR ".join(
    f"coalesce({c}_q3 - {c}_q1 <> 0 AND (CAST({c} AS DOUBLE) < {c}_q1 - 3.0 * ({c}_q3 - {c}_q1) OR "
    f"CAST({c} AS DOUBLE) > {c}_q3 + 3.0 * ({c}_q3 - {c}_q1)), false)" for c in LOG_NUMERIC) + ")", "logs",
    more=f"b AS (SELECT {_bounds_sql('logs', LOG_NUMERIC)} FROM logs)"))
def q_drop_outliers(spark, sf):
    """Remove rows with an outlier in any configured field."""
    return C.drop_outliers(logs(spark, sf), LOG_NUMERIC).select("log_id")


# --- E1-E3 ----------------------------------------------------------------------

@query("dedup_window", with_views("""
SELECT log_id, log_id <> min(log_id) OVER (PARTITION BY date_trunc('second', "timestamp"), pod_name, message)
  AS is_duplicate FROM dup_logs""", "dup_logs"))
def q_dedup_window(spark, sf):
    """E1 + H12: duplicate flag on (timestamp floored to 1 s, pod, message), first kept."""
    return D.flag_duplicates(dup_logs(spark, sf), ["timestamp", "pod_name", "message"], "log_id") \
        .select("log_id", "is_duplicate")


@query("drop_duplicates", with_views("""
SELECT log_id FROM dup_logs WHERE log_id IN (
  SELECT min(log_id) FROM dup_logs GROUP BY date_trunc('second', "timestamp"), pod_name, message)""", "dup_logs"))
def q_drop_duplicates(spark, sf):
    """Keep the first row of every duplicate group."""
    return D.drop_duplicates(dup_logs(spark, sf), ["timestamp", "pod_name", "message"], "log_id").select("log_id")


@query("row_duplicates", with_views(f"""
SELECT log_id, log_id <> min(log_id) OVER (PARTITION BY {", ".join(f'"{c}"' for c in LOG_DATA_COLUMNS)})
  AS is_duplicate FROM dup_logs""", "dup_logs"))
def q_row_duplicates(spark, sf):
    """Exact-row duplicates (all data columns), first kept."""
    return D.flag_row_duplicates(dup_logs(spark, sf), "log_id", list(LOG_DATA_COLUMNS)).select("log_id", "is_duplicate")


# --- I1-I5 ------------------------------------------------------------------------

_mlog = CS.missing_log_sql("logs", LOG_PRESENT)


@query("critical_rule", with_views(_mlog[1], "logs", more=_mlog[0]))
def q_critical_rule(spark, sf):
    """I1 + I2 + I5: sequential missing-value rule, replayed from a null-pattern histogram."""
    plan = C.plan_missing(logs(spark, sf), K8S_LOG)
    rows = [(s, f, a, c, cum) for (s, _, f, a, _, c, _, cum) in plan.log]
    return spark.createDataFrame(rows, "step_no long, field string, action string, count long, "
                                       "rows_removed_cumulative long")


_mc = CS.missing_chain("logs", LOG_PRESENT)


@query("missing_filtered", with_views(f"SELECT log_id FROM {_mc[1]}", "logs", more=_mc[0]))
def q_missing_filtered(spark, sf):
    """B1 + I1 + I2: the rows that survive the missing-value rules."""
    lg = logs(spark, sf)
    plan = C.plan_missing(lg, K8S_LOG)
    return C.apply_missing(lg, plan).select("log_id")


NULLABLE_LOGS = Contract("logs_nullable", (
    FieldRule("pod_name", "string", nullable=True),
    FieldRule("message", "string", nullable=True),
    FieldRule("cpu_usage_percent", "float", nullable=True),
))


def _fill_query(spark, sf):
    lg = logs(spark, sf)
    plan = C.plan_missing(lg, NULLABLE_LOGS, critical=())
    return C.apply_missing(lg, plan), plan


@query("fill_missing", with_views("""
SELECT log_id, coalesce(pod_name, (SELECT value FROM mode_pod)) AS pod_name,
       coalesce(message, (SELECT value FROM mode_msg)) AS message,
       round(coalesce(cpu_usage_percent, (SELECT quantile_cont(cpu_usage_percent, 0.5) FROM logs)), 6)
         AS cpu_usage_percent
FROM logs""", "logs", more="""
mode_pod AS (SELECT pod_name AS value FROM logs WHERE pod_name IS NOT NULL GROUP BY pod_name
             ORDER BY count(*) DESC, pod_name LIMIT 1),
mode_msg AS (SELECT message AS value FROM logs WHERE message IS NOT NULL GROUP BY message
             ORDER BY count(*) DESC, message LIMIT 1)"""))
def q_fill_missing(spark, sf):
    """I3 + I4: nullable numeric -> median, nullable string -> mode (smallest on ties)."""
    df, _ = _fill_query(spark, sf)
    return df.select("log_id", "pod_name", "message", F.round("cpu_usage_percent", 6).alias("cpu_usage_percent"))


@query("imputation_log", with_views("""
SELECT * FROM (VALUES (1, 'pod_name', 'filled_with_mode'), (2, 'message', 'filled_with_mode'),
                      (3, 'cpu_usage_percent', 'filled_with_median')) v(step_no, field, action)
JOIN (SELECT 'pod_name' AS field, count(*) - count(pod_name) AS "count",
             (SELECT value FROM mode_pod) AS fill_value FROM logs
      UNION ALL SELECT 'message', count(*) - count(message), (SELECT value FROM mode_msg) FROM logs
      UNION ALL SELECT 'cpu_usage_percent', count(*) - count(cpu_usage_percent),
             CAST(quantile_cont(cpu_usage_percent, 0.5) AS VARCHAR) FROM logs) c USING (field)
WHERE "count" > 0""", "logs", more="""
mode_pod AS (SELECT pod_name AS value FROM logs WHERE pod_name IS NOT NULL GROUP BY pod_name
             ORDER BY count(*) DESC, pod_name LIMIT 1),
mode_msg AS (SELECT message AS value FROM logs WHERE message IS NOT NULL GROUP BY message
             ORDER BY count(*) DESC, message LIMIT 1)"""))
def q_imputation_log(spark, sf):
    """Field, action, fill value and count of every fill."""
    _, plan = _fill_query(spark, sf)
    rows = [(s, f, a, c, v) for (s, _, f, a, v, c, _, _) in plan.log]
    return spark.createDataFrame(rows, "step_no int, field string, action string, count long, fill_value string")


# --- H1-H5 -----------------------------------------------------------------------

@query("clean_text", f"""
SELECT doc_id, {CS.text_clean_sql('text', None)} AS text_clean,
  text IS DISTINCT FROM {CS.text_clean_sql('text', None)} AS changed FROM documents""")
def q_clean_text(spark, sf):
    """H2 -> H1 -> H4 -> trim on whole documents (JVM-side regexes)."""
    d = table(spark, sf, "documents")
    t = TX.clean_text_no_nfkd("text")
    return d.select("doc_id", t.alias("text_clean"), TX.changed("text", t).alias("changed"))


@query("standardise_text")
def q_standardise_text(spark, sf):
    """H5 in full (NFKD first) on whole documents; no SQL oracle (DuckDB has no
    NFKD) - tests compare with the Python standard library row by row."""
    d = table(spark, sf, "documents")
    t = TX.standardise_text("text")
    return d.select("doc_id", t.alias("text_std"), TX.changed("text", t).alias("changed"))


@query("nfkd_text")
def q_nfkd_text(spark, sf):
    """H3 alone (Arrow-batched, ASCII fast path); checked against unicodedata in tests."""
    d = table(spark, sf, "documents")
    n = TX.nfkd("text")
    return d.select("doc_id", n.alias("text_nfkd"), F.length(n).alias("n_chars_nfkd"))


# --- H8-H11, F1 --------------------------------------------------------------------

def _render(ts, pos):
    """The eight contract formats, picked by position, and a time of day without a date (test-input derivation)."""
    plus2 = ts + F.expr("INTERVAL 2 HOURS")
    fmts = [F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
            F.concat(F.date_format(plus2, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")),
            F.concat(F.date_format(plus2, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0200")),
            F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")),
            F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))]
    out = None
    for i, f in enumerate(fmts):
        out = F.when(pos % 8 == i, f) if out is None else out.when(pos % 8 == i, f)
    return F.when(pos % 23 == 0, F.date_format(ts, "HH:mm:ss")).otherwise(out)


@query("parse_timestamps", with_views("""
SELECT log_id, raw, parsed, strftime(parsed, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM (
 SELECT log_id,
  CASE WHEN log_id % 23 = 0 THEN strftime("timestamp", '%H:%M:%S') ELSE CASE log_id % 8
   WHEN 0 THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f')
   WHEN 1 THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
   WHEN 2 THEN strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f')
   WHEN 3 THEN strftime("timestamp", '%Y-%m-%d %H:%M:%S')
   WHEN 4 THEN strftime("timestamp" + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00'
   WHEN 5 THEN strftime("timestamp" + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0200'
   WHEN 6 THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
   ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || 'Z' END END AS raw,
  CASE WHEN log_id % 23 = 0 THEN NULL WHEN log_id % 8 IN (0, 2, 4, 6) THEN "timestamp" ELSE date_trunc('second', "timestamp") END AS parsed
 FROM logs) t""", "logs"))
def q_parse_timestamps(spark, sf):
    """Text in the eight contract formats -> UTC TIMESTAMP -> ISO text."""
    lg = logs(spark, sf)
    raw = _render(F.col("timestamp"), F.col("log_id"))
    p = parse_ts(raw)
    return lg.select("log_id", raw.alias("raw"), to_ntz(p).alias("parsed"), iso_utc(p).alias("iso"))


@query("temporal_order", with_views("""
SELECT log_id, "timestamp", row_number() OVER (ORDER BY "timestamp" NULLS LAST, log_id) - 1 AS order_pos
FROM dup_logs""", "dup_logs"))
def q_temporal_order(spark, sf):
    """global time order with positions (range sort + per-partition offsets)."""
    d = dup_logs(spark, sf).select("log_id", "timestamp")
    p = with_position(d, [F.asc_nulls_last("timestamp"), F.asc("log_id")], "order_pos")
    return p.select("log_id", to_ntz("timestamp").alias("timestamp"), "order_pos")


# --- I7 and its reports --------------------------------------------------------------

_cc = CS.clean_chain("dup_logs", LOG_PRESENT)
CLEAN_OUT = ["log_id", "timestamp", "log_level", "server_id", "pod_name", "namespace", "message", "container_name",
             "node_name", "service", "cpu_usage_percent", "memory_usage_mb", "network_bytes", "is_anomaly",
             "anomaly_type"]


def _clean_select_sql(rel):
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" if c in OUTLIER_FIELDS else f'"{c}"' for c in CLEAN_OUT)


def cleaned(spark, sf):
    return C.clean(dup_logs(spark, sf), "log_id", K8S_LOG)


@query("clean_logs", with_views(f"SELECT {_clean_select_sql('c1')} FROM {_cc[1]}", "dup_logs", more=_cc[0]))
def q_clean_logs(spark, sf):
    """The whole cleaning pipeline over the duplicated log view."""
    r = cleaned(spark, sf)
    return r.data.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if c in OUTLIER_FIELDS
                           else (to_ntz(c).alias(c) if c == "timestamp" else F.col(c)) for c in CLEAN_OUT])


_summary_body = f"""
SELECT * FROM (VALUES
 ('initial_rows', (SELECT count(*) FROM dup_logs)),
 ('rows_after_missing', (SELECT count(*) FROM {_cc[1].replace('c1', 'm6')})),
 ('timestamps_valid', (SELECT count("timestamp") FROM t1)),
 ('timestamps_unparsed', (SELECT count(*) - count("timestamp") FROM t1)),
 ('text_standardized', (SELECT count(*) FROM t1 WHERE message IS DISTINCT FROM _old_message)),
 ('duplicates_removed', (SELECT count(*) FROM t1) - (SELECT count(*) FROM d1)),
 ('outliers_detected', {CS.outlier_count_sql('d1')}),
 ('missing_filled', 0),
 ('final_rows', (SELECT count(*) FROM d1)),
 ('rows_removed', (SELECT count(*) FROM dup_logs) - (SELECT count(*) FROM d1))
) v(metric, value)"""


@query("clean_summary", with_views(
    "SELECT metric, CAST(value AS BIGINT) AS value FROM (" + _summary_body + ") s", "dup_logs", more=_cc[0]))
def q_clean_summary(spark, sf):
    """I7 row accounting: every step's count, initial = final + removed."""
    return cleaned(spark, sf).summary


_cut_chain, _cut_last = CS.missing_chain("dup_logs", LOG_PRESENT)


@query("clean_cut", with_views(f"""
SELECT 'text_cut' AS metric, count(*) FILTER (WHERE length(whole) > 10000) AS value FROM cut
UNION ALL
SELECT 'duplicates_removed', (SELECT count(*) FROM cut) - count(*)
FROM (SELECT DISTINCT date_trunc('second', "timestamp"), pod_name, short FROM cut) d""", "dup_logs", more=_cut_chain + f""",
cut AS (SELECT *, {CS.text_clean_sql('message')} AS whole, {CS.text_clean_sql('message', 10000)} AS short FROM {_cut_last})"""))
def q_clean_cut(spark, sf):
    """H4: messages cut to an explicit length, the values cut, and the duplicates that this makes."""
    s = C.clean(dup_logs(spark, sf), "log_id", K8S_LOG, max_length=10000).summary
    return s.where(F.col("metric").isin("text_cut", "duplicates_removed"))


@query("quality_gates", with_views(f"""
SELECT gate, round(v, 2) AS value, threshold,
       CASE WHEN (op = '>=' AND v >= threshold) OR (op = '<=' AND v <= threshold) THEN 'pass' ELSE 'warn' END
         AS status
FROM (SELECT * FROM (VALUES
  ('retention_rate', (SELECT value FROM s WHERE metric = 'final_rows') * 100.0
                      / (SELECT value FROM s WHERE metric = 'initial_rows'), CAST(95.0 AS DOUBLE), '>='),
  ('missing_rate', (SELECT value FROM s WHERE metric = 'missing_filled') * 100.0
                    / (SELECT value FROM s WHERE metric = 'initial_rows'), CAST(5.0 AS DOUBLE), '<='),
  ('duplicate_rate', (SELECT value FROM s WHERE metric = 'duplicates_removed') * 100.0
                      / (SELECT value FROM s WHERE metric = 'initial_rows'), CAST(5.0 AS DOUBLE), '<='),
  ('outlier_rate', (SELECT value FROM s WHERE metric = 'outliers_detected') * 100.0
                    / (SELECT value FROM s WHERE metric = 'initial_rows'), CAST(1.0 AS DOUBLE), '<='))
  v(gate, v, threshold, op)) g""", "dup_logs",
    more=_cc[0] + ",\ns AS (SELECT metric, CAST(value AS DOUBLE) AS value FROM (" + _summary_body + ") x)"))
def q_quality_gates(spark, sf):
    """J13 (+J15 status): retention, missing, duplicate and outlier rates against thresholds."""
    from logsift.operators.report import quality_gates
    return quality_gates(cleaned(spark, sf).summary)


@query("gate_recommendations", with_views(f"""
SELECT gate, CASE gate WHEN 'retention_rate' THEN 'Review the drop rules: too many rows removed'
                       WHEN 'missing_rate' THEN 'Investigate sources of missing values'
                       WHEN 'duplicate_rate' THEN 'Deduplicate upstream'
                       ELSE 'Check outlier sources and capping' END AS recommendation
FROM g WHERE NOT ((op = '>=' AND v >= threshold) OR (op = '<=' AND v <= threshold))
UNION ALL
SELECT NULL, 'All quality gates passed'
WHERE (SELECT count(*) FROM g WHERE NOT ((op = '>=' AND v >= threshold) OR (op = '<=' AND v <= threshold))) = 0""",
    "dup_logs", more=_cc[0] + ",\ns AS (SELECT metric, CAST(value AS DOUBLE) AS value FROM (" + _summary_body + """) x),
g AS (SELECT * FROM (VALUES
  ('retention_rate', (SELECT value FROM s WHERE metric = 'final_rows') * 100.0
                      / (SELECT value FROM s WHERE metric = 'initial_rows'), 95.0, '>='),
  ('missing_rate', (SELECT value FROM s WHERE metric = 'missing_filled') * 100.0
                    / (SELECT value FROM s WHERE metric = 'initial_rows'), 5.0, '<='),
  ('duplicate_rate', (SELECT value FROM s WHERE metric = 'duplicates_removed') * 100.0
                      / (SELECT value FROM s WHERE metric = 'initial_rows'), 5.0, '<='),
  ('outlier_rate', (SELECT value FROM s WHERE metric = 'outliers_detected') * 100.0
                    / (SELECT value FROM s WHERE metric = 'initial_rows'), 1.0, '<='))
  v(gate, v, threshold, op))"""))
def q_gate_recommendations(spark, sf):
    """One recommendation per failing gate, or the all-clear line."""
    from logsift.operators.report import gate_recommendations, quality_gates
    return gate_recommendations(quality_gates(cleaned(spark, sf).summary))


@query("cleaning_summary", with_views(f"""
SELECT b."column", b.missing_before, coalesce(a.missing_after, 0) AS missing_after FROM
 (SELECT "column", missing_before FROM ({{before}}) x) b
 LEFT JOIN (SELECT "column", missing_after FROM ({{after}}) y) a USING ("column")""", "dup_logs", more=_cc[0])
    .replace("{before}", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count(\"{c}\") AS BIGINT) AS missing_before FROM dup_logs"
        for c in LOG_PRESENT))
    .replace("{after}", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count(\"{c}\") AS BIGINT) AS missing_after FROM c1"
        for c in LOG_PRESENT)))
def q_cleaning_summary(spark, sf):
    """Missing values per column before and after cleaning."""
    src = dup_logs(spark, sf)
    before = S.missing_stats(src).select("column", F.col("missing_count").alias("missing_before"))
    after = S.missing_stats(cleaned(spark, sf).data).select("column", F.col("missing_count").alias("missing_after"))
    return before.join(after, "column", "left").select(
        "column", "missing_before", F.coalesce("missing_after", F.lit(0)).cast("long").alias("missing_after"))


# --- J1-J6 -------------------------------------------------------------------------

def _validate_sql(strict: bool = False):
    parts = []
    src = "logs"
    for r in K8S_LOG:
        c = f'"{r.name}"'
        if strict:
            if not r.nullable:
                parts.append(f"""SELECT '{r.name}' AS field, 'not_null' AS rule, n AS invalid_count,
  CAST(NULL AS VARCHAR) AS sample, 'Field ''{r.name}'': ' || n || ' null values' AS message FROM (SELECT count(*) AS n FROM {src} WHERE {c} IS NULL) t WHERE n > 0""")
            if r.min_len is not None or r.max_len is not None:
                conds = []
                if r.min_len is not None:
                    conds.append(f"length({c}) >= {r.min_len}")
                if r.max_len is not None:
                    conds.append(f"length({c}) <= {r.max_len}")
                parts.append(f"""SELECT '{r.name}', 'length', n, CAST(NULL AS VARCHAR),
  'Field ''{r.name}'': ' || n || ' values outside length bounds'
FROM (SELECT count(*) AS n FROM {src} WHERE {c} IS NOT NULL AND NOT ({' AND '.join(conds)})) t WHERE n > 0""")
            if r.pattern is not None and r.name != "pod_name":
                pat = r.pattern.lstrip("^").rstrip("$")
                parts.append(f"""SELECT '{r.name}', 'pattern', n, CAST(NULL AS VARCHAR),
  'Field ''{r.name}'': ' || n || ' values do not match the pattern'
FROM (SELECT count(*) AS n FROM {src} WHERE {c} IS NOT NULL AND NOT regexp_full_match({c}, '{pat}')) t WHERE n > 0""")
        if r.allowed is not None:
            vals = ", ".join(repr(v) for v in r.allowed)
            bad = f"NOT coalesce({c} IN ({vals}), false)"
            quote = r.dtype == "string"
            shown = (f"CASE WHEN value IS NULL THEN 'None' ELSE '''' || value || '''' END" if quote
                     else "CASE WHEN value IS NULL THEN 'None' ELSE value END")
            parts.append(f"""SELECT '{r.name}' AS field, 'allowed_values' AS rule, n AS invalid_count, sample,
  'Field ''{r.name}'': ' || n || ' rows have invalid values. Sample: ' || sample AS message
FROM (SELECT (SELECT count(*) FROM {src} WHERE {bad}) AS n,
             (SELECT '[' || string_agg({shown}, ', ' ORDER BY first) || ']' FROM (
                SELECT CAST({c} AS VARCHAR) AS value, min(log_id) AS first FROM {src} WHERE {bad}
                GROUP BY CAST({c} AS VARCHAR) ORDER BY first LIMIT 5) s) AS sample) t WHERE n > 0""")
        if r.numeric:
            for rule, op, bound, word in (("below_min", "<", r.min, "below minimum"),
                                          ("above_max", ">", r.max, "above maximum")):
                if bound is None:
                    continue
                bt = repr(float(bound)) if isinstance(bound, float) else repr(bound)
                parts.append(f"""SELECT '{r.name}', '{rule}', n, CAST(NULL AS VARCHAR),
  'Field ''{r.name}'': ' || n || ' values {word} {bt}'
FROM (SELECT count(*) AS n FROM {src} WHERE {c} {op} {bound}) t WHERE n > 0""")
    pod = "regexp_full_match(pod_name, '[a-z0-9]([-a-z0-9]*[a-z0-9])?(\\.[a-z0-9]([-a-z0-9]*[a-z0-9])?)*')"
    ns = "regexp_full_match(namespace, '[a-z0-9]([-a-z0-9]*[a-z0-9])?') AND length(namespace) <= 253"
    parts.append(f"""SELECT 'pod_name', 'pod_name_format', n, CAST(NULL AS VARCHAR),
  'pod_name: ' || n || ' invalid pod names detected'
FROM (SELECT count(*) AS n FROM {src} WHERE NOT coalesce({pod}, false)) t WHERE n > 0""")
    parts.append(f"""SELECT 'namespace', 'namespace_format', n, CAST(NULL AS VARCHAR),
  'namespace: ' || n || ' invalid namespace names detected'
FROM (SELECT count(*) AS n FROM {src} WHERE NOT coalesce({ns}, false)) t WHERE n > 0""")
    return with_views("\nUNION ALL\n".join(parts), "logs")


@query("validate_contract_strict", _validate_sql(strict=True))
def q_validate_contract_strict(spark, sf):
    """J5 strict: adds not-null, length (B11) and node-name pattern checks the documents promise."""
    return V.validate(logs(spark, sf), K8S_LOG, pos_col="log_id", strict=True)


@query("validate_contract", _validate_sql())
def q_validate_contract(spark, sf):
    """Every contract check in one aggregate; samples in first-seen order."""
    return V.validate(logs(spark, sf), K8S_LOG, pos_col="log_id")


def error_list_sql(present=None) -> str:
    """The first failing rule of every contract field (of those ``present``) as a DuckDB list of messages."""
    per = []
    for r in K8S_LOG:
        if present is not None and r.name not in present:
            continue
        c = f'"{r.name}"'
        branches = [f"WHEN {c} IS NULL THEN 'Required field ''{r.name}'' is missing'"]
        if r.numeric:
            if r.min is not None:
                bt = repr(float(r.min)) if isinstance(r.min, float) else repr(r.min)
                branches.append(f"WHEN {c} < {r.min} THEN 'Field ''{r.name}'' value ' || CAST({c} AS VARCHAR) "
                                f"|| ' is below minimum {bt}'")
            if r.max is not None:
                bt = repr(float(r.max)) if isinstance(r.max, float) else repr(r.max)
                branches.append(f"WHEN {c} > {r.max} THEN 'Field ''{r.name}'' value ' || CAST({c} AS VARCHAR) "
                                f"|| ' is above maximum {bt}'")
        if r.allowed is not None:
            vals = ", ".join(repr(v) for v in r.allowed)
            lst = "[" + ", ".join(repr(v) for v in r.allowed) + "]"
            branches.append(f"WHEN {c} NOT IN ({vals}) THEN 'Field ''{r.name}'' value ''' || CAST({c} AS VARCHAR) "
                            f"|| ''' is not in allowed values {lst.replace(chr(39), chr(39) * 2)}'")
        per.append("CASE " + " ".join(branches) + " END")
    return "list_filter([" + ", ".join(per) + "], lambda x: x IS NOT NULL)"


def _row_errors_sql():
    return with_views(f"""SELECT log_id, CAST(len(m) AS BIGINT) AS n_errors, array_to_string(m, '; ') AS errors
FROM (SELECT log_id, {error_list_sql()} AS m FROM logs) t""", "logs")


@query("row_errors", _row_errors_sql())
def q_row_errors(spark, sf):
    """Per row, the first failing rule of every field, as messages."""
    return V.row_errors(logs(spark, sf), K8S_LOG, "log_id")
