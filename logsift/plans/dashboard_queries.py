"""Result-table and dashboard queries over the log view."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.functions.rules import filter_eq, severity_of_level
from logsift.functions.time import to_ntz
from logsift.operators import dashboards as DB
from logsift.plans import clean_sql as CS
from logsift.plans.clean_queries import LOG_PRESENT, cleaned
from logsift.plans.oracle_views import with_views
from logsift.plans.registry import query
from logsift.plans.views import anomalies, logs

STATUS_COLS = ["server_id", "total_logs", "error_count", "warning_count", "last_update", "max_cpu",
               "max_memory_mb", "anomaly_count", "status"]


def _status_out(st):
    return st.select(*[to_ntz(c).alias(c) if c == "last_update" else F.col(c) for c in STATUS_COLS])


def status_sql(logs_rel: str, anoms_rel: str) -> str:
    return f"""st0 AS (
 SELECT server_id, count(*) AS total_logs,
   count(*) FILTER (WHERE upper(log_level) IN ('ERROR', 'CRITICAL')) AS error_count,
   count(*) FILTER (WHERE upper(log_level) = 'WARNING') AS warning_count,
   max("timestamp") AS last_update, max(cpu_usage_percent) AS max_cpu, max(memory_usage_mb) AS max_memory_mb
 FROM {logs_rel} GROUP BY server_id),
ac AS (SELECT server_id, count(*) AS anomaly_count FROM {anoms_rel} GROUP BY server_id),
st1 AS (SELECT st0.*, CAST(coalesce(ac.anomaly_count, 0) AS BIGINT) AS anomaly_count
        FROM st0 LEFT JOIN ac USING (server_id)),
status AS (SELECT *, CASE
  WHEN coalesce(max_cpu / 100.0, 0) > 0.8 OR coalesce(max_memory_mb, 0) > 150000 OR anomaly_count > 580 THEN 'critical'
  WHEN coalesce(max_cpu / 100.0, 0) > 0.6 OR coalesce(max_memory_mb, 0) > 100000 OR anomaly_count > 550 THEN 'warning'
  WHEN coalesce(max_cpu / 100.0, 0) < 0.6 AND coalesce(max_memory_mb, 0) < 100000 AND anomaly_count < 550 THEN 'healthy'
  ELSE 'warning' END AS status FROM st1)"""


def _status(spark, sf):
    return DB.server_status(logs(spark, sf), anomalies(spark, sf))


@query("server_status", with_views("SELECT " + ", ".join(STATUS_COLS) + " FROM status", "logs", "anomalies",
                                   more=status_sql("logs", "anomalies")))
def q_server_status(spark, sf):
    """D20 + H19 + C2: per-server counts, peaks, anomaly lookup and status rule."""
    return _status_out(_status(spark, sf))


_cc = CS.clean_chain("dup_logs", LOG_PRESENT)
_clean_anoms = """ca AS (SELECT * FROM c1 WHERE is_anomaly = 1 OR coalesce(cpu_usage_percent > 100, false))"""


@query("server_status_clean", with_views("SELECT " + ", ".join(STATUS_COLS) + " FROM status", "dup_logs",
                                         more=_cc[0] + ",\n" + _clean_anoms + ",\n" + status_sql("c1", "ca")))
def q_server_status_clean(spark, sf):
    """Flagship: clean the duplicated log view (I7), then the server status table."""
    data = cleaned(spark, sf).data
    an = data.where((F.col("is_anomaly") == 1) | F.coalesce(F.col("cpu_usage_percent") > 100, F.lit(False)))
    return _status_out(DB.server_status(data, an))


@query("health_summary", with_views("""
SELECT count(*) FILTER (WHERE lower(status) = 'healthy') AS healthy,
       count(*) FILTER (WHERE lower(status) = 'warning') AS warning,
       count(*) FILTER (WHERE lower(status) = 'critical') AS critical FROM status""", "logs", "anomalies",
    more=status_sql("logs", "anomalies")))
def q_health_summary(spark, sf):
    """D25."""
    return DB.health_summary(_status(spark, sf))


@query("kpis", with_views("""
SELECT CAST(sum(total_logs) AS BIGINT) AS total_logs, CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies,
       count(*) AS servers,
       coalesce(round(CAST(sum(error_count) AS DOUBLE) * 100 / sum(total_logs), 2), 0.0) AS error_rate FROM status""",
    "logs", "anomalies", more=status_sql("logs", "anomalies")))
def q_kpis(spark, sf):
    """D16 from the status table."""
    return DB.kpis(_status(spark, sf))


HOURLY_SQL = """
SELECT date_trunc('hour', "timestamp") AS "timestamp", CASE WHEN GROUPING(server_id) = 1 THEN 'all' ELSE server_id END AS server_id, count(*) AS log_count,
       round(count(*) FILTER (WHERE upper(log_level) IN ('ERROR', 'CRITICAL')) / count(*), 6) AS error_rate,
       CAST(NULL AS DOUBLE) AS avg_response_time
FROM logs GROUP BY GROUPING SETS ((date_trunc('hour', "timestamp"), server_id), (date_trunc('hour', "timestamp")))"""


@query("hourly_metrics", with_views(HOURLY_SQL, "logs"))
def q_hourly_metrics(spark, sf):
    """1-hour tumbling windows per server plus 'all' (GROUPING SETS)."""
    return DB.hourly_metrics(logs(spark, sf))


@query("server_series", with_views(f"SELECT * FROM ({HOURLY_SQL}) h WHERE server_id = 'server-01'", "logs"))
def q_server_series(spark, sf):
    """F2 + B2: one server's hourly series (filter with 'All' pass-through)."""
    return filter_eq(DB.hourly_metrics(logs(spark, sf)), "server_id", "server-01").orderBy("timestamp")


@query("pipeline_statistics", with_views("""
SELECT count(*) AS total_logs, count(*) FILTER (WHERE is_anomaly = 1) AS total_anomalies,
       count(DISTINCT server_id) AS servers_monitored, min("timestamp") AS time_start, max("timestamp") AS time_end
FROM logs""", "logs"))
def q_pipeline_statistics(spark, sf):
    """D22."""
    return DB.pipeline_statistics(logs(spark, sf))


@query("pipeline_health", with_views("""
SELECT (SELECT count(*) FROM anomalies) AS anomalies_count, (SELECT count(*) FROM status) AS servers_count,
       (SELECT max(last_update) FROM status) AS last_update,
       coalesce(epoch_us((SELECT max("timestamp") FROM anomalies)) >=
                epoch_us((SELECT max(last_update) FROM status)) - 300000000, false) AS active""",
    "logs", "anomalies", more=status_sql("logs", "anomalies")))
def q_pipeline_health(spark, sf):
    """Counts and freshness from the result tables."""
    return DB.pipeline_health(anomalies(spark, sf), _status(spark, sf))


def _pivot_sql(key_expr, key_name, fill_zero, extra=""):
    cells = []
    for h in range(24):
        c = f"count(*) FILTER (WHERE hour(\"timestamp\") = {h})"
        cells.append(f'{c} AS "{h}"' if fill_zero else f'CASE WHEN {c} = 0 THEN NULL ELSE {c} END AS "{h}"')
    return f"SELECT {key_expr} AS {key_name}, {', '.join(cells)}{extra} FROM anomalies GROUP BY {key_expr}"


@query("calendar_heatmap", with_views(_pivot_sql('CAST("timestamp" AS DATE)', "date", True), "logs", "anomalies"))
def q_calendar_heatmap(spark, sf):
    """D13 + D15: anomalies per date x hour, 0-filled."""
    return DB.calendar_heatmap(anomalies(spark, sf))


@query("weekday_heatmap", with_views(_pivot_sql(
    'dayname("timestamp")', "weekday", False,
    ", CAST(list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'], "
    "dayname(\"timestamp\")) - 1 AS INTEGER) AS weekday_order"), "logs", "anomalies"))
def q_weekday_heatmap(spark, sf):
    """D14 + D15 + F6: anomalies per weekday x hour, Monday-first order, gaps null."""
    return DB.weekday_heatmap(anomalies(spark, sf))


@query("severity_distribution", with_views("""
SELECT severity, n, round(CAST(n AS DOUBLE) * 100 / sum(n) OVER (), 2) AS pct,
       CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END AS rank
FROM (SELECT severity, count(*) AS n FROM anomalies GROUP BY severity) g""", "logs", "anomalies"))
def q_severity_distribution(spark, sf):
    """D7 + H20 over the anomaly table."""
    return DB.severity_distribution(anomalies(spark, sf))


@query("alerts_by_severity", with_views("""
SELECT severity, count(*) AS n,
       CAST(list_position(['critical', 'high', 'warning', 'medium', 'low', 'info'], severity) - 1 AS INTEGER)
         AS display_order
FROM (SELECT coalesce(lower(severity), 'info') AS severity FROM anomalies
      ORDER BY "timestamp" DESC, log_id DESC LIMIT 50) l
WHERE severity IN ('critical', 'high', 'warning', 'medium', 'low', 'info') GROUP BY severity""", "logs", "anomalies"))
def q_alerts_by_severity(spark, sf):
    """Newest 50 alerts grouped by severity in display order (limit first)."""
    return DB.alerts_by_severity(anomalies(spark, sf), 50)


@query("latest_alerts", with_views("""
SELECT log_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS display_time, server_id, severity,
       CASE WHEN length(coalesce(message, 'No message')) > 200
            THEN substring(coalesce(message, 'No message'), 1, 200) || '...' ELSE coalesce(message, 'No message') END
         AS preview
FROM anomalies ORDER BY "timestamp" DESC, log_id DESC LIMIT 50""", "logs", "anomalies"))
def q_latest_alerts(spark, sf):
    """F3 + H25 + B16 + B17: the 50 newest alerts as display cards."""
    return DB.alert_cards(anomalies(spark, sf), 50)


@query("top_per_server", with_views("""
SELECT server_id, log_id, "timestamp", rn FROM (
  SELECT server_id, log_id, "timestamp",
         row_number() OVER (PARTITION BY server_id ORDER BY "timestamp" DESC, log_id DESC) AS rn FROM anomalies) r
WHERE rn <= 20""", "logs", "anomalies"))
def q_top_per_server(spark, sf):
    """E5: 20 newest anomalies per server (grouped limit)."""
    t = DB.top_per_server(anomalies(spark, sf), 20)
    return t.select("server_id", "log_id", to_ntz("timestamp").alias("timestamp"), F.col("rn").cast("long").alias("rn"))


@query("filter_options", with_views("""
SELECT DISTINCT 'severity' AS kind, severity AS value FROM anomalies WHERE severity IS NOT NULL
UNION ALL SELECT DISTINCT 'server_id', server_id FROM anomalies WHERE server_id IS NOT NULL
UNION ALL SELECT DISTINCT 'anomaly_type', anomaly_type FROM anomalies WHERE anomaly_type IS NOT NULL""",
    "logs", "anomalies"))
def q_filter_options(spark, sf):
    """F4 + G2: sorted distinct values for the filters."""
    a = anomalies(spark, sf)
    out = None
    for k in ("severity", "server_id", "anomaly_type"):
        d = DB.distinct_sorted(a, k).select(F.lit(k).alias("kind"), F.col(k).alias("value"))
        out = d if out is None else out.unionByName(d)
    return out


@query("status_hierarchy", with_views("""
SELECT status AS label, '' AS parent, count(*) AS value FROM status GROUP BY status
UNION ALL SELECT server_id, status, count(*) FROM status GROUP BY status, server_id""", "logs", "anomalies",
    more=status_sql("logs", "anomalies")))
def q_status_hierarchy(spark, sf):
    """ROLLUP(status, server) without the grand total."""
    return DB.status_hierarchy(_status(spark, sf))


@query("server_index", with_views("""
SELECT server_id, status, row_number() OVER (PARTITION BY status ORDER BY server_id) - 1 AS index_in_status
FROM status""", "logs", "anomalies", more=status_sql("logs", "anomalies")))
def q_server_index(spark, sf):
    """E4."""
    return DB.server_index(_status(spark, sf)).select("server_id", "status",
                                                      F.col("index_in_status").cast("long").alias("index_in_status"))


@query("scaled_logs", with_views("""
SELECT server_id, total_logs, round(total_logs / greatest(CAST((SELECT max(total_logs) FROM status) AS DOUBLE), 1.0)
       * 20 + 5, 6) AS size FROM status""", "logs", "anomalies", more=status_sql("logs", "anomalies")))
def q_scaled_logs(spark, sf):
    """D24 + B19."""
    return DB.scaled(_status(spark, sf).select("server_id", "total_logs"), "total_logs", "size")
