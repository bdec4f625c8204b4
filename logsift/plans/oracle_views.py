"""The log-shaped views as DuckDB SQL (must match ``views.py``)."""

LOGS_SQL = """
SELECT
  event_id AS log_id,
  ts AS "timestamp",
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' WHEN 'signup' THEN 'DEBUG'
                  WHEN 'view' THEN 'INFO' ELSE 'TRACE' END AS log_level,
  'server-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0') AS server_id,
  CASE WHEN event_id % 11 = 0 THEN NULL
       WHEN event_id % 13 = 0 THEN upper(event_type || '-pod-' || CAST(user_id AS VARCHAR))
       ELSE event_type || '-pod-' || CAST(user_id AS VARCHAR) END AS pod_name,
  CASE user_id % 7 WHEN 0 THEN 'default' WHEN 1 THEN 'production' WHEN 2 THEN 'staging'
                   WHEN 3 THEN 'development' WHEN 4 THEN 'monitoring' WHEN 5 THEN 'kube-system'
                   ELSE 'Bad_NS' END AS namespace,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_type || '  ' || props END AS message,
  'container-' || CAST(user_id % 4 AS VARCHAR) AS container_name,
  'node-' || CAST(user_id % 5 + 1 AS VARCHAR) AS node_name,
  event_type AS service,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS cpu_usage_percent,
  value * 37 AS memory_usage_mb,
  CAST(event_id * 7919 % 100000 AS BIGINT) AS network_bytes,
  CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS is_anomaly,
  CASE WHEN event_type <> 'error' THEN 'normal'
       ELSE CASE event_id % 5 WHEN 0 THEN 'cpu_spike' WHEN 1 THEN 'memory_leak' WHEN 2 THEN 'pod_crash'
                              WHEN 3 THEN 'network_flood' ELSE 'disk_io_bottleneck' END END AS anomaly_type
FROM events
"""

DUP_LOGS_SQL = f"""
SELECT * REPLACE (log_id * 4 AS log_id, CASE WHEN log_id % 100 = 37 THEN message || repeat('x', 10000) || ' one' ELSE message END AS message) FROM ({LOGS_SQL}) b0
UNION ALL
SELECT * REPLACE (log_id * 4 + 1 AS log_id, date_trunc('second', "timestamp") AS "timestamp")
FROM ({LOGS_SQL}) b1 WHERE log_id % 10 = 0
UNION ALL
SELECT * REPLACE (log_id * 4 + 2 AS log_id) FROM ({LOGS_SQL}) b2 WHERE log_id % 25 = 0
UNION ALL
SELECT * REPLACE (log_id * 4 + 3 AS log_id, message || repeat('x', 10000) || ' two' AS message) FROM ({LOGS_SQL}) b3 WHERE log_id % 100 = 37
"""

ANOMALIES_SQL = f"""
SELECT log_id, "timestamp", server_id,
       CASE upper(log_level) WHEN 'CRITICAL' THEN 'critical' WHEN 'ERROR' THEN 'high'
                             WHEN 'WARNING' THEN 'warning' ELSE 'info' END AS severity,
       message, anomaly_type, log_level
FROM ({LOGS_SQL}) l
WHERE is_anomaly = 1 OR coalesce(cpu_usage_percent > 100, false)
"""


def with_views(body: str, *names: str, more: str = "") -> str:
    """Prefix a query with the CTEs it needs (logs, dup_logs, anomalies) and
    any further CTEs of its own (``more``, without the leading WITH)."""
    defs = {"logs": LOGS_SQL, "dup_logs": DUP_LOGS_SQL, "anomalies": ANOMALIES_SQL}
    parts = [f"{n} AS ({defs[n]})" for n in names]
    if more:
        parts.append(more)
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
