"""Streaming queries: the job runs over the duplicated log view published as JSON lines,
the same number of files for each micro-batch (``availableNow``), then its result tables are read back.  Oracles are
the batch answers over the same records.

The source is out of order: near copies and some originals come one micro-batch after their time, exact copies one or
two, so that copies meet across micro-batches under the default delay, a copy may come before its
original, and what comes two micro-batches after its time is late.  Some lines are no records.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.contracts import OUTLIER_FIELDS, OUTLIER_K_AUDIT
from logsift.functions.rules import normalise_record
from logsift.functions.time import to_ntz
from logsift.plans import clean_sql as CS
from logsift.plans.clean_queries import error_list_sql
from logsift.plans.dashboard_queries import STATUS_COLS
from logsift.plans.oracle_views import with_views
from logsift.plans.registry import query
from logsift.plans.source_queries import RECORD_SQL
from logsift.plans.views import dup_logs, logs
from logsift.session import scratch_path
from logsift.streaming import pipeline as P

#: Days of events in a micro-batch, and so many values are held before a sketch thins them.
SLOT_DAYS, SKETCH_K = 15, 32768
#: Rows of a file (on average): a micro-batch grows with the events, so it comes in as many files as its rows ask for.
ROWS_PER_FILE = 50_000
#: Spark counts 4 MB more for a file, so each file is a task of its own, however well it is packed; a task sorts what it reads.
READ_BYTES = 4 << 20

_RUNS: dict = {}


def source_values(spark, sf: str):
    """(slot, value, log_id): what is published, the slot in which it comes."""
    recs = normalise_record(dup_logs(spark, sf), keep=("log_id",))
    kind, event = F.col("log_id") % 4, F.floor(F.col("log_id") / 4)
    shift = (F.when((kind == 0) & (event % 20 == 0), 1).when((kind == 1) & (event % 20 == 10), 1)
             .when(kind == 2, F.when(event % 50 == 0, 2).otherwise(1)).otherwise(0))
    own = F.floor((F.dayofmonth("timestamp") - 1) / SLOT_DAYS)
    good = recs.select((own + shift).cast("int").alias("slot"), P.record_values(recs).alias("value"), "log_id")
    lines = logs(spark, sf).withColumn("slot", F.floor((F.dayofmonth("timestamp") - 1) / SLOT_DAYS).cast("int"))
    broken = lines.where(F.col("log_id") % 97 == 0).select("slot", F.concat(F.lit('{"log_id": '), "log_id", F.lit(', "timest')).alias("value"), "log_id")
    never = lines.where(F.col("log_id") % 89 == 0).select("slot", F.concat(F.lit('{"log_id": '), "log_id", F.lit(', "timestamp": "never"}')).alias("value"), "log_id")
    beat = spark.createDataFrame([(99, P.heartbeat("2100-01-01T00:00:00Z"), 0)], "slot int, value string, log_id long")
    return good.union(broken).union(never).union(beat)


def run_stream(spark, sf: str) -> str:
    key = (spark.sparkContext.applicationId, sf)
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_path(spark, "stream")
    src, out, ck = f"{root}/source", f"{root}/out", f"{root}/checkpoint"
    values = source_values(spark, sf)
    most = values.groupBy("slot").count().agg(F.max("count")).first()[0]
    files = -(-most // ROWS_PER_FILE)
    P.publish_files(values, src, key="slot", order_col="log_id", files_per_key=files)
    raw = P.read_source(spark, src, max_files_per_trigger=files, keep_source=False)
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with P.session_settings(spark, {"spark.sql.files.maxPartitionBytes": str(READ_BYTES)}):
        job = P.start(spark, raw, out, ck, available_now=True, sketch_k=SKETCH_K, files_per_batch=files, state_partitions=max(shuffles, -(-files // 2)))
        job.awaitTermination()
    if job.exception() is not None:
        raise RuntimeError(str(job.exception()))
    _RUNS[key] = out
    return out


_RECS = f"""recs AS ({RECORD_SQL.replace('FROM logs', 'FROM dup_logs')}),
cl AS (SELECT * REPLACE ({CS.text_clean_sql('message', None)} AS message) FROM recs)"""

#: Rows in their micro-batch; late ones came after the watermark two micro-batches before had passed their second.
_ARRIVAL = _RECS + f""",
slots AS (SELECT *, (day("timestamp") - 1) // {SLOT_DAYS} + CASE
    WHEN log_id % 4 = 0 AND log_id // 4 % 20 = 0 THEN 1 WHEN log_id % 4 = 1 AND log_id // 4 % 20 = 10 THEN 1
    WHEN log_id % 4 = 2 THEN CASE WHEN log_id // 4 % 50 = 0 THEN 2 ELSE 1 END ELSE 0 END AS slot FROM cl),
batches AS (SELECT *, dense_rank() OVER (ORDER BY slot) AS b FROM slots),
marks AS (SELECT b, max(max("timestamp")) OVER (ORDER BY b) - INTERVAL 10 MINUTE AS mark FROM batches GROUP BY b),
arrived AS (SELECT x.*, coalesce(date_trunc('second', "timestamp") + INTERVAL 1 SECOND <= mark, false) AS late
            FROM batches x LEFT JOIN marks m ON m.b = x.b - 2),
gr AS (SELECT min(log_id) AS log_id, count(*) AS copies FROM arrived WHERE NOT late
       GROUP BY date_trunc('second', "timestamp"), pod_name, message)"""

_DEDUP = _RECS + """,
dd AS (SELECT * FROM cl WHERE log_id IN (
  SELECT min(log_id) FROM cl GROUP BY date_trunc('second', "timestamp"), pod_name, message)),
an AS (SELECT log_id, "timestamp", server_id,
              CASE upper(log_level) WHEN 'CRITICAL' THEN 'critical' WHEN 'ERROR' THEN 'high'
                                    WHEN 'WARNING' THEN 'warning' ELSE 'info' END AS severity,
              message, anomaly_type, log_level
       FROM dd WHERE is_anomaly = 1 OR coalesce(cpu_usage_percent > 100, false))"""

_BOUNDS = "qs AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, quantile_disc(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_disc(CAST({c} AS DOUBLE), 0.75) AS q3 FROM recs"
    for c in OUTLIER_FIELDS) + f"), bs AS (SELECT *, q1 - {OUTLIER_K_AUDIT} * (q3 - q1) AS lower, q3 + {OUTLIER_K_AUDIT} * (q3 - q1) AS upper FROM qs)"


@query("stream_metrics", with_views("""
SELECT date_trunc('hour', "timestamp") AS "timestamp", coalesce(server_id, 'all') AS server_id, count(*) AS log_count,
       round(count(*) FILTER (WHERE upper(log_level) IN ('ERROR', 'CRITICAL')) / count(*), 6) AS error_rate,
       CAST(NULL AS DOUBLE) AS avg_response_time
FROM dd GROUP BY GROUPING SETS ((date_trunc('hour', "timestamp"), server_id), (date_trunc('hour', "timestamp")))""",
    "dup_logs", more=_DEDUP))
def q_stream_metrics(spark, sf):
    """K1-K5 + K9: hourly metrics per server and 'all' from the deduplicated stream."""
    return P.read_hourly(spark, run_stream(spark, sf))


@query("stream_status", with_views("""
SELECT server_id, count(*) AS total_logs,
  count(*) FILTER (WHERE upper(log_level) IN ('ERROR', 'CRITICAL')) AS error_count,
  count(*) FILTER (WHERE upper(log_level) = 'WARNING') AS warning_count,
  max("timestamp") AS last_update, max(cpu_usage_percent) AS max_cpu, max(memory_usage_mb) AS max_memory_mb,
  count(*) FILTER (WHERE is_anomaly = 1 OR coalesce(cpu_usage_percent > 100, false)) AS anomaly_count,
  CASE
   WHEN max(cpu_usage_percent) / 100.0 > 0.8 OR max(memory_usage_mb) > 150000
        OR count(*) FILTER (WHERE is_anomaly = 1 OR coalesce(cpu_usage_percent > 100, false)) > 580 THEN 'critical'
   WHEN max(cpu_usage_percent) / 100.0 > 0.6 OR max(memory_usage_mb) > 100000
        OR count(*) FILTER (WHERE is_anomaly = 1 OR coalesce(cpu_usage_percent > 100, false)) > 550 THEN 'warning'
   WHEN max(cpu_usage_percent) / 100.0 < 0.6 AND max(memory_usage_mb) < 100000
        AND count(*) FILTER (WHERE is_anomaly = 1 OR coalesce(cpu_usage_percent > 100, false)) < 550 THEN 'healthy'
   ELSE 'warning' END AS status
FROM dd GROUP BY server_id""", "dup_logs", more=_DEDUP))
def q_stream_status(spark, sf):
    """K6: server status folded from per-batch partial aggregates."""
    st = P.read_status(spark, run_stream(spark, sf))
    return st.select(*[to_ntz(c).alias(c) if c == "last_update" else F.col(c) for c in STATUS_COLS])


@query("stream_anomalies", with_views("SELECT * FROM an", "dup_logs", more=_DEDUP))
def q_stream_anomalies(spark, sf):
    """K7: anomaly rows appended per micro-batch."""
    a = P.read_anomalies(spark, run_stream(spark, sf))
    return a.withColumn("timestamp", to_ntz("timestamp"))


@query("stream_alerts", with_views('SELECT * FROM an ORDER BY "timestamp" DESC, log_id DESC LIMIT 50',
                                   "dup_logs", more=_DEDUP))
def q_stream_alerts(spark, sf):
    """K8: the 50 newest alerts, kept as newest-50 of (previous version + batch)."""
    return P.read_alerts(spark, run_stream(spark, sf)).withColumn("timestamp", to_ntz("timestamp"))


@query("stream_dedup", with_views("SELECT log_id, server_id, copies FROM gr JOIN cl USING (log_id)", "dup_logs", more=_ARRIVAL))
def q_stream_dedup(spark, sf):
    """K4: the earliest copy of each group and its copies, which came in different micro-batches."""
    return P.read_clean(spark, run_stream(spark, sf)).select("log_id", "server_id", "copies")


@query("stream_quarantine", with_views("""
SELECT '{"log_id": ' || log_id || ', "timest' AS value, 'corrupt' AS reason FROM logs WHERE log_id % 97 = 0
UNION ALL SELECT '{"log_id": ' || log_id || ', "timestamp": "never"}', 'timestamp' FROM logs WHERE log_id % 89 = 0""", "logs"))
def q_stream_quarantine(spark, sf):
    """K2: lines that are no record, with the reason, from the write that routes all records."""
    return P.read_quarantine(spark, run_stream(spark, sf))


@query("stream_balance", with_views(f"""
SELECT (SELECT count(*) FROM arrived) + bad AS rows_in, (SELECT count(*) FROM arrived) AS accepted, bad AS quarantined,
       (SELECT count(*) FROM cl WHERE len({error_list_sql(P.RECORD_SCHEMA.names)}) > 0) AS invalid,
       (SELECT count(*) FROM gr) AS kept, (SELECT CAST(sum(copies) - count(*) AS BIGINT) FROM gr) AS duplicates,
       (SELECT count(*) FROM arrived WHERE late) AS late
FROM (SELECT count(*) FILTER (WHERE log_id % 97 = 0) + count(*) FILTER (WHERE log_id % 89 = 0) AS bad FROM logs) q""",
    "logs", "dup_logs", more=_ARRIVAL))
def q_stream_balance(spark, sf):
    """K2-K4: records in = kept + duplicates + late + quarantined."""
    return P.balance(spark, run_stream(spark, sf))


@query("stream_row_errors", with_views(f"""
SELECT log_id, CAST(len(m) AS BIGINT) AS n_errors, array_to_string(m, '; ') AS errors
FROM (SELECT log_id, {error_list_sql(P.RECORD_SCHEMA.names)} AS m FROM dd) t""", "dup_logs", more=_DEDUP))
def q_stream_row_errors(spark, sf):
    """K3 + J6: the failing rules of every cleaned record, found while decoding."""
    rows = P.read_clean(spark, run_stream(spark, sf))
    return rows.select("log_id", F.size("errors").cast("long").alias("n_errors"), F.concat_ws("; ", "errors").alias("errors"))


@query("stream_bounds", with_views("SELECT * FROM bs", "dup_logs", more=_RECS + ",\n" + _BOUNDS))
def q_stream_bounds(spark, sf):
    """K7: quartiles and bounds from the batches' merged sketches (exact up to SKETCH_K values)."""
    return P.read_profile(spark, run_stream(spark, sf))


@query("stream_outliers", with_views(" UNION ALL ".join(
    f"""SELECT log_id, "timestamp", server_id, column_name, CAST({c} AS DOUBLE) AS value FROM dd JOIN bs ON column_name = '{c}'
WHERE q3 > q1 AND ({c} < lower OR {c} > upper)""" for c in OUTLIER_FIELDS), "dup_logs", more=_DEDUP + ",\n" + _BOUNDS))
def q_stream_outliers(spark, sf):
    """K7 + H14: values outside the profile's bounds."""
    return P.read_outliers(spark, run_stream(spark, sf)).withColumn("timestamp", to_ntz("timestamp"))


@query("stream_health", with_views("""
SELECT (SELECT count(*) FROM an) AS anomalies_count, count(DISTINCT server_id) AS servers_count, max("timestamp") AS last_update,
       count(*) > 0 AS active FROM dd""", "dup_logs", more=_DEDUP))
def q_stream_health(spark, sf):
    """Pipeline health from the result tables."""
    return P.health(spark, run_stream(spark, sf)).drop("processed_rows_per_second")


@query("stream_publish", with_views("SELECT server_id, count(*) AS records, CAST(1 AS BIGINT) AS files FROM logs GROUP BY server_id", "logs"))
def q_stream_publish(spark, sf):
    """K1: records published by server, one ordered file for each key."""
    recs = normalise_record(logs(spark, sf), keep=("log_id",))
    path = f"{scratch_path(spark, 'publish')}/source"
    P.publish_files(recs.select("server_id", "log_id", P.record_values(recs).alias("value")), path, key="server_id", order_col="log_id")
    lines = spark.read.text(path).select("server_id", F.get_json_object("value", "$.server_id").alias("own"), F.col("_metadata.file_path").alias("file"))
    return (lines.where(F.col("own") == F.col("server_id")).groupBy("server_id")
            .agg(F.count(F.lit(1)).alias("records"), F.count_distinct("file").alias("files")))
