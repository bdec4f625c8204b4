"""Record, Kafka-frame, JSON and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.functions.rules import normalise_record, render_log_text
from logsift.functions.time import to_ntz
from logsift.operators.report import quality_report
from logsift.plans import profile_queries as PQ
from logsift.plans.oracle_views import with_views
from logsift.plans.registry import query
from logsift.plans.views import logs, table
from logsift.session import scratch_path
from logsift.sources import io as IO

RECORD_COLS = ["timestamp", "server_id", "log_level", "message", "pod_name", "namespace", "node_name",
               "container_name", "cpu_usage_percent", "memory_usage_mb", "network_bytes", "is_anomaly",
               "anomaly_type", "app_type", "source_component"]

RECORD_SQL = """
SELECT log_id, "timestamp", server_id,
  coalesce(trim(log_level), 'INFO') AS log_level, coalesce(trim(message), 'No message') AS message,
  coalesce(trim(pod_name), 'unknown-pod') AS pod_name, coalesce(trim(namespace), 'default') AS namespace,
  coalesce(trim(node_name), 'unknown-node') AS node_name,
  coalesce(trim(container_name), 'unknown-container') AS container_name,
  coalesce(TRY_CAST(CAST(cpu_usage_percent AS VARCHAR) AS DOUBLE), 0.0) AS cpu_usage_percent,
  CAST(trunc(coalesce(TRY_CAST(CAST(memory_usage_mb AS VARCHAR) AS DOUBLE), 0.0)) AS BIGINT) AS memory_usage_mb,
  CAST(trunc(coalesce(TRY_CAST(CAST(network_bytes AS VARCHAR) AS DOUBLE), 0.0)) AS BIGINT) AS network_bytes,
  CAST(trunc(coalesce(TRY_CAST(CAST(is_anomaly AS VARCHAR) AS DOUBLE), 0.0)) AS BIGINT) AS is_anomaly,
  coalesce(trim(anomaly_type), 'normal') AS anomaly_type, 'unknown' AS app_type, 'unknown' AS source_component
FROM logs"""


def records(spark, sf):
    """Stream-record shape of the log view (B14), keeping the ingest id."""
    return normalise_record(logs(spark, sf), keep=("log_id",))


@query("normalise_record", with_views(RECORD_SQL, "logs"))
def q_normalise_record(spark, sf):
    """Defaults, trims, numeric casts and integer truncation of stream records."""
    return records(spark, sf).withColumn("timestamp", to_ntz("timestamp"))


RENDER_SQL = f"""
SELECT log_id,
 '[' || strftime("timestamp", '%Y-%m-%d %H:%M:%S') || '] [' || log_level || '] [' || server_id || '] [' || pod_name || ']'
 || chr(10) || 'namespace=' || namespace || ' node=' || node_name || ' container=' || container_name || chr(10)
 || 'cpu=' || printf('%.2f', cpu_usage_percent) || '% mem=' || memory_usage_mb || 'MB net=' || network_bytes || 'B'
 || chr(10) || 'anomaly=' || is_anomaly || ' type=' || anomaly_type || ' app=' || app_type
 || ' source=' || source_component || chr(10) || 'message: ' || message || chr(10) AS log_text
FROM ({RECORD_SQL}) r"""


@query("render_log_text", with_views(RENDER_SQL, "logs"))
def q_render_log_text(spark, sf):
    """The five-line text block of every record."""
    r = records(spark, sf)
    txt = render_log_text(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "log_level", "server_id", "pod_name",
                          "namespace", "node_name", "container_name", "cpu_usage_percent", "memory_usage_mb",
                          "network_bytes", "is_anomaly", "anomaly_type", "app_type", "source_component", "message")
    return r.select("log_id", txt.alias("log_text"))


@query("json_round_trip", """
SELECT CAST(user_id AS VARCHAR) AS key,
       CAST(to_json({'event_id': event_id, 'event_type': event_type,
                     'k': CAST(json_extract(props, '$.k') AS INTEGER)}) AS VARCHAR) AS value,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""")
def q_json_round_trip(spark, sf):
    """A3 + A9 + A10: decode the JSON props, re-encode a keyed JSON record."""
    e = table(spark, sf, "events")
    dec = e.select("user_id", "event_id", "event_type", F.from_json("props", "k INT")["k"].alias("k"))
    frame = IO.to_kafka_frame(dec, "user_id", exclude_key=True)       # key + JSON value (A9)
    back = F.from_json("value", "event_id BIGINT, event_type STRING, k INT")   # decode again (A10)
    return frame.select("key", "value", back["k"].alias("k"))


KAFKA_FRAME_SQL = """
SELECT 'kubernetes-logs' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
       CAST(user_id AS VARCHAR) AS key,
       CASE WHEN event_id % 50 = 7
            THEN substring(CAST(to_json({'event_id': event_id, 'event_type': event_type, 'value': value}) AS VARCHAR), 2)
            ELSE CAST(to_json({'event_id': event_id, 'event_type': event_type, 'value': value}) AS VARCHAR) END
         AS value
FROM events"""


def kafka_frame(spark, sf):
    """Kafka-shaped frame over events: 3 partitions by key, offset = event id,
    every 50th value malformed on purpose (test-input derivation)."""
    e = table(spark, sf, "events")
    js = F.to_json(F.struct("event_id", "event_type", "value"))
    return e.select(F.lit("kubernetes-logs").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"), F.col("user_id").cast("string").alias("key"),
                    F.when(F.col("event_id") % 50 == 7, F.substring(js, 2, 1 << 30)).otherwise(js).alias("value"))


@query("kafka_decode", with_views("""
SELECT "offset", CASE WHEN json_valid(value) THEN CAST(json_extract(value, '$.event_id') AS BIGINT) END AS event_id,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.event_type') END AS event_type,
       NOT json_valid(value) AS is_corrupt FROM kf""", more=f"kf AS ({KAFKA_FRAME_SQL})"))
def q_kafka_decode(spark, sf):
    """A10 + K2: decode JSON values; malformed rows keep the raw text for quarantine."""
    d = IO.from_kafka_frame(kafka_frame(spark, sf), "event_id BIGINT, event_type STRING, value DOUBLE")
    return d.select(F.col("kafka_offset").alias("offset"), "event_id", "event_type",
                    F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


@query("offset_stats", with_views("""
SELECT topic, "partition", min("offset") AS first_offset, max("offset") + 1 AS end_offset, count(*) AS rows,
       max("offset") + 1 - min("offset") AS messages FROM kf GROUP BY topic, "partition"
UNION ALL
SELECT topic, NULL, min(first_offset), max(end_offset), CAST(sum(rows) AS BIGINT), CAST(sum(messages) AS BIGINT)
FROM (SELECT topic, "partition", min("offset") AS first_offset, max("offset") + 1 AS end_offset, count(*) AS rows,
             max("offset") + 1 - min("offset") AS messages FROM kf GROUP BY topic, "partition") p GROUP BY topic""",
    more=f"kf AS ({KAFKA_FRAME_SQL})"))
def q_offset_stats(spark, sf):
    """Per-partition offsets and message counts plus a topic total."""
    return IO.offset_stats(kafka_frame(spark, sf))


@query("sample_messages", with_views("""
SELECT * FROM kf ORDER BY "partition", "offset" LIMIT 10""", more=f"kf AS ({KAFKA_FRAME_SQL})"))
def q_sample_messages(spark, sf):
    """First ten messages by (partition, offset) - the limit is the feature."""
    return IO.sample_messages(kafka_frame(spark, sf), 10)


@query("last_message", with_views("""
SELECT topic, "partition", "offset", key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset" DESC) AS rn FROM kf) r
WHERE rn = 1""", more=f"kf AS ({KAFKA_FRAME_SQL})"))
def q_last_message(spark, sf):
    """Last message read per partition (max_by, no sort)."""
    return IO.last_message(kafka_frame(spark, sf))


@query("sink_round_trip", "SELECT * FROM orders")
def q_sink_round_trip(spark, sf):
    """A2 + A5 + A6 + A7: Parquet sink (20,000 rows per file) with a CSV mirror,
    read back through the Parquet-or-CSV reader."""
    path = scratch_path(spark, "orders") + ".parquet"
    IO.write_table(table(spark, sf, "orders"), path, also_csv=True, max_rows_per_file=20000)
    return IO.read_table(spark, path)


@query("csv_round_trip", "SELECT * FROM nation")
def q_csv_round_trip(spark, sf):
    """A1 + A6: CSV with header, read back with the table's schema."""
    src = table(spark, sf, "nation")
    path = scratch_path(spark, "nation") + ".csv"
    src.write.mode("overwrite").option("header", True).csv(path)
    return IO.read_table(spark, path, schema=src.schema)


def _quality_report_sql():
    ms = PQ._missing_sql("logs", PQ.LOG_TYPES)
    nums = ["log_id", "cpu_usage_percent", "memory_usage_mb", "network_bytes", "is_anomaly"]
    npf = PQ._numeric_profile_sql("logs", nums, 3.0, True)
    strs = [c for c, t in PQ.LOG_TYPES if t == "string"]
    tp_ctes, tp_body = PQ._ctes(PQ._text_profile_sql("logs", strs))
    more = f"ms AS ({ms}),\nnp AS ({npf}),\n{tp_ctes},\ntp AS ({tp_body})"
    nm = ["mean", "median", "std", "min", "max", "q25", "q75", "outliers_iqr"]
    parts = ["SELECT 'logs' AS dataset, 'missing' AS section, \"column\", m AS metric, v AS value, "
             "CAST(NULL AS VARCHAR) AS text FROM ms, (VALUES (0), (1)) x(i), "
             "LATERAL (SELECT CASE i WHEN 0 THEN 'missing_count' ELSE 'missing_pct' END AS m, "
             "CASE i WHEN 0 THEN CAST(missing_count AS DOUBLE) ELSE missing_pct END AS v) y"]
    parts.append("""SELECT 'logs', 'duplicates', NULL, 'duplicate_rows', CAST(sum(c - 1) AS DOUBLE), NULL
 FROM (SELECT count(*) AS c FROM logs GROUP BY ALL) g""".replace("GROUP BY ALL", "GROUP BY " + ", ".join(
        f'"{c}"' for c, _ in PQ.LOG_TYPES)))
    parts.append("""SELECT 'logs', 'duplicates', NULL, 'duplicate_pct', coalesce(round(CAST(sum(c - 1) AS DOUBLE) * 100
 / sum(c), 2), 0.0), NULL FROM (SELECT count(*) AS c FROM logs GROUP BY """ + ", ".join(f'"{c}"' for c, _ in PQ.LOG_TYPES) + ") g")
    for m in nm:
        parts.append(f"SELECT 'logs', 'numeric', \"column\", '{m}', CAST({m} AS DOUBLE), NULL FROM np")
    for m in ("unique_count", "avg_length", "max_length"):
        parts.append(f"SELECT 'logs', 'text', \"column\", '{m}', CAST({m} AS DOUBLE), NULL FROM tp")
    parts.append("SELECT 'logs', 'text', \"column\", 'most_frequent', NULL, most_frequent FROM tp")
    parts.append("SELECT 'logs', 'types', c, 'dtype', NULL, t FROM (VALUES " +
                 ", ".join(f"('{c}', '{t}')" for c, t in PQ.LOG_TYPES) + ") v(c, t)")
    return with_views("\nUNION ALL\n".join(parts), "logs", more=more)


@query("quality_report", _quality_report_sql())
def q_quality_report(spark, sf):
    """J7 + J8: missing, duplicates, numeric and text statistics and types as one long table."""
    return quality_report(logs(spark, sf), "logs")


def _report_round_trip_sql():
    q = _quality_report_sql()
    body_at = q.index("SELECT 'logs' AS dataset")
    ctes, body = q[:body_at].rstrip().rstrip(","), q[body_at:]
    return ctes + """,
rep AS (""" + body + """)
SELECT section, coalesce("column", '') || '.' || metric AS key, value, CASE WHEN value IS NULL THEN text END AS text
FROM rep"""


@query("report_json_round_trip", _report_round_trip_sql())
def q_report_json_round_trip(spark, sf):
    """The quality report written as one nested JSON document per section,
    read back with an explicit schema and flattened."""
    path = scratch_path(spark, "report") + ".json"
    IO.write_report(quality_report(logs(spark, sf), "logs"), path)
    back = spark.read.schema("section string, metrics map<string,string>").json(path)
    kv = back.select("section", F.explode("metrics").alias("key", "v"))
    val = F.col("v").try_cast("double")
    return kv.select("section", "key", val.alias("value"), F.when(val.isNull(), F.col("v")).alias("text"))


@query("log_text_round_trip", with_views(f"""
SELECT unnest(string_split(rtrim(log_text, chr(10)), chr(10))) AS value FROM ({RENDER_SQL}) t""", "logs"))
def q_log_text_round_trip(spark, sf):
    """Five-line text blocks written with the text sink and read back line by line."""
    path = scratch_path(spark, "logs-text")
    txt = q_render_log_text(spark, sf)
    IO.write_log_text(txt, F.col("log_text"), path)
    return spark.read.text(path)
