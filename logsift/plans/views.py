"""Log-shaped views over the driver tables (the test data has no logs).

The same derivation is written as SQL for the DuckDB oracles in
``logsift.plans.oracle``; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.session import ensure_session_defaults
from logsift.sources.io import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_session_defaults(spark)
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


NAMESPACE_BY_MOD7 = ("default", "production", "staging", "development", "monitoring", "kube-system", "Bad_NS")
ANOMALY_BY_MOD5 = ("cpu_spike", "memory_leak", "pod_crash", "network_flood", "disk_io_bottleneck")


def _pick(expr, values):
    out = None
    for i, v in enumerate(values):
        out = F.when(expr == i, v) if out is None else out.when(expr == i, v)
    return out


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log record per event; nulls, bad values and tails are derived."""
    e = table(spark, sf_dir, "events")
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    pod = F.concat(et, F.lit("-pod-"), uid.cast("string"))
    return e.select(
        eid.alias("log_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(et == "error", "ERROR").when(et == "purchase", "WARNING").when(et == "signup", "DEBUG")
         .when(et == "view", "INFO").otherwise("TRACE").alias("log_level"),
        F.concat(F.lit("server-"), F.lpad((uid % 10 + 1).cast("string"), 2, "0")).alias("server_id"),
        F.when(eid % 11 == 0, F.lit(None).cast("string")).when(eid % 13 == 0, F.upper(pod))
         .otherwise(pod).alias("pod_name"),
        _pick(uid % 7, NAMESPACE_BY_MOD7).alias("namespace"),
        F.when(eid % 29 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(et, F.lit("  "), F.col("props"))).alias("message"),
        F.concat(F.lit("container-"), (uid % 4).cast("string")).alias("container_name"),
        F.concat(F.lit("node-"), (uid % 5 + 1).cast("string")).alias("node_name"),
        et.alias("service"),
        F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("cpu_usage_percent"),
        (F.col("value") * 37).alias("memory_usage_mb"),
        ((eid * 7919) % 100000).cast("long").alias("network_bytes"),
        F.when(et == "error", 1).otherwise(0).cast("long").alias("is_anomaly"),
        F.when(et != "error", "normal").otherwise(_pick(eid % 5, ANOMALY_BY_MOD5)).alias("anomaly_type"),
    )


def dup_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """logs plus re-emitted copies: every 10th event again within the same
    second (timestamp truncated), every 25th event again exactly.  One event in a hundred has a message of
    over 10,000 characters, and comes again with one that differs only after them.  Ingest
    position ``log_id`` = 4*event_id (+1 near copy, +2 exact copy, +3 the other long message)."""
    base = logs(spark, sf_dir)
    is_long, filler = F.col("log_id") % 100 == 37, F.repeat(F.lit("x"), 10000)
    orig = (base.withColumn("message", F.when(is_long, F.concat("message", filler, F.lit(" one"))).otherwise(F.col("message")))
            .withColumn("log_id", F.col("log_id") * 4))
    other = (base.where(is_long).withColumn("message", F.concat("message", filler, F.lit(" two")))
             .withColumn("log_id", F.col("log_id") * 4 + 3))
    near = (base.where(F.col("log_id") % 10 == 0)
            .withColumn("timestamp", F.date_trunc("second", "timestamp"))
            .withColumn("log_id", F.col("log_id") * 4 + 1))
    exact = base.where(F.col("log_id") % 25 == 0).withColumn("log_id", F.col("log_id") * 4 + 2)
    return orig.unionByName(near).unionByName(exact).unionByName(other)


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomaly result table over the log view (K7 semantics, batch)."""
    from logsift.functions.rules import severity_of_level
    lg = logs(spark, sf_dir)
    return (lg.where((F.col("is_anomaly") == 1) | F.coalesce(F.col("cpu_usage_percent") > 100, F.lit(False)))
            .select("log_id", "timestamp", "server_id",
                    severity_of_level("log_level").alias("severity"),
                    "message", "anomaly_type", "log_level"))


LOG_DATA_COLUMNS = ("timestamp", "log_level", "server_id", "pod_name", "namespace", "message",
                    "container_name", "node_name", "service", "cpu_usage_percent", "memory_usage_mb",
                    "network_bytes", "is_anomaly", "anomaly_type")
