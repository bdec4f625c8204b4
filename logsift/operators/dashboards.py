"""Result tables and dashboard analytics.

Per-server tables are aggregates with a map-side combine; lookups of
per-server counts are joins with AQE choosing broadcast (their size is one
row per server, bounded by the fleet, not by the data).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsift.contracts import SEVERITY_DISPLAY_ORDER
from logsift.functions.rules import classify_status, pct, severity_rank
from logsift.functions.text import first_present, preview
from logsift.functions.time import display_ts, iso_utc, to_ntz

ERROR_LEVELS = ("ERROR", "CRITICAL")     # [choice] which levels count as errors
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def anomaly_counts(anoms: DataFrame, key: str = "server_id") -> DataFrame:
    return anoms.groupBy(key).agg(F.count(F.lit(1)).alias("anomaly_count"))


def with_anomaly_count(status: DataFrame, anoms: DataFrame, key: str = "server_id") -> DataFrame:
    """Left lookup of per-server anomaly counts, 0 when absent; replaces an existing column."""
    base = status.drop("anomaly_count") if "anomaly_count" in status.columns else status
    return (base.join(anomaly_counts(anoms, key), key, "left")
            .withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(0)).cast("long")))


def server_status(logs: DataFrame, anoms: DataFrame, cpu_scale: float = 100.0) -> DataFrame:
    """Server status table (D20 + H19): counts, last update, peaks, anomalies, status.

    The status rule compares cpu as a fraction, so percent cpu is divided by
    ``cpu_scale`` first.
    """
    lvl = F.upper(F.col("log_level"))
    agg = logs.groupBy("server_id").agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.count_if(lvl.isin(*ERROR_LEVELS)).alias("error_count"),
        F.count_if(lvl == "WARNING").alias("warning_count"),
        F.max("timestamp").alias("last_update"),
        F.max("cpu_usage_percent").alias("max_cpu"),
        F.max("memory_usage_mb").alias("max_memory_mb"))
    st = with_anomaly_count(agg, anoms)
    return st.withColumn("status", classify_status("anomaly_count", F.col("max_cpu") / cpu_scale, "max_memory_mb"))


def health_summary(status: DataFrame) -> DataFrame:
    """healthy / warning / critical counts, zero when absent."""
    s = F.lower(F.col("status"))
    return status.agg(*[F.count_if(s == k).alias(k) for k in ("healthy", "warning", "critical")])


def hourly_metrics(logs: DataFrame, include_all: bool = True, ts: str = "timestamp") -> DataFrame:
    """Per hour and server (+ 'all' through GROUPING SETS): log_count, error_rate,
    avg_response_time (null unless a response_time column exists) (D21)."""
    rt = F.col("response_time").cast("double") if "response_time" in logs.columns else F.lit(None).cast("double")
    base = logs.select(F.window(ts, "1 hour").start.alias("hour"), "server_id",
                       F.upper(F.col("log_level")).isin(*ERROR_LEVELS).alias("_err"), rt.alias("_rt"))
    aggs = [F.count(F.lit(1)).alias("log_count"), F.count_if("_err").alias("_errors"), F.avg("_rt").alias("_avg_rt")]
    if include_all:
        g = base.groupingSets([["hour", "server_id"], ["hour"]], "hour", "server_id").agg(
            *aggs, F.grouping("server_id").alias("_all"))
        # a null server stays a null server: only the grand row of an hour is 'all'
        g = g.withColumn("server_id", F.when(F.col("_all") == 1, "all").otherwise(F.col("server_id")))
    else:
        g = base.groupBy("hour", "server_id").agg(*aggs)
    return g.select(to_ntz("hour").alias("timestamp"), "server_id", "log_count",
                    F.round(F.col("_errors") / F.col("log_count"), 6).alias("error_rate"),
                    F.round("_avg_rt", 6).alias("avg_response_time"))


def kpis(status: DataFrame) -> DataFrame:
    """KPI row from the status table (D16): logs, anomalies, servers, error rate %."""
    return status.agg(F.sum("total_logs").cast("long").alias("total_logs"),
                      F.sum("anomaly_count").cast("long").alias("total_anomalies"),
                      F.count(F.lit(1)).alias("servers"),
                      pct(F.sum("error_count"), F.sum("total_logs")).alias("error_rate"))


def kpis_or_estimates(status: DataFrame | None, anoms: DataFrame | None = None,
                      statistics: DataFrame | None = None) -> DataFrame:
    """KPI row (D16) from what there is: sums of the status table, else estimates from its anomaly
    counts (10 logs an anomaly, 0.3 errors an anomaly), else the anomaly table and the statistics row.

    Every input comes down to one row of totals."""
    s: dict = {}
    if status is not None:
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_logs", "anomaly_count", "error_count")
                if c in status.columns]
        s = status.agg(F.count(F.lit(1)).alias("servers"), *sums).first().asDict()
        s = s if s["servers"] else {}
    st = statistics.first() if statistics is not None else None
    st = st.asDict() if st is not None else {}
    guess = s.get("anomaly_count", 0) * 10
    total = s["total_logs"] if "total_logs" in s else guess if "anomaly_count" in s else st.get("total_logs") or 0
    if "anomaly_count" in s:
        found = s["anomaly_count"]
    else:
        found = (anoms.count() if anoms is not None else 0) or st.get("total_anomalies") or 0
    errors = s["error_count"] if "error_count" in s else s.get("anomaly_count", 0) * 0.3
    if "error_count" not in s and "anomaly_count" not in s:
        errors = 0
    of = s["total_logs"] if "error_count" in s and "total_logs" in s else total or guess
    rate = round(errors * 100.0 / of, 2) if of else 0.0
    servers = s.get("servers") or st.get("servers_monitored") or 10
    spark = next(d for d in (status, anoms, statistics) if d is not None).sparkSession
    return spark.createDataFrame([(int(total), int(found), int(servers), float(rate))],
                                 "total_logs long, total_anomalies long, servers long, error_rate double")


def pipeline_statistics(logs: DataFrame) -> DataFrame:
    """Statistics row (D22): totals, servers, time range."""
    return logs.agg(F.count(F.lit(1)).alias("total_logs"),
                    F.count_if(F.col("is_anomaly") == 1).alias("total_anomalies"),
                    F.count_distinct("server_id").alias("servers_monitored"),
                    to_ntz(F.min("timestamp")).alias("time_start"), to_ntz(F.max("timestamp")).alias("time_end"))


def pipeline_health(anoms: DataFrame, status: DataFrame, fresh_seconds: int = 300) -> DataFrame:
    """Freshness (D23/K10): counts, last update; active when the newest anomaly
    is within ``fresh_seconds`` of the newest status update (data time, not wall time)."""
    a = anoms.agg(F.count(F.lit(1)).alias("anomalies_count"), F.max("timestamp").alias("_last_anom")).first()
    # the status aggregate stays a frame; the anomaly side is one row of metadata
    s = status.agg(F.count(F.lit(1)).alias("servers_count"), F.max("last_update").alias("_last"))
    last_anom = F.lit(a["_last_anom"]).cast("timestamp")
    return s.select(
        F.lit(a["anomalies_count"]).cast("long").alias("anomalies_count"), "servers_count",
        to_ntz("_last").alias("last_update"),
        F.coalesce(F.unix_micros(last_anom) >= F.unix_micros("_last") - F.lit(fresh_seconds * 1_000_000),
                   F.lit(False)).alias("active"))


def calendar_heatmap(anoms: DataFrame, ts: str = "timestamp") -> DataFrame:
    """date x hour counts, 24 hour columns filled with 0."""
    g = anoms.select(F.to_date(ts).alias("date"), F.hour(ts).alias("hour"))
    p = g.groupBy("date").pivot("hour", list(range(24))).agg(F.count(F.lit(1)))
    return p.na.fill(0, [str(h) for h in range(24)])


def weekday_heatmap(anoms: DataFrame, ts: str = "timestamp") -> DataFrame:
    """weekday x hour counts, Monday..Sunday order, absent cells null."""
    order = F.create_map(*[x for i, d in enumerate(WEEKDAYS) for x in (F.lit(d), F.lit(i))])
    g = anoms.select(F.date_format(ts, "EEEE").alias("weekday"), F.hour(ts).alias("hour"))
    p = g.groupBy("weekday").pivot("hour", list(range(24))).agg(F.count(F.lit(1)))
    return p.withColumn("weekday_order", F.element_at(order, F.col("weekday")))


def severity_distribution(anoms: DataFrame) -> DataFrame:
    """Counts per severity with percent and rank weight."""
    total = anoms.count()
    c = anoms.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return c.select("severity", "n", pct("n", F.lit(total)).alias("pct"), severity_rank("severity").alias("rank"))


def latest(df: DataFrame, n: int, ts: str = "timestamp", tiebreak: str = "log_id") -> DataFrame:
    """Newest n rows (F3); TakeOrderedAndProject keeps n per task."""
    return df.orderBy(F.desc(ts), F.desc(tiebreak)).limit(n)


def alerts_by_severity(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """Latest ``limit`` alerts grouped by severity in display order with group sizes;
    unknown severities dropped after the limit (E6)."""
    lat = latest(alerts, limit).select(F.coalesce(F.lower("severity"), F.lit("info")).alias("severity"))
    order = F.create_map(*[x for i, s in enumerate(SEVERITY_DISPLAY_ORDER) for x in (F.lit(s), F.lit(i))])
    return (lat.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("display_order", F.element_at(order, F.col("severity")))
            .where(F.col("display_order").isNotNull()))


def alerts_grouped(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """The rows behind ``alerts_by_severity``: the latest ``limit`` alerts with their group's display
    order and size and their place in it (E6).  The windows see at most ``limit`` rows."""
    order = F.array(*[F.lit(s) for s in SEVERITY_DISPLAY_ORDER])
    lat = latest(alerts, limit).withColumn("severity", F.coalesce(F.lower("severity"), F.lit("info")))
    lat = lat.withColumn("display_order", (F.array_position(order, F.col("severity")) - 1).cast("int"))
    group = W.partitionBy("severity")
    return (lat.where(F.col("display_order") >= 0)
            .withColumn("group_size", F.count(F.lit(1)).over(group))
            .withColumn("place", F.row_number().over(group.orderBy(F.desc("timestamp"), F.desc("log_id")))))


def alert_cards(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """Display fields of the newest alerts: time text, preview, first present message."""
    msg = first_present(*[c for c in ("message", "description") if c in alerts.columns], default="No message")
    return latest(alerts, limit).select(
        "log_id", display_ts(iso_utc("timestamp")).alias("display_time"), "server_id", "severity",
        preview(msg, 200).alias("preview"))


def top_per_server(anoms: DataFrame, n: int = 20, key: str = "server_id", ts: str = "timestamp",
                   tiebreak: str = "log_id") -> DataFrame:
    """Newest n rows per server (E5).  The rank filter lets Spark insert a
    partial group limit before the shuffle, so a hot server ships n rows per task."""
    w = W.partitionBy(key).orderBy(F.desc(ts), F.desc(tiebreak))
    return anoms.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def status_hierarchy(status: DataFrame) -> DataFrame:
    """status -> server hierarchy as (label, parent, value) via ROLLUP without the grand total."""
    r = status.rollup("status", "server_id").agg(F.count(F.lit(1)).alias("value"), F.grouping("status").alias("_total"),
                                                 F.grouping("server_id").alias("_root")).where(F.col("_total") == 0)
    # grouping(), not null tests: a server without a name is a leaf of its status
    return r.select(F.when(F.col("_root") == 1, F.col("status")).otherwise(F.col("server_id")).alias("label"),
                    F.when(F.col("_root") == 1, F.lit("")).otherwise(F.col("status")).alias("parent"), "value")


def server_index(status: DataFrame) -> DataFrame:
    """0-based index of a server inside its status group (E4); groups are per status, one row per server."""
    w = W.partitionBy("status").orderBy("server_id")
    return status.withColumn("index_in_status", F.row_number().over(w) - 1)


def scaled(df: DataFrame, col: str, out: str = "size") -> DataFrame:
    """v / max(max, 1) * 20 + 5 (D24); the maximum is one number of metadata."""
    mx = df.agg(F.greatest(F.max(col).cast("double"), F.lit(1.0))).first()[0]
    return df.withColumn(out, F.round(F.col(col) / F.lit(mx if mx is not None else 1.0) * 20 + 5, 6))
