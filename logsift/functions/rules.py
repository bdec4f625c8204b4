"""Predicates, plan-time column helpers, record normalisation and rules."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.contracts import (NAMESPACE_PATTERN, POD_NAME_PATTERN, SEVERITY_RANK,
                               STATUS_CRITICAL, STATUS_WARNING)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- plan-time column helpers (B1-B6, B19) ---------------------------------

def drop_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols`` that exist (B1)."""
    cols = [c for c in cols if c in df.columns]
    return df.na.drop(subset=cols) if cols else df


def filter_eq(df: DataFrame, col: str, value, all_token: str = "All") -> DataFrame:
    """Equality filter; the 'All' token (or None) passes everything (B2)."""
    if value is None or value == all_token or col not in df.columns:
        return df
    return df.filter(F.col(col) == F.lit(value))


def select_available(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select([c for c in cols if c in df.columns])


def rename_if_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename only the columns that exist."""
    m = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(m) if m else df


def proxy(df: DataFrame, target: str, source: str) -> DataFrame:
    """Copy ``source`` to ``target`` when target is absent."""
    if target not in df.columns and source in df.columns:
        return df.withColumn(target, F.col(source))
    return df


def with_constant(df: DataFrame, col: str, value) -> DataFrame:
    """Constant column."""
    return df.withColumn(col, F.lit(value))


def with_default(df: DataFrame, col: str, value) -> DataFrame:
    """Add ``col`` = value only when the column is absent."""
    return df if col in df.columns else df.withColumn(col, F.lit(value))


# --- predicates (B7-B12); null counts as invalid, as in the reference -------

def not_in_list(c, values) -> Column:
    """Invalid when not one of ``values``; a missing value is invalid."""
    return ~F.coalesce(_col(c).isin(list(values)), F.lit(False))


def below_min(c, lo) -> Column:
    return F.coalesce(_col(c) < F.lit(lo), F.lit(False))


def above_max(c, hi) -> Column:
    return F.coalesce(_col(c) > F.lit(hi), F.lit(False))


def matches(c, pattern: str) -> Column:
    """Full-pattern match with Python-like '$' (UNIX_LINES); null -> False."""
    return F.coalesce(_col(c).rlike("(?d)" + pattern), F.lit(False))


def is_pod_name(c) -> Column:
    """RFC 1123 subdomain."""
    return matches(c, POD_NAME_PATTERN)


def is_namespace(c) -> Column:
    """DNS label of at most 253 characters."""
    return matches(c, NAMESPACE_PATTERN) & F.coalesce(F.length(_col(c)) <= 253, F.lit(False))


def length_between(c, lo: int | None, hi: int | None) -> Column:
    x = F.length(_col(c))
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x >= lo)
    if hi is not None:
        cond = cond & (x <= hi)
    return F.coalesce(cond, F.lit(False))


def nonconforming(c, target: str) -> Column:
    """String value that does not cast to the contract type."""
    spark_t = {"float": "double", "integer": "bigint", "datetime": "timestamp",
               "string": "string"}[target]
    if spark_t == "string":
        return F.lit(False)
    x = _col(c)
    return x.isNotNull() & x.cast("string").try_cast(spark_t).isNull()


# --- records (B14, B15) -----------------------------------------------------

RECORD_DEFAULTS = {
    "log_level": "INFO", "message": "No message", "pod_name": "unknown-pod",
    "namespace": "default", "node_name": "unknown-node",
    "container_name": "unknown-container", "anomaly_type": "normal",
    "app_type": "unknown", "source_component": "unknown",
}


def normalise_record(df: DataFrame, ts_col: str = "timestamp", server_col: str = "server_id",
                     keep: Iterable[str] = ()) -> DataFrame:
    """Stream record shape: defaults, trims, numeric casts, int truncation."""
    def s(name):
        src = F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
        return F.coalesce(F.trim(src), F.lit(RECORD_DEFAULTS[name])).alias(name)

    def num(name, default, kind):
        src = F.col(name).cast("string").try_cast("double") if name in df.columns else F.lit(None).cast("double")
        v = F.coalesce(src, F.lit(float(default)))
        return (v if kind == "double" else v.cast("long")).alias(name)

    return df.select(
        *[F.col(k) for k in keep],
        F.col(ts_col).alias("timestamp"),
        F.col(server_col).alias("server_id"),
        s("log_level"), s("message"), s("pod_name"), s("namespace"), s("node_name"),
        s("container_name"),
        num("cpu_usage_percent", 0.0, "double"),
        num("memory_usage_mb", 0, "long"),
        num("network_bytes", 0, "long"),
        num("is_anomaly", 0, "long"),
        s("anomaly_type"), s("app_type"), s("source_component"),
    )


def render_log_text(ts_text, level, server, pod, namespace, node, container, cpu, mem, net,
                    anomaly, atype, app, source, message) -> Column:
    """Five-line text block of one record."""
    return F.format_string(
        "[%s] [%s] [%s] [%s]\nnamespace=%s node=%s container=%s\n"
        "cpu=%.2f%% mem=%dMB net=%dB\nanomaly=%d type=%s app=%s source=%s\nmessage: %s\n",
        *[_col(x) for x in (ts_text, level, server, pod, namespace, node, container, cpu, mem,
                            net, anomaly, atype, app, source, message)])


# --- status, severity, scoring (H19, H20, H22, H24) -------------------------

def classify_status(anomaly_count, max_cpu, max_mem, critical=STATUS_CRITICAL,
                    warning=STATUS_WARNING) -> Column:
    """Server status rule; missing inputs count as 0; branch order kept."""
    n = F.coalesce(_col(anomaly_count).cast("double"), F.lit(0.0))
    cpu = F.coalesce(_col(max_cpu).cast("double"), F.lit(0.0))
    mem = F.coalesce(_col(max_mem).cast("double"), F.lit(0.0))
    return (F.when((cpu > critical["cpu"]) | (mem > critical["mem"]) | (n > critical["anomalies"]), "critical")
            .when((cpu > warning["cpu"]) | (mem > warning["mem"]) | (n > warning["anomalies"]), "warning")
            .when((cpu < warning["cpu"]) & (mem < warning["mem"]) & (n < warning["anomalies"]), "healthy")
            .otherwise("warning"))


def severity_rank(c) -> Column:
    """critical 4, high 3, medium 2, low 1, info 0, anything else 0."""
    m = F.create_map(*[F.lit(x) for kv in SEVERITY_RANK.items() for x in kv])
    return F.coalesce(F.element_at(m, _col(c)), F.lit(0))


def severity_of_level(level) -> Column:
    """Alert severity from a log level [choice]."""
    x = F.upper(_col(level))
    return (F.when(x == "CRITICAL", "critical").when(x == "ERROR", "high")
            .when(x == "WARNING", "warning").otherwise("info"))


def indicator_sum(conds: Iterable[Column]) -> Column:
    """Sum of boolean indicators, a missing condition counting 0."""
    total = None
    for c in conds:
        v = F.coalesce(c, F.lit(False)).cast("int")
        total = v if total is None else total + v
    return total


def pct(n, d, digits: int = 2) -> Column:
    """round(n / d * 100, digits); 0 when d is 0."""
    return F.coalesce(F.round(F.try_divide(_col(n).cast("double") * 100.0, _col(d).cast("double")), digits),
                      F.lit(0.0))


def server_name(n) -> Column:
    """'server-%02d'."""
    return F.format_string("server-%02d", _col(n).cast("int"))
