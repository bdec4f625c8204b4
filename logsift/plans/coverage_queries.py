"""Queries for inputs and branches that the other modules' queries do not reach."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.contracts import Contract, K8S_LOG, SEVERITY_DISPLAY_ORDER
from logsift.functions import rules as R
from logsift.functions import text as TX
from logsift.functions.time import to_ntz
from logsift.operators import dashboards as DB
from logsift.operators import label as L
from logsift.operators import report as RP
from logsift.operators import stats as S
from logsift.operators import validate as V
from logsift.plans import clean_sql as CS
from logsift.plans.clean_queries import cleaned
from logsift.plans.dashboard_queries import _status
from logsift.plans.oracle_views import with_views
from logsift.plans.registry import ORACLES, query
from logsift.plans.views import anomalies, logs, table
from logsift.session import scratch_path
from logsift.sources import io as IO


# --- sources and sinks -------------------------------------------------------------

@query("csv_corrupt", """
SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS custkey, CAST(c_nationkey AS BIGINT) AS nationkey,
       CASE WHEN c_custkey % 10 = 0 THEN 'x' || c_custkey || ',' || c_nationkey END AS corrupt FROM customer""")
def q_csv_corrupt(spark, sf):
    """A1: lines that do not fit the schema keep their text in a column of their own."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    path = scratch_path(spark, "customer") + ".csv"
    (c.select(F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("x"), key)).otherwise(key).alias("custkey"),
              F.col("c_nationkey").alias("nationkey")).write.option("header", True).csv(path))
    schema = T._parse_datatype_string("custkey bigint, nationkey bigint")
    return IO.read_table(spark, path, schema=schema, corrupt_col="corrupt")


@query("csv_fallback", "SELECT CAST(c_custkey AS BIGINT) AS custkey, c_mktsegment AS segment FROM customer")
def q_csv_fallback(spark, sf):
    """A2: files named Parquet that hold CSV are read as CSV."""
    path = scratch_path(spark, "customer") + ".parquet"
    (table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
     .write.option("header", True).csv(path))
    return IO.read_table(spark, path, schema=T._parse_datatype_string("custkey bigint, segment string"))


@query("records_documents", """
SELECT l_orderkey AS orderkey, CAST(l_linenumber AS BIGINT) AS linenumber, l_quantity AS quantity FROM lineitem""")
def q_records_documents(spark, sf):
    """A3 + A4: documents of four shapes, one per order (an object for an order of one line; two wrappers; an array), read by
    one call; a path that is not there adds no rows."""
    schema = T._parse_datatype_string("orderkey bigint, linenumber bigint, quantity double")
    rec = F.struct(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").cast("long").alias("linenumber"),
                   F.col("l_quantity").alias("quantity"))
    docs = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(rec)).alias("r"))
    shape = F.col("l_orderkey") % 4
    doc = (F.when(F.size("r") == 1, F.to_json(F.col("r")[0])).when(shape == 1, F.to_json(F.struct(F.col("r").alias("anomalies"))))
           .when(shape == 2, F.to_json(F.struct(F.col("r").alias("alerts")))).otherwise(F.to_json("r")))
    path = scratch_path(spark, "documents")
    docs.select(doc.alias("value")).write.text(path)
    absent = IO.read_or_empty(spark, path + "-none.json", schema)
    return IO.read_records(spark, path, schema=schema, lines=True).unionByName(absent)


def _missing_long(spark, sf, name):
    return S.missing_stats(table(spark, sf, name)).select(
        F.lit(name).alias("dataset"), F.lit("missing").alias("section"), "column", F.lit("non_missing_count").alias("metric"),
        F.col("non_missing_count").cast("double").alias("value"), F.lit(None).cast("string").alias("text"))


@query("report_two_datasets", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, 'missing' AS section, '{c}.non_missing_count' AS key, CAST(count({c}) AS DOUBLE) AS value FROM {t}"
    for t, cols in (("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
                    ("supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])) for c in cols))
def q_report_two_datasets(spark, sf):
    """A report over two datasets, one document per dataset and section, read back."""
    path = scratch_path(spark, "report") + ".json"
    IO.write_report(_missing_long(spark, sf, "customer").unionByName(_missing_long(spark, sf, "supplier")), path)
    back = spark.read.schema("dataset string, section string, metrics map<string,string>").json(path)
    return back.select("dataset", "section", F.explode("metrics").alias("key", "v")).select(
        "dataset", "section", "key", F.col("v").cast("double").alias("value"))


@query("sink_files", "SELECT count(*) AS n_rows, true AS cap_kept, count(*) > 2000 AS several_files FROM orders")
def q_sink_files(spark, sf):
    """No file of the sink holds more than 2,000 rows."""
    path = scratch_path(spark, "orders") + ".parquet"
    IO.write_table(table(spark, sf, "orders"), path, max_rows_per_file=2000)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 2000).alias("cap_kept"),
                     (F.count(F.lit(1)) > 1).alias("several_files"))


@query("csv_mirror", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def q_csv_mirror(spark, sf):
    """The CSV mirror beside the Parquet sink, read back."""
    src = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "orders")
    IO.write_table(src, path, also_csv=True)
    return spark.read.schema(src.schema).option("header", True).csv(path + "_csv")


# --- helpers, joins, samples ----------------------------------------------------------

@query("drop_null", with_views("SELECT log_id FROM logs WHERE pod_name IS NOT NULL AND message IS NOT NULL", "logs"))
def q_drop_null(spark, sf):
    """B1: rows with a null in any of the columns that exist."""
    return R.drop_null(logs(spark, sf), ["pod_name", "message", "absent"]).select("log_id")


@query("with_default", with_views("""
SELECT log_id, log_level, 'unknown' AS app_type, 'kubernetes' AS source_component FROM logs""", "logs"))
def q_with_default(spark, sf):
    """B19 + B6: a default only where the column is absent, and a constant."""
    d = R.with_default(R.with_default(logs(spark, sf), "app_type", "unknown"), "log_level", "INFO")
    return R.with_constant(d, "source_component", "kubernetes").select("log_id", "log_level", "app_type", "source_component")


@query("with_bounds", """
SELECT l_orderkey, l_linenumber, (l_quantity - lo) / (hi - lo) AS scaled
FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) b""")
def q_with_bounds(spark, sf):
    """One row of statistics applied to every row."""
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    b = S.with_bounds(d, d.agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi")))
    return b.select("l_orderkey", "l_linenumber", ((F.col("l_quantity") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("scaled"))


@query("join_null_keys", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS custkey, o_orderpriority AS name FROM orders),
c AS (SELECT CASE WHEN c_custkey % 500 = 0 THEN NULL ELSE c_custkey END AS custkey, c_name AS name FROM customer)
SELECT o_orderkey, o.custkey, o.name AS name_x, c.name AS name_y FROM o JOIN c ON o.custkey IS NOT DISTINCT FROM c.custkey""")
def q_join_null_keys(spark, sf):
    """Missing keys match each other, overlapping columns get suffixes; a third of the orders have no
    key, and this hot key is split (at 1,000 rows here)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("custkey"),
                                          F.col("o_orderpriority").alias("name"))
    c = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 500 != 0, F.col("c_custkey")).alias("custkey"), F.col("c_name").alias("name"))
    return L.join_metrics(o, c, ["custkey"], hot_rows=1000)


@query("sample_orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42') LIMIT 1000""")
def q_sample_orders(spark, sf):
    """1,000 rows without replacement; the sample size is the feature."""
    return L.sample_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 1000, "o_orderkey")


# --- text ----------------------------------------------------------------------------------

@query("sql_functions", f"""
SELECT doc_id, strip_accents(text) AS text_plain, {CS.text_clean_sql('strip_accents(text)')} AS clean_plain FROM documents""")
def q_sql_functions(spark, sf):
    """2.12: the registered functions in a SQL query, marks taken off."""
    TX.register_functions(spark)
    table(spark, sf, "documents").createOrReplaceTempView("documents_for_sql")
    return spark.sql(r"""SELECT doc_id, regexp_replace(nfkd(text), '\\p{Mn}', '') AS text_plain,
                                regexp_replace(standardise_text(text), '\\p{Mn}', '') AS clean_plain FROM documents_for_sql""")


@query("nfkd_plain", "SELECT doc_id, strip_accents(text) AS text_plain FROM documents")
def q_nfkd_plain(spark, sf):
    """H3: NFKD with the marks taken off."""
    return table(spark, sf, "documents").select("doc_id", F.regexp_replace(TX.nfkd("text"), r"\p{Mn}", "").alias("text_plain"))


@query("standardise_plain", f"SELECT doc_id, {CS.text_clean_sql('strip_accents(text)', None)} AS text_plain FROM documents")
def q_standardise_plain(spark, sf):
    """H5 in full, with the marks taken off."""
    return table(spark, sf, "documents").select(
        "doc_id", F.regexp_replace(TX.standardise_text("text"), r"\p{Mn}", "").alias("text_plain"))


# --- validation ---------------------------------------------------------------------------

_ABSENT = ("node_name", "service")


def _missing_column_sql() -> str:
    parts = [f"SELECT '{c}' AS field, 'missing_column' AS rule, CAST(NULL AS BIGINT) AS invalid_count, "
             f"'Required field ''{c}'' is missing from data' AS message" for c in _ABSENT]
    for r in K8S_LOG:
        for rule, bound, sign, side in (("below_min", r.min, "<", "below minimum"), ("above_max", r.max, ">", "above maximum")):
            if r.numeric and bound is not None:
                shown = repr(float(bound)) if isinstance(bound, float) else repr(bound)
                parts.append(f"SELECT '{r.name}', '{rule}', count(*), 'Field ''{r.name}'': ' || count(*) || ' values {side} {shown}' "
                             f"FROM logs WHERE {r.name} {sign} {bound} HAVING count(*) > 0")
    return with_views("\nUNION ALL\n".join(parts), "logs")


@query("validate_missing_column", _missing_column_sql())
def q_validate_missing_column(spark, sf):
    """J1 + J3: a file that lacks required columns: these, and the counts of the bounds that its other columns break."""
    path = scratch_path(spark, "lacking") + ".parquet"
    IO.write_table(logs(spark, sf).drop(*_ABSENT), path)
    errors = V.validate(IO.read_table(spark, path), K8S_LOG, pos_col="log_id")
    return errors.where(F.col("rule").isin("missing_column", "below_min", "above_max")).select("field", "rule", "invalid_count", "message")


@query("row_errors_types", with_views("""
SELECT log_id, CAST(CASE WHEN e IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_errors, coalesce(e, '') AS errors FROM (
  SELECT log_id, CASE WHEN log_id % 19 = 0 THEN 'Field ''cpu_usage_percent'' must be a float'
    WHEN cpu_usage_percent IS NULL THEN 'Required field ''cpu_usage_percent'' is missing'
    WHEN cpu_usage_percent < 0 THEN 'Field ''cpu_usage_percent'' value ' || CAST(cpu_usage_percent AS VARCHAR) || ' is below minimum 0.0'
    WHEN cpu_usage_percent > 100 THEN 'Field ''cpu_usage_percent'' value ' || CAST(cpu_usage_percent AS VARCHAR) || ' is above maximum 100.0'
    END AS e FROM logs) t""", "logs"))
def q_row_errors_types(spark, sf):
    """J6 + B12: numbers that come as text, some of them no numbers."""
    cpu = F.when(F.col("log_id") % 19 == 0, "n/a").otherwise(F.col("cpu_usage_percent").cast("string"))
    src = logs(spark, sf).select("log_id", cpu.alias("cpu_usage_percent"))
    return V.row_errors(src, Contract("cpu", (K8S_LOG.get("cpu_usage_percent"),)), "log_id")


# --- dashboards ---------------------------------------------------------------------------

@query("alerts_grouped", with_views(f"""
SELECT severity, CAST(list_position({list(SEVERITY_DISPLAY_ORDER)}, severity) - 1 AS INTEGER) AS display_order,
       count(*) OVER (PARTITION BY severity) AS group_size,
       row_number() OVER (PARTITION BY severity ORDER BY "timestamp" DESC, log_id DESC) AS place, log_id, "timestamp", server_id, message
FROM (SELECT * REPLACE (coalesce(lower(severity), 'info') AS severity) FROM anomalies ORDER BY "timestamp" DESC, log_id DESC LIMIT 50) l
WHERE severity IN {tuple(SEVERITY_DISPLAY_ORDER)}""", "anomalies"))
def q_alerts_grouped(spark, sf):
    """The newest 50 alerts themselves, by severity group."""
    return DB.alerts_grouped(anomalies(spark, sf), 50).select(
        "severity", "display_order", "group_size", F.col("place").cast("long").alias("place"), "log_id",
        to_ntz("timestamp").alias("timestamp"), "server_id", "message")


@query("kpis_estimated", with_views("""
SELECT CAST(count(*) * 10 AS BIGINT) AS total_logs, count(*) AS total_anomalies,
       (SELECT count(DISTINCT server_id) FROM logs) AS servers, CAST(3.0 AS DOUBLE) AS error_rate FROM anomalies""", "logs", "anomalies"))
def q_kpis_estimated(spark, sf):
    """A status table with anomaly counts only."""
    return DB.kpis_or_estimates(_status(spark, sf).drop("total_logs", "error_count"), anomalies(spark, sf))


@query("kpis_without_status", with_views("""
SELECT (SELECT count(*) FROM logs) AS total_logs, (SELECT count(*) FROM anomalies) AS total_anomalies,
       (SELECT count(DISTINCT server_id) FROM logs) AS servers, CAST(0.0 AS DOUBLE) AS error_rate""", "logs", "anomalies"))
def q_kpis_without_status(spark, sf):
    """No status table, only the anomaly table and the statistics row."""
    return DB.kpis_or_estimates(None, anomalies(spark, sf), DB.pipeline_statistics(logs(spark, sf)))


# --- reports -------------------------------------------------------------------------------

def _labelled(spark, sf):
    return table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"), F.when(F.col("toxic") == 1, "security_attack")
                                             .when(F.col("toxic") == 0, "normal").alias("anomaly_type"))


_IMBALANCE = """coalesce(round(abs(count(*) FILTER (WHERE toxic = 0) - count(*) FILTER (WHERE toxic = 1)) * 100.0 / count(*), 2), 0.0)"""


@query("audit_labels", f"""
SELECT 'labels' AS dataset, 'labels' AS section, CAST(NULL AS VARCHAR) AS "column", 'anomaly_pct' AS metric,
       CAST(round(count(*) FILTER (WHERE toxic = 1) * 100.0 / count(*), 2) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM labels
UNION ALL SELECT 'labels', 'labels', NULL, 'class_imbalance', CAST({_IMBALANCE} AS DOUBLE), NULL FROM labels
UNION ALL SELECT 'labels', 'labels', CAST(toxic AS VARCHAR), 'label_count', CAST(count(*) AS DOUBLE), NULL FROM labels
  WHERE toxic IS NOT NULL GROUP BY toxic
UNION ALL SELECT 'labels', 'labels', CASE toxic WHEN 1 THEN 'security_attack' ELSE 'normal' END, 'type_count', CAST(count(*) AS DOUBLE), NULL
  FROM labels WHERE toxic IN (0, 1) GROUP BY toxic""")
def q_audit_labels(spark, sf):
    """D11 + J9: label statistics of the audit, with the distribution of types."""
    return RP.audit(_labelled(spark, sf), "labels").where(F.col("section") == "labels")


@query("label_recommendations", f"""
SELECT 'labels' AS dataset, CAST(NULL AS VARCHAR) AS "column", CASE WHEN v > 30 THEN 'resample' ELSE 'good' END AS level,
       CASE WHEN v > 30 THEN CAST(v AS VARCHAR) || '% - consider resampling' ELSE 'good quality - ready for processing' END AS recommendation
FROM (SELECT CAST({_IMBALANCE} AS DOUBLE) AS v FROM labels) t""")
def q_label_recommendations(spark, sf):
    """The advice on imbalance, from the audit's label section."""
    return RP.recommend(q_audit_labels(spark, sf))


@query("cleaning_actions", f"""
WITH s AS (SELECT * FROM ({ORACLES['clean_summary']}) x), n AS (SELECT value AS n FROM s WHERE metric = 'initial_rows')
""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS action, value AS count, "
    + ("coalesce(round(CAST(value AS DOUBLE) * 100 / nullif(n, 0), 2), 0.0)" if share else "CAST(NULL AS DOUBLE)")
    + f" AS percent FROM s, n WHERE metric = '{m}'" for a, m, share in RP.ACTIONS))
def q_cleaning_actions(spark, sf):
    """Actions of a cleaning run with counts and percents."""
    return RP.cleaning_actions(cleaned(spark, sf).summary)


@query("quality_report_full", f"""
SELECT * FROM ({ORACLES['quality_report']}) a
UNION ALL SELECT 'logs', 'summary', NULL, metric, CAST(value AS DOUBLE), NULL FROM ({ORACLES['clean_summary']}) b
UNION ALL SELECT 'logs', 'validation', field, rule, CAST(invalid_count AS DOUBLE), message FROM ({ORACLES['validate_contract']}) c""")
def q_quality_report_full(spark, sf):
    """Quality metrics, cleaning summary and validation errors in one table."""
    src = logs(spark, sf)
    return RP.full_quality_report(RP.quality_report(src, "logs"), "logs", cleaned(spark, sf).summary,
                                  V.validate(src, K8S_LOG, pos_col="log_id"))
