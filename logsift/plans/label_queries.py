"""Labelling and dataset-audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from logsift.functions.rules import proxy, rename_if_present, select_available
from logsift.operators import label as L
from logsift.operators import report as RP
from logsift.plans.registry import query
from logsift.plans.views import logs, table

SYSTEM_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]


def _p95(c):
    return f"(SELECT quantile_cont({c}, 0.95) FROM j)"


@query("system_labels", """
WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey IS NOT DISTINCT FROM o_orderkey)
SELECT l_orderkey, l_linenumber, anomaly_score, CASE WHEN anomaly_score >= 2 THEN 1 ELSE 0 END AS label,
       'system_anomaly' AS anomaly_type
FROM (SELECT l_orderkey, l_linenumber, """ + " + ".join(
    [f"CAST(coalesce({c} > {_p95(c)}, false) AS INTEGER)" for c in SYSTEM_METRICS]
    + ["CAST(coalesce(l_returnflag = 'R', false) AS INTEGER)", "CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER)"])
    + """ AS anomaly_score FROM j) s""")
def q_system_labels(spark, sf):
    """C1 + H22: two-table join, p95 thresholds of the joined table, 7-indicator score."""
    j = L.join_metrics(table(spark, sf, "lineitem"), table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey"),
                       ["l_orderkey"]).select("l_orderkey", "l_linenumber", *SYSTEM_METRICS, "l_returnflag", "o_orderstatus")
    s = L.score_system(j, SYSTEM_METRICS, [F.col("l_returnflag") == "R", F.col("o_orderstatus") == "F"])
    return s.select("l_orderkey", "l_linenumber", "anomaly_score", "label",
                    F.lit("system_anomaly").alias("anomaly_type"))


@query("normalise_label", """
WITH t AS (SELECT doc_id, quality * 2 + toxic AS label FROM labels)
SELECT doc_id, CAST(CASE WHEN (SELECT max(label) > 1 OR min(label) < 0 FROM t) THEN CAST(label > 0 AS INTEGER)
                        ELSE label END AS INTEGER) AS label,
       'security_attack' AS anomaly_type FROM t""")
def q_normalise_label(spark, sf):
    """H23 + B6: labels outside [0, 1] become label > 0."""
    t = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("label"))
    return L.normalise_label(t, "label").withColumn("anomaly_type", F.lit("security_attack"))


DESIRED = ["cpu_usage", "memory_usage", "packets_count", "flow_bytes_per_second", "flow_packets_per_second",
           "container_cpu_usage_seconds_rate", "container_memory_usage_bytes", "label", "anomaly_type"]


def _hybrid(spark, sf):
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("node_cpu_usage"),
        F.col("c_nationkey").cast("double").alias("node_memory_usage"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("label"),
        F.lit("system_anomaly").alias("anomaly_type"))
    cust = proxy(proxy(cust, "cpu_usage", "node_cpu_usage"), "memory_usage", "node_memory_usage")
    supp = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("bytes_rate"), F.col("s_nationkey").cast("double").alias("packets_count"),
        (F.col("s_suppkey") % 2).cast("int").alias("label"), F.lit("security_attack").alias("anomaly_type"))
    supp = rename_if_present(supp, {"bytes_rate": "flow_bytes_per_second", "packets_rate": "flow_packets_per_second"})
    sys_s = select_available(L.sample_n(cust, 15000, "c_custkey"), DESIRED)
    sec_s = select_available(L.sample_n(supp, 15000, "s_suppkey"), DESIRED)
    return L.label_encode(L.combine(sys_s, sec_s), "anomaly_type", "anomaly_type_encoded")


@query("hybrid_dataset", """
WITH s1 AS (SELECT c_acctbal AS cpu_usage, CAST(c_nationkey AS DOUBLE) AS memory_usage,
                   CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS label, 'system_anomaly' AS anomaly_type
            FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR) || '-42') LIMIT 15000),
s2 AS (SELECT CAST(s_nationkey AS DOUBLE) AS packets_count, s_acctbal AS flow_bytes_per_second,
              CAST(s_suppkey % 2 AS INTEGER) AS label, 'security_attack' AS anomaly_type
       FROM supplier ORDER BY md5(CAST(s_suppkey AS VARCHAR) || '-42') LIMIT 15000),
u AS (SELECT cpu_usage, memory_usage, CAST(NULL AS DOUBLE) AS packets_count,
             CAST(NULL AS DOUBLE) AS flow_bytes_per_second, label, anomaly_type FROM s1
      UNION ALL SELECT NULL, NULL, packets_count, flow_bytes_per_second, label, anomaly_type FROM s2)
SELECT *, CAST(dense_rank() OVER (ORDER BY anomaly_type) - 1 AS INTEGER) AS anomaly_type_encoded FROM u""")
def q_hybrid_dataset(spark, sf):
    """Proxies, renames, seeded samples, union by name, label encoding."""
    return _hybrid(spark, sf)


@query("server_assign", """
SELECT o_orderkey, 'server-' || lpad(CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 10 + 1 AS VARCHAR), 2, '0')
  AS server_id FROM orders""")
def q_server_assign(spark, sf):
    """Round-robin over 10 servers by row position (distributed positions)."""
    return L.assign_server(table(spark, sf, "orders").select("o_orderkey"), 10, ["o_orderkey"])


@query("label_encode_roles", """
SELECT conv_id, turn, role, CAST(dense_rank() OVER (ORDER BY role) - 1 AS INTEGER) AS role_encoded
FROM conversations WHERE role IS NOT NULL
UNION ALL SELECT conv_id, turn, role, NULL FROM conversations WHERE role IS NULL""")
def q_label_encode_roles(spark, sf):
    """H21 alone: codes by sorted value (size-checked literal map)."""
    return L.label_encode(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "role", "role_encoded")


# --- J9-J11, D18 ------------------------------------------------------------------

AUDIT_TABLES = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
}
AUDIT_NUMERIC = {"customer": ["c_custkey", "c_nationkey", "c_acctbal"],
                 "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
                 "part": ["p_partkey", "p_size", "p_retailprice"]}


def _audit_sql_for(t):
    cols = AUDIT_TABLES[t]
    parts = [f"SELECT '{t}' AS dataset, 'basic' AS section, CAST(NULL AS VARCHAR) AS \"column\", 'num_rows' AS metric, "
             f"CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM {t}",
             f"SELECT '{t}', 'basic', NULL, 'num_columns', {float(len(cols))}, NULL"]
    for c in cols:
        parts.append(f"SELECT '{t}', 'missing', '{c}', 'missing_count', CAST(count(*) - count({c}) AS DOUBLE), NULL "
                     f"FROM {t} HAVING count(*) - count({c}) > 0")
        parts.append(f"SELECT '{t}', 'missing', '{c}', 'missing_pct', round((count(*) - count({c})) * 100.0 / count(*), 2), "
                     f"NULL FROM {t} HAVING count(*) - count({c}) > 0")
    g = ", ".join(cols)
    parts.append(f"SELECT '{t}', 'duplicates', NULL, 'duplicate_rows', CAST(coalesce(sum(c - 1), 0) AS DOUBLE), NULL "
                 f"FROM (SELECT count(*) AS c FROM {t} GROUP BY {g}) d")
    parts.append(f"SELECT '{t}', 'duplicates', NULL, 'duplicate_pct', "
                 f"coalesce(round(CAST(sum(c - 1) AS DOUBLE) * 100 / sum(c), 2), 0.0), NULL "
                 f"FROM (SELECT count(*) AS c FROM {t} GROUP BY {g}) d")
    for c in AUDIT_NUMERIC[t]:
        cond = (f"(CAST({c} AS DOUBLE) < q1 - 1.5 * (q3 - q1) OR CAST({c} AS DOUBLE) > q3 + 1.5 * (q3 - q1))")
        qq = (f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 "
              f"FROM {t}) qq")
        parts.append(f"SELECT '{t}', 'outliers', '{c}', 'outliers', CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE), NULL "
                     f"FROM {t}, {qq}")
        parts.append(f"SELECT '{t}', 'outliers', '{c}', 'outlier_pct', "
                     f"round(count(*) FILTER (WHERE {cond}) * 100.0 / count(*), 2), NULL FROM {t}, {qq}")
    return "\nUNION ALL\n".join(parts)


AUDIT_SQL = "\nUNION ALL\n".join(_audit_sql_for(t) for t in AUDIT_TABLES)


def _audit(spark, sf):
    return RP.audit_all([(t, table(spark, sf, t)) for t in AUDIT_TABLES])


@query("audit_metrics", AUDIT_SQL)
def q_audit_metrics(spark, sf):
    """Per-dataset audit (missing, duplicates, k=1.5 unguarded outliers), long form."""
    return _audit(spark, sf)[0]


RECO_CTES = f"""m AS ({AUDIT_SQL}),
rules AS (SELECT * FROM (VALUES ('missing', 'missing_pct', 20.0, 'drop', 'consider dropping the column'),
  ('missing', 'missing_pct', 5.0, 'impute', 'needs imputation'),
  ('duplicates', 'duplicate_pct', 10.0, 'dedup', 'consider deduplication'),
  ('labels', 'class_imbalance', 30.0, 'resample', 'consider resampling'),
  ('outliers', 'outlier_pct', 10.0, 'check', 'check validity')) r(section, metric, threshold, level, advice)),
hits AS (SELECT m.dataset, m."column", m.value, r.level, r.advice, r.threshold, m.metric, m.section
         FROM m JOIN rules r USING (section, metric) WHERE m.value > r.threshold),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, section, "column", metric
                                                    ORDER BY threshold DESC) AS rn FROM hits) h WHERE rn = 1)"""
RECO_BODY = """
SELECT dataset, "column", level,
       coalesce('column ' || "column" || ': ', '') || CAST(value AS VARCHAR) || '% - ' || advice AS recommendation
FROM best
UNION ALL
SELECT DISTINCT dataset, CAST(NULL AS VARCHAR), 'good', 'good quality - ready for processing' FROM m
WHERE dataset NOT IN (SELECT dataset FROM best)"""
RECO_SQL = "WITH " + RECO_CTES + RECO_BODY


@query("recommendations", RECO_SQL)
def q_recommendations(spark, sf):
    """Rule table over the audit metrics; 'good' when nothing fires."""
    return _audit(spark, sf)[1]


@query("audit_status", "WITH " + RECO_CTES + ", r AS (" + RECO_BODY + """),
s AS (SELECT m.dataset, CAST(m.value AS BIGINT) AS rows,
             CAST(coalesce((SELECT count(*) FROM r WHERE r.dataset = m.dataset AND level <> 'good'), 0) AS BIGINT) AS findings,
             CASE WHEN coalesce((SELECT count(*) FROM r WHERE r.dataset = m.dataset AND level = 'drop'), 0) = 0
                  THEN 'pass' ELSE 'warn' END AS status
      FROM m WHERE metric = 'num_rows')
SELECT * FROM s UNION ALL
SELECT 'TOTAL', CAST(sum(rows) AS BIGINT), CAST(sum(findings) AS BIGINT),
       CASE WHEN count(*) FILTER (WHERE status <> 'pass') = 0 THEN 'pass' ELSE 'warn' END FROM s""")
def q_audit_status(spark, sf):
    """J11 + D18: pass/warn per dataset and totals."""
    return _audit(spark, sf)[2]
