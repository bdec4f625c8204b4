"""Reports, gates and recommendations.

Reports are long metric tables (section, column, metric, value, text);
nesting happens only at a JSON sink (``sources.io.write_report``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.contracts import GATES
from logsift.functions import outlier as O
from logsift.functions.rules import pct
from logsift.operators import stats as S
from logsift.operators.quantiles import quantile_values

#: Datasets whose audits run at the same time.
AUDITS_AT_ONCE = 4

METRIC_SCHEMA = "dataset string, section string, column string, metric string, value double, text string"


def quality_gates(summary: DataFrame) -> DataFrame:
    """4 gates as percent of input rows, with threshold and pass/warn."""
    s = summary.groupBy().pivot("metric").agg(F.first("value"))
    init = F.col("initial_rows").cast("double")
    vals = {"retention_rate": F.col("final_rows") * 100.0 / init,
            "missing_rate": F.col("missing_filled") * 100.0 / init,
            "duplicate_rate": F.col("duplicates_removed") * 100.0 / init,
            "outlier_rate": F.col("outliers_detected") * 100.0 / init}
    rows = []
    for gate, thr, op in GATES:
        v = vals[gate]
        ok = (v >= thr) if op == ">=" else (v <= thr)
        rows.append(F.struct(F.lit(gate).alias("gate"), F.round(v, 2).alias("value"),
                             F.lit(thr).alias("threshold"),
                             F.when(ok, "pass").otherwise("warn").alias("status")))
    return s.select(F.inline(F.array(*rows)))


def gate_recommendations(gates: DataFrame) -> DataFrame:
    """One line per failing gate, or a single all-clear line."""
    msg = (F.when(F.col("gate") == "retention_rate", "Review the drop rules: too many rows removed")
           .when(F.col("gate") == "missing_rate", "Investigate sources of missing values")
           .when(F.col("gate") == "duplicate_rate", "Deduplicate upstream")
           .otherwise("Check outlier sources and capping"))
    bad = gates.where(F.col("status") != "pass").select("gate", msg.alias("recommendation"))
    n_bad = gates.agg(F.count_if(F.col("status") != "pass").alias("n"))
    ok = n_bad.where(F.col("n") == 0).select(F.lit(None).cast("string").alias("gate"),
                                             F.lit("All quality gates passed").alias("recommendation"))
    return bad.unionByName(ok)


#: Rows of the cleaning summary: action, its count in the summary, whether it has a percentage (fixed values).
ACTIONS = (
    ("Duplicates Removed", "duplicates_removed", True),
    ("Missing Values Handled", "missing_filled", True),
    ("Outliers Capped", "outliers_detected", True),
    ("Text Fields Standardized", "text_standardized", False),
    ("Timestamps Standardized", "timestamps_valid", False),
)


def cleaning_actions(summary: DataFrame) -> DataFrame:
    """(action, count, percent of input rows or null) of a cleaning run."""
    s = summary.groupBy().pivot("metric", ["initial_rows", *[m for _, m, _ in ACTIONS]]).agg(F.first("value"))
    rows = [F.struct(F.lit(a).alias("action"), F.coalesce(F.col(m), F.lit(0)).alias("count"),
                     (pct(m, "initial_rows") if share else F.lit(None).cast("double")).alias("percent"))
            for a, m, share in ACTIONS]
    return s.select(F.inline(F.array(*rows)))


def full_quality_report(metrics: DataFrame, name: str, summary: DataFrame, errors: DataFrame) -> DataFrame:
    """The quality metrics (J7) with the cleaning summary and the validation errors as sections of their own."""
    null = F.lit(None).cast("string")
    s = summary.select(F.lit(name).alias("dataset"), F.lit("summary").alias("section"), null.alias("column"), "metric",
                       F.col("value").cast("double").alias("value"), null.alias("text"))
    e = errors.select(F.lit(name).alias("dataset"), F.lit("validation").alias("section"), F.col("field").alias("column"),
                      F.col("rule").alias("metric"), F.col("invalid_count").cast("double").alias("value"),
                      F.col("message").alias("text"))
    return metrics.unionByName(s).unionByName(e)


def audit(df: DataFrame, name: str, max_numeric: int | None = None, k: float = 1.5, label: str = "label",
          type_col: str = "anomaly_type") -> DataFrame:
    """Dataset audit (J9): missing (>0 only), duplicates, unguarded k=1.5 outliers
    over all numeric columns that have a value (or the first ``max_numeric``), and the
    label statistics if there is a label column (D11); percents of all rows.  Long form (dataset, section, column, metric, value, text)."""
    spark = df.sparkSession
    cols = df.columns
    nums = S.numeric_columns(df)
    head = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"nn_{c}") for c in cols]).first()
    n = head["_n"]
    rows = [(name, "basic", None, "num_rows", float(n), None),
            (name, "basic", None, "num_columns", float(len(cols)), None)]
    for c in cols:
        miss = n - head[f"nn_{c}"]
        if miss > 0:
            rows.append((name, "missing", c, "missing_count", float(miss), None))
            rows.append((name, "missing", c, "missing_pct", round(miss / n * 100.0, 2) if n else 0.0, None))
    dup = S.duplicate_rows(df).first()
    rows.append((name, "duplicates", None, "duplicate_rows", float(dup["duplicate_rows"]), None))
    rows.append((name, "duplicates", None, "duplicate_pct", float(dup["duplicate_pct"]), None))
    checked = [c for c in nums[:max_numeric] if head[f"nn_{c}"] > 0]
    if checked:
        qs = quantile_values(df, checked, [0.25, 0.75])
        cnt = df.agg(*[F.count_if(O.iqr_flag(F.col(c).cast("double"), F.lit(qs[c][0]), F.lit(qs[c][1]), k, False))
                       .alias(c) for c in checked]).first()
        for c in checked:
            rows.append((name, "outliers", c, "outliers", float(cnt[c]), None))
            rows.append((name, "outliers", c, "outlier_pct", round(cnt[c] / n * 100.0, 2) if n else 0.0, None))
    if label not in cols:
        return spark.createDataFrame(rows, METRIC_SCHEMA)
    st = S.label_stats(df, label).first()
    rows += [(name, "labels", None, m, float(st[m]), None) for m in ("anomaly_pct", "class_imbalance")]
    dist = S.label_distribution(df, label, type_col).select(
        F.lit(name).alias("dataset"), F.lit("labels").alias("section"), F.col("value").alias("column"),
        F.concat("kind", F.lit("_count")).alias("metric"), F.col("n").cast("double").alias("value"),
        F.lit(None).cast("string").alias("text"))
    return spark.createDataFrame(rows, METRIC_SCHEMA).unionByName(dist)


RULES = (
    # section, metric, threshold, level, text  (J10, fixed values)
    ("missing", "missing_pct", 20.0, "drop", "consider dropping the column"),
    ("missing", "missing_pct", 5.0, "impute", "needs imputation"),
    ("duplicates", "duplicate_pct", 10.0, "dedup", "consider deduplication"),
    ("labels", "class_imbalance", 30.0, "resample", "consider resampling"),
    ("outliers", "outlier_pct", 10.0, "check", "check validity"),
)


def recommend(metrics: DataFrame) -> DataFrame:
    """Rule table joined to the long metrics; missing >20 wins over >5.
    A dataset without any finding gets one 'good' line."""
    spark = metrics.sparkSession
    rules = spark.createDataFrame(list(RULES), "section string, metric string, threshold double, level string, "
                                               "advice string")
    hits = (metrics.join(F.broadcast(rules), ["section", "metric"])
            .where(F.col("value") > F.col("threshold")))
    # per (dataset, section, column, metric) keep the highest threshold passed
    best = (hits.groupBy("dataset", "section", "column", "metric")
            .agg(F.max_by(F.struct("level", "advice", "value"), F.col("threshold")).alias("r"))
            .select("dataset", "column", F.col("r.level").alias("level"),
                    F.concat(F.coalesce(F.concat(F.lit("column "), F.col("column"), F.lit(": ")), F.lit("")),
                             F.col("r.value").cast("string"), F.lit("% - "), F.col("r.advice")).alias("recommendation")))
    ds = metrics.select("dataset").distinct()
    good = (ds.join(best.select("dataset").distinct(), "dataset", "left_anti")
            .select("dataset", F.lit(None).cast("string").alias("column"), F.lit("good").alias("level"),
                    F.lit("good quality - ready for processing").alias("recommendation")))
    return best.unionByName(good)


def audit_all(named: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Audit several datasets: (metrics, recommendations, per-dataset pass/warn + totals)."""
    # the datasets do not depend on each other: their jobs are submitted together
    with ThreadPoolExecutor(max_workers=min(AUDITS_AT_ONCE, len(named))) as pool:
        audits = list(pool.map(lambda x: audit(x[1], x[0]), named))
    metrics = reduce(DataFrame.unionByName, audits)
    recs = recommend(metrics)
    status = (metrics.where(F.col("metric") == "num_rows").select("dataset", F.col("value").cast("long").alias("rows"))
              .join(recs.groupBy("dataset").agg(F.count_if(F.col("level") == "drop").alias("n_drop"),
                                                F.count_if(F.col("level") != "good").alias("n_findings")),
                    "dataset", "left")
              .select("dataset", "rows", F.coalesce("n_findings", F.lit(0)).cast("long").alias("findings"),
                      F.when(F.coalesce("n_drop", F.lit(0)) == 0, "pass").otherwise("warn").alias("status")))
    total = status.agg(F.lit("TOTAL").alias("dataset"), F.sum("rows").cast("long").alias("rows"),
                       F.sum("findings").cast("long").alias("findings"),
                       F.when(F.count_if(F.col("status") != "pass") == 0, "pass").otherwise("warn").alias("status"))
    return metrics, recs, status.unionByName(total)


def quality_report(df: DataFrame, name: str, k: float = 3.0) -> DataFrame:
    """Quality metrics bundle (J7): rows, missing, duplicates, numeric and text
    statistics and types, as one long table (J8 adds the cleaning log)."""
    spark = df.sparkSession
    parts = [S.missing_stats(df).select(
        F.lit(name).alias("dataset"), F.lit("missing").alias("section"), "column",
        F.inline(F.array(F.struct(F.lit("missing_count").alias("metric"), F.col("missing_count").cast("double").alias("value")),
                         F.struct(F.lit("missing_pct").alias("metric"), F.col("missing_pct").cast("double").alias("value")))),
        F.lit(None).cast("string").alias("text"))]
    d = S.duplicate_rows(df)
    parts.append(d.select(F.lit(name).alias("dataset"), F.lit("duplicates").alias("section"),
                          F.lit(None).cast("string").alias("column"),
                          F.inline(F.array(F.struct(F.lit("duplicate_rows").alias("metric"),
                                                    F.col("duplicate_rows").cast("double").alias("value")),
                                           F.struct(F.lit("duplicate_pct").alias("metric"),
                                                    F.col("duplicate_pct").cast("double").alias("value")))),
                          F.lit(None).cast("string").alias("text")))
    nums = S.numeric_columns(df)
    if nums:
        npf = S.numeric_profile(df, nums, k, True)
        ms = ["mean", "median", "std", "min", "max", "q25", "q75", "outliers_iqr"]
        parts.append(npf.select(F.lit(name).alias("dataset"), F.lit("numeric").alias("section"), "column",
                                F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                                   for m in ms])),
                                F.lit(None).cast("string").alias("text")))
    strs = S.string_columns(df)
    if strs:
        tp = S.text_profile(df, strs)
        parts.append(tp.select(F.lit(name).alias("dataset"), F.lit("text").alias("section"), "column",
                               F.inline(F.array(
                                   F.struct(F.lit("unique_count").alias("metric"), F.col("unique_count").cast("double").alias("value"),
                                            F.lit(None).cast("string").alias("text")),
                                   F.struct(F.lit("most_frequent").alias("metric"), F.lit(None).cast("double").alias("value"),
                                            F.col("most_frequent").alias("text")),
                                   F.struct(F.lit("avg_length").alias("metric"), F.col("avg_length").cast("double").alias("value"),
                                            F.lit(None).cast("string").alias("text")),
                                   F.struct(F.lit("max_length").alias("metric"), F.col("max_length").cast("double").alias("value"),
                                            F.lit(None).cast("string").alias("text"))))))
    types = spark.createDataFrame([(name, "types", c, "dtype", None, t) for c, t in df.dtypes], METRIC_SCHEMA)
    parts.append(types)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
