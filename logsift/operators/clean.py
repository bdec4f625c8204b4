"""Cleaning steps and the cleaning pipeline.

Bounded passes only: a null-pattern histogram (at most 2^k rows for k
checked fields), medians/modes of the rows alive at each fill step,
quantiles for outlier bounds, and a handful of counts.  Everything else stays
one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logsift.contracts import (CRITICAL_FIELDS, DUPLICATE_KEYS, DUPLICATE_WINDOW_SECONDS, K8S_LOG,
                               MAX_MISSING_PCT, OUTLIER_FIELDS, OUTLIER_K_CLEANING,
                               Contract)
from logsift.functions import outlier as O
from logsift.functions.text import changed, standardise_text, truncate
from logsift.functions.time import parse_ts
from logsift.operators.dedup import drop_duplicates
from logsift.operators.quantiles import quantile_values
from logsift.operators.stats import NUMERIC, mode_values
from logsift.session import scratch_path

MAX_PATTERN_FIELDS = 16   # null-pattern histogram over at most 2^16 rows

LOG_SCHEMA = ("step_no int, step string, field string, action string, fill_value string, "
              "count long, rows_removed_here long, rows_removed_cumulative long")


# --- I1-I5: missing values ----------------------------------------------------

@dataclass
class MissingPlan:
    keep: Column                      # row filter
    fills: dict[str, object]          # field -> fill value
    log: list[tuple]                  # rows of LOG_SCHEMA
    rows_in: int
    rows_out: int


def plan_missing(df: DataFrame, contract: Contract = K8S_LOG, critical: Sequence[str] = CRITICAL_FIELDS,
                 max_pct: float = MAX_MISSING_PCT, mode: str = "threshold") -> MissingPlan:
    """Replay the reference's sequential missing-value rules exactly.

    One ``groupBy(null pattern).count()`` (at most 2^k rows) drives every
    decision; fill values are then computed over the rows alive at that step.
    """
    crit = [f for f in critical if f in df.columns]
    rest = [r.name for r in contract if r.name in df.columns and r.name not in critical]
    fields = crit + rest
    if len(fields) > MAX_PATTERN_FIELDS:
        # only fields that hold a null can change a decision; keep the
        # histogram provably small (<= 2^MAX_PATTERN_FIELDS rows)
        nulls = df.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields]).first()
        fields = [f for f in fields if nulls[f] > 0]
        crit = [f for f in crit if f in fields]
        rest = [f for f in rest if f in fields]
        if len(fields) > MAX_PATTERN_FIELDS:
            return _plan_missing_sequential(df, contract, crit, rest, max_pct, mode)
    if not fields:
        n = df.count()
        return MissingPlan(F.lit(True), {}, [], n, n)
    hist = df.groupBy(*[F.col(f).isNull().alias(f"_n{i}") for i, f in enumerate(fields)]) \
        .agg(F.count(F.lit(1)).alias("c")).collect()
    pats = [(tuple(bool(r[f"_n{i}"]) for i in range(len(fields))), r["c"]) for r in hist]
    idx = {f: i for i, f in enumerate(fields)}
    alive = list(pats)
    initial = sum(c for _, c in pats)
    dropped: list[str] = []
    fills_at: dict[str, list[str]] = {}
    log: list[tuple] = []
    step = 0

    def count(rows, f=None):
        return sum(c for p, c in rows if f is None or p[idx[f]])

    for f in crit:
        n = count(alive)
        miss = count(alive, f)
        pct_missing = (miss / n * 100.0) if n else 0.0
        if (mode == "always" and miss > 0) or pct_missing > max_pct:
            alive = [(p, c) for p, c in alive if not p[idx[f]]]
            dropped.append(f)
            step += 1
            log.append((step, "missing", f, "removed_rows", None, miss, miss, initial - count(alive)))
    for f in rest:
        miss = count(alive, f)
        if miss == 0:
            continue
        rule = contract.get(f)
        dtype = df.schema[f].dataType
        if rule is not None and rule.nullable:
            if rule.numeric and isinstance(dtype, NUMERIC):
                fills_at[f] = list(dropped)
                step += 1
                log.append((step, "missing", f, "filled_with_median", None, miss, 0, initial - count(alive)))
            elif rule.dtype == "string":
                fills_at[f] = list(dropped)
                step += 1
                log.append((step, "missing", f, "filled_with_mode", None, miss, 0, initial - count(alive)))
        else:
            alive = [(p, c) for p, c in alive if not p[idx[f]]]
            dropped.append(f)
            step += 1
            log.append((step, "missing", f, "removed_rows", None, miss, miss, initial - count(alive)))

    def alive_expr(drops: Sequence[str]) -> Column:
        e = F.lit(True)
        for d in drops:
            e = e & F.col(d).isNotNull()
        return e

    fills: dict[str, object] = {}
    # group fills by the alive condition so each group is one pass
    groups: dict[tuple, list[str]] = {}
    for f, drops in fills_at.items():
        groups.setdefault(tuple(drops), []).append(f)
    for drops, fs in groups.items():
        sub = df.where(alive_expr(drops))
        nums = [f for f in fs if contract.get(f).numeric]
        strs = [f for f in fs if f not in nums]
        rows_here = sum(c for p, c in pats if not any(p[idx[d]] for d in drops))
        if nums:
            med = quantile_values(sub, nums, [0.5])
            fills.update({f: med[f][0] for f in nums})
        if strs:
            fills.update(mode_values(sub, strs, default="unknown"))
    log = [(s, st, f, a, (None if f not in fills else (None if fills[f] is None else str(fills[f]))), c, h, cum)
           for (s, st, f, a, _, c, h, cum) in log]
    return MissingPlan(alive_expr(dropped), fills, log, initial, count(alive))


def _plan_missing_sequential(df: DataFrame, contract: Contract, crit: Sequence[str], rest: Sequence[str],
                             max_pct: float, mode: str) -> MissingPlan:
    """Same rules, one small aggregate per step (for contracts with very many
    nullable-in-practice fields, where a pattern histogram has no useful bound)."""
    keep = F.lit(True)
    initial = df.count()
    alive_n = initial
    log, fills, step = [], {}, 0
    for f in crit:
        r = df.where(keep).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(f).isNull()).alias("m")).first()
        n, miss = r["n"], r["m"]
        if (mode == "always" and miss > 0) or (n and miss / n * 100.0 > max_pct):
            keep = keep & F.col(f).isNotNull()
            alive_n -= miss
            step += 1
            log.append((step, "missing", f, "removed_rows", None, miss, miss, initial - alive_n))
    for f in rest:
        miss = df.where(keep).agg(F.count_if(F.col(f).isNull()).alias("m")).first()["m"]
        if miss == 0:
            continue
        rule = contract.get(f)
        if rule is not None and rule.nullable:
            sub = df.where(keep)
            if rule.numeric and isinstance(df.schema[f].dataType, NUMERIC):
                fills[f] = quantile_values(sub, [f], [0.5])[f][0]
                action = "filled_with_median"
            elif rule.dtype == "string":
                fills[f] = mode_values(sub, [f], default="unknown")[f]
                action = "filled_with_mode"
            else:
                continue
            step += 1
            log.append((step, "missing", f, action, None if fills[f] is None else str(fills[f]), miss, 0,
                        initial - alive_n))
        else:
            keep = keep & F.col(f).isNotNull()
            alive_n -= miss
            step += 1
            log.append((step, "missing", f, "removed_rows", None, miss, miss, initial - alive_n))
    return MissingPlan(keep, fills, log, initial, alive_n)


def apply_missing(df: DataFrame, plan: MissingPlan) -> DataFrame:
    out = df.where(plan.keep)
    fills = {f: F.coalesce(F.col(f), F.lit(v).cast(df.schema[f].dataType)) for f, v in plan.fills.items()
             if v is not None}
    return out.withColumns(fills) if fills else out


# --- I6, H16-H18: outliers ------------------------------------------------------

def outlier_bounds(df: DataFrame, fields: Sequence[str], k: float = OUTLIER_K_CLEANING,
                   guard: bool = True) -> dict[str, dict]:
    fields = [f for f in fields if f in df.columns and isinstance(df.schema[f].dataType, NUMERIC)]
    qs = quantile_values(df, fields, [0.25, 0.75])
    out = {}
    for f in fields:
        q1, q3 = qs[f]
        if q1 is None:
            continue
        iqr = q3 - q1
        out[f] = {"q1": q1, "q3": q3, "iqr": iqr, "lower": q1 - k * iqr, "upper": q3 + k * iqr,
                  "active": (iqr != 0) or not guard}
    return out


def outlier_flags(bounds: dict[str, dict]) -> dict[str, Column]:
    return {f: (F.coalesce((F.col(f) < b["lower"]) | (F.col(f) > b["upper"]), F.lit(False))
                if b["active"] else F.lit(False)) for f, b in bounds.items()}


def cap_outliers(df: DataFrame, fields: Sequence[str] = OUTLIER_FIELDS, k: float = OUTLIER_K_CLEANING,
                 guard: bool = True):
    """Cap numeric fields at their IQR bounds when they have outliers.

    Returns (frame, log rows [(field, count, pct, method)]); one count pass.
    """
    bounds = outlier_bounds(df, fields, k, guard)
    flags = outlier_flags(bounds)
    if not flags:
        return df, []
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(v).alias(f) for f, v in flags.items()]).first()
    n = counts["_n"]
    log, caps = [], {}
    for f in flags:
        c = counts[f]
        if c > 0:
            log.append((f, int(c), round(c / n * 100.0, 2) if n else 0.0, "iqr"))
            caps[f] = O.clip(F.col(f), F.lit(bounds[f]["lower"]), F.lit(bounds[f]["upper"]))
    return (df.withColumns(caps) if caps else df), log


def winsorise(df: DataFrame, fields: Sequence[str], k: float = OUTLIER_K_CLEANING, guard: bool = True):
    """Cap at p1/p99 when the field has IQR outliers."""
    bounds = outlier_bounds(df, fields, k, guard)
    flags = outlier_flags(bounds)
    if not flags:
        return df
    counts = df.agg(*[F.count_if(v).alias(f) for f, v in flags.items()]).first()
    hit = [f for f in flags if counts[f] > 0]
    if not hit:
        return df
    ps = quantile_values(df, hit, [0.01, 0.99])
    return df.withColumns({f: O.clip(F.col(f), F.lit(ps[f][0]), F.lit(ps[f][1])) for f in hit})


def drop_outliers(df: DataFrame, fields: Sequence[str], k: float = OUTLIER_K_CLEANING,
                  guard: bool = True) -> DataFrame:
    """Remove rows flagged in any field."""
    flags = outlier_flags(outlier_bounds(df, fields, k, guard))
    if not flags:
        return df
    any_flag = F.lit(False)
    for v in flags.values():
        any_flag = any_flag | v
    return df.where(~any_flag)


# --- F1 ---------------------------------------------------------------------------

def order_by_time(df: DataFrame, ts: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Unparseable/missing times last; range-partitioned global sort (F1)."""
    keys = [F.asc_nulls_last(ts)] + ([F.asc(tiebreak)] if tiebreak else [])
    return df.orderBy(*keys)


# --- I7: the pipeline ----------------------------------------------------------------

@dataclass
class CleanResult:
    """``data`` is ordered when it is read; ``errors`` are looked for when they are asked for."""
    data: DataFrame
    log: DataFrame
    summary: DataFrame
    validation: Callable[[], DataFrame]

    @cached_property
    def errors(self) -> DataFrame:
        return self.validation()


def clean(df: DataFrame, pos_col: str, contract: Contract = K8S_LOG, missing_mode: str = "threshold",
          text_fields: Sequence[str] = ("message",), dedup_keys: Sequence[str] = DUPLICATE_KEYS,
          dedup_seconds: int = DUPLICATE_WINDOW_SECONDS, outlier_fields: Sequence[str] = OUTLIER_FIELDS,
          max_length: int | None = None) -> CleanResult:
    """missing -> timestamps -> text -> duplicates -> outliers -> order -> validate.

    Whole texts by default; ``max_length`` asks for the cut (H4), and the summary then
    counts the values that it shortened (``text_cut``)."""
    from logsift.operators.validate import validate
    spark = df.sparkSession
    plan = plan_missing(df, contract, mode=missing_mode)
    step1 = apply_missing(df, plan)
    # timestamps (H11): parse + UTC; unparseable -> null, rows kept
    step2 = step1.withColumn("timestamp", parse_ts("timestamp")) if "timestamp" in df.columns else step1
    # text (H5)
    tf = [f for f in text_fields if f in df.columns]
    step3 = step2.withColumns({f"_old_{f}": F.col(f) for f in tf}) \
        .withColumns({f: standardise_text(F.col(f)) for f in tf})
    if max_length is not None:
        step3 = step3.withColumns({f"_cut_{f}": F.length(f) > max_length for f in tf}) \
            .withColumns({f: F.trim(truncate(f, max_length)) for f in tf})
    c_aggs = [F.count(F.lit(1)).alias("rows")]
    if "timestamp" in df.columns:
        c_aggs += [F.count("timestamp").alias("ts_valid")]
    c_aggs += [F.count_if(changed(F.col(f"_old_{f}"), F.col(f))).alias(f"chg_{f}") for f in tf]
    if max_length is not None:
        c_aggs += [F.count_if(f"_cut_{f}").alias(f"cut_{f}") for f in tf]
    # the one write of the cleaned table counts the rows before and after the duplicates go (E2);
    # it lies in the shared folder, so later passes survive lost executors
    texts, kept = Observation(), Observation()
    step3 = step3.observe(texts, *c_aggs).drop(*[f"{p}_{f}" for f in tf for p in ("_old", "_cut")])
    keys = [k for k in dedup_keys if k in df.columns]
    step4 = drop_duplicates(step3, keys, pos_col, "timestamp", dedup_seconds) if keys else step3
    path = scratch_path(spark, "clean")
    step4.observe(kept, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    step4 = spark.read.parquet(path)
    c3, n4 = texts.get, kept.get["rows"]
    # outliers (I6)
    step5, out_log = cap_outliers(step4, outlier_fields)
    # order (F1)
    step6 = order_by_time(step5, "timestamp", pos_col) if "timestamp" in df.columns else step5

    log_rows = list(plan.log)
    s = len(log_rows)
    for f, c, p, m in out_log:
        s += 1
        log_rows.append((s, "outliers", f, "capped", None, c, 0, 0))
    log_df = spark.createDataFrame(log_rows, LOG_SCHEMA)
    summary = [
        ("initial_rows", plan.rows_in), ("rows_after_missing", plan.rows_out),
        ("timestamps_valid", int(c3["ts_valid"]) if "timestamp" in df.columns else 0),
        ("timestamps_unparsed", int(c3["rows"] - c3["ts_valid"]) if "timestamp" in df.columns else 0),
        ("text_standardized", int(sum(c3[f"chg_{f}"] for f in tf))),
        ("duplicates_removed", int(c3["rows"] - n4)),
        ("outliers_detected", int(sum(c for _, c, _, _ in out_log))),
        ("missing_filled", int(sum(r[5] for r in plan.log if r[3].startswith("filled")))),
        ("final_rows", int(n4)),
        ("rows_removed", int(plan.rows_in - n4)),
    ]
    if max_length is not None:
        summary.append(("text_cut", int(sum(c3[f"cut_{f}"] for f in tf))))
    summary_df = spark.createDataFrame(summary, "metric string, value long")
    return CleanResult(step6, log_df, summary_df, lambda: validate(step5, contract, pos_col=pos_col))
