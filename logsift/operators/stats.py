"""Profiling aggregates.

Every statistic over many columns is one generated ``agg`` (one scan),
unpivoted to long form afterwards; drivers see at most one row per column.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.functions import outlier as O
from logsift.functions.rules import pct
from logsift.functions.time import span_days
from logsift.operators.dedup import digest
from logsift.operators.quantiles import quantile_values

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def with_bounds(df: DataFrame, stats_row: DataFrame) -> DataFrame:
    """Apply a 1-row statistics frame to every row (C3): its single row is read
    (bounded metadata) and attached as typed literals, so no join is planned."""
    row = stats_row.first()
    types = {f.name: f.dataType for f in stats_row.schema.fields}
    return df.withColumns({k: F.lit(v).cast(types[k]) for k, v in row.asDict().items()})


def _unpivot(wide: DataFrame, cols: Sequence[str], metrics: Sequence[str], key: str = "column") -> DataFrame:
    """wide 1-row frame with ``{metric}__{col}`` -> one row per col."""
    arr = F.array(*[F.struct(F.lit(c).alias(key), *[F.col(f"`{m}__{c}`").alias(m) for m in metrics])
                    for c in cols])
    return wide.select(F.inline(arr))


# --- D1, D2 -------------------------------------------------------------------

def missing_stats(df: DataFrame) -> DataFrame:
    """(column, dtype, missing_count, non_missing_count, missing_pct) in one scan."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing_count__{c}") for c in cols]
    wide = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    arr = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
                             F.col(f"`missing_count__{c}`").alias("missing_count")) for i, c in enumerate(cols)])
    return (wide.select("__n", F.inline(arr))
            .select("ordinal", "column", "dtype", "missing_count",
                    (F.col("__n") - F.col("missing_count")).alias("non_missing_count"),
                    pct("missing_count", "__n").alias("missing_pct")))


def missing_overall(df: DataFrame) -> DataFrame:
    """Total missing cells, overall percent of cells, columns with missing."""
    m = missing_stats(df)
    ncols = len(df.columns)
    return m.agg(
        F.max(F.col("missing_count") + F.col("non_missing_count")).alias("total_rows"),
        F.sum("missing_count").alias("total_missing"),
        F.coalesce(F.round(F.try_divide(F.sum("missing_count").cast("double") * 100.0,
                                        F.max(F.col("missing_count") + F.col("non_missing_count")) * ncols), 2),
                   F.lit(0.0)).alias("overall_missing_pct"),
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list(
            F.when(F.col("missing_count") > 0, F.struct("ordinal", "column")))), lambda s: s["column"]))
        .alias("columns_with_missing"))


# --- D4 ----------------------------------------------------------------------

def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None, k: float = 3.0,
                    guard: bool = True, digits: int = 6) -> DataFrame:
    """mean, median, std (ddof 1), min, max, q25, q75, IQR outlier count."""
    cols = list(cols or numeric_columns(df))
    qs = quantile_values(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        q1, q3 = qs[c][0], qs[c][2]
        flag = (O.iqr_flag(x, F.lit(q1), F.lit(q3), k, guard) if q1 is not None else F.lit(False))
        aggs += [F.avg(x).alias(f"mean__{c}"), F.stddev_samp(x).alias(f"std__{c}"),
                 F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}"),
                 F.count_if(flag).alias(f"outliers_iqr__{c}")]
    wide = df.agg(*aggs)
    long = _unpivot(wide, cols, ["mean", "std", "min", "max", "outliers_iqr"])
    qdf = df.sparkSession.createDataFrame(
        [(c, *[None if v is None else float(v) for v in qs[c]]) for c in cols],
        "column string, q25 double, median double, q75 double")
    r = lambda c: F.round(F.col(c), digits)
    return (long.join(F.broadcast(qdf), "column")
            .select("column", r("mean").alias("mean"), r("median").alias("median"), r("std").alias("std"),
                    r("min").alias("min"), r("max").alias("max"), r("q25").alias("q25"), r("q75").alias("q75"),
                    "outliers_iqr"))


# --- D5, D6 ------------------------------------------------------------------

#: First characters of a text that travel with its hash: they settle most ties for the mode.
PREFIX = 64


def cells(df: DataFrame, cols: Sequence[str], *more: Column) -> DataFrame:
    """(c, h1, h2, ...): a row for each cell, the column's number and a 128-bit hash of its value (null for null).

    Whatever is counted by value goes by this key of fixed size: no value is a shuffle key, and no row is copied whole."""
    def cell(i: int, c: str) -> Column:
        x = F.col(f"`{c}`")
        return F.struct(F.lit(i).alias("c"), F.when(x.isNotNull(), F.xxhash64(x)).alias("h1"), F.xxhash64(F.lit(7), x).alias("h2"),
                        *[m(x, df.schema[c].dataType) for m in more])

    return df.select(F.inline(F.array(*[cell(i, c) for i, c in enumerate(cols)])))


def _text(x: Column, _) -> Column:
    return x.cast("string").alias("value")


def text_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """distinct count, most frequent (smallest on ties), mean and max length.

    Two-level aggregation by the hash of a value: a hot value costs one row a task.  The most frequent values of a column are
    told apart by their first characters, one row per column; a second scan keeps only the cells that begin so,
    and takes the smallest of those that are as frequent.
    """
    cols = list(cols or string_columns(df))
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, unique_count long, most_frequent string, avg_length double, max_length long")
    size = lambda x, _: F.length(x.cast("string")).alias("size")
    head = lambda x, _: F.substring(x.cast("string"), 1, PREFIX).alias("head")
    counted = (cells(df, cols, size, head).where("h1 is not null").groupBy("c", "h1", "h2")
               .agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.min("head").alias("head")))
    per = (counted.groupBy("c").agg(
        F.count(F.lit(1)).alias("unique_count"), F.min(F.struct((-F.col("n")).alias("neg"), F.col("head"))).alias("top"),
        F.round(F.sum(F.col("size") * F.col("n")) / F.sum("n"), digits).alias("avg_length"),
        F.max("size").cast("long").alias("max_length")).collect())  # one row per column
    names = df.sparkSession.createDataFrame([(r["c"], cols[r["c"]], r["unique_count"], r["avg_length"], r["max_length"]) for r in per],
                                            "c int, column string, unique_count long, avg_length double, max_length long")
    like, often = F.lit(False), F.lit(None).cast("long")
    for r in per:
        like = like | ((F.col("c") == r["c"]) & (F.substring("value", 1, PREFIX) == r["top"]["head"]))
        often = F.when(F.col("c") == r["c"], F.lit(-r["top"]["neg"])).otherwise(often)
    modes = (cells(df, cols, _text).where(F.col("h1").isNotNull() & like).groupBy("c", "h1", "h2")
             .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value")).where(F.col("n") == often)
             .groupBy("c").agg(F.min("value").alias("most_frequent")))
    return modes.join(F.broadcast(names), "c").select("column", "unique_count", "most_frequent", "avg_length", "max_length")


def mode_values(df: DataFrame, cols: Sequence[str], default: str | None = "unknown") -> dict[str, str | None]:
    """Most frequent non-null value per column, smallest on ties."""
    if not cols:
        return {}
    rows = {r["column"]: r["most_frequent"] for r in text_profile(df, cols).select("column", "most_frequent").collect()}
    return {c: rows.get(c, default) for c in cols}


# --- D7, D8, D9, D10 -----------------------------------------------------------

def value_counts(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """(value, n, pct) most frequent first; pct of the grand total."""
    total = df.count()          # one number; the scan reads no column
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return (counts.select(col, "n", pct("n", F.lit(total), digits).alias("pct"))
            .orderBy(F.desc("n"), F.asc_nulls_last(col)))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Full-row duplicates (all but the first of each group), nulls equal (D8); a row's SHA-256 is its key."""
    cols = list(cols or df.columns)
    key = digest([(F.col(f"`{c}`"), df.schema[c].dataType) for c in cols])
    g = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("total_rows"),
                 F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows")) \
        .withColumn("duplicate_pct", pct("duplicate_rows", "total_rows"))


def _per_column(df: DataFrame, cols: Sequence[str], counted: DataFrame) -> DataFrame:
    """``counted`` (by column number ``c``) under the columns' names, null where a column has no cell."""
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "c int, column string")
    return names.join(counted, "c", "left").drop("c")  # one row per column


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (D9), by 128-bit hashes; one scan."""
    cols = list(cols or df.columns)
    if approx:
        wide = df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"distinct__{c}") for c in cols])
        return _unpivot(wide, cols, ["distinct"])
    values = cells(df, cols).where("h1 is not null").groupBy("c", "h1", "h2").agg(F.lit(1).alias("one"))
    counted = _per_column(df, cols, values.groupBy("c").agg(F.count(F.lit(1)).alias("distinct")))
    return counted.select("column", F.coalesce("distinct", F.lit(0)).cast("long").alias("distinct"))


def sample_values(df: DataFrame, col: str, k: int, pos_col: str, include_null: bool = False) -> DataFrame:
    """First k distinct values in order of first appearance."""
    src = df if include_null else df.where(F.col(col).isNotNull())
    return (src.groupBy(col).agg(F.min(pos_col).alias("_first"))
            .orderBy("_first").limit(k))


def sample_values_joined(df: DataFrame, cols: Sequence[str], k: int, pos_col: str, sep: str = "|") -> DataFrame:
    """(column, samples) with the first k distinct values joined, for many columns:
    first position per (column, hash of the value), then top-k per column through a grouped limit (partial
    top-k before the shuffle); the k values of each column are read at their positions."""
    at = lambda x, _: F.col(pos_col).alias("pos")
    firsts = cells(df, cols, at).where("h1 is not null").groupBy("c", "h1", "h2").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy("c").orderBy("pos")
    top = firsts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).collect()  # k rows per column
    if not top:
        return df.sparkSession.createDataFrame([], "column string, samples string")
    asked = F.lit(False)
    for c in sorted({r["c"] for r in top}):
        asked = asked | ((F.col("c") == c) & F.col("pos").isin([r["pos"] for r in top if r["c"] == c]))
    found = cells(df.where(F.col(pos_col).isin(sorted({r["pos"] for r in top}))), cols, at, _text).where(asked)
    joined = F.concat_ws(sep, F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]))
    return _per_column(df, cols, found.groupBy("c").agg(joined.alias("samples"))).where("samples is not null")


# --- D11, D12 ---------------------------------------------------------------

def label_stats(df: DataFrame, label: str = "label", type_col: str | None = "anomaly_type") -> DataFrame:
    """n, label 0/1 counts, anomaly %, class imbalance %."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 0).alias("n_label0"),
        F.count_if(F.col(label) == 1).alias("n_label1"),
    ).select("n", "n_label0", "n_label1",
             pct("n_label1", "n").alias("anomaly_pct"),
             F.coalesce(F.round(F.try_divide(F.abs(F.col("n_label0") - F.col("n_label1")).cast("double") * 100.0,
                                             F.col("n").cast("double")), 2), F.lit(0.0)).alias("class_imbalance"))


def label_distribution(df: DataFrame, label: str = "label", type_col: str | None = "anomaly_type") -> DataFrame:
    """(kind, value, n): rows per label value and, if there is one, per type; nulls are not counted."""
    kinds = [(k, c) for k, c in (("label", label), ("type", type_col)) if c in df.columns]
    arr = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in kinds])
    return (df.select(F.inline(arr)).where(F.col("value").isNotNull())
            .groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")))


def label_summary(df: DataFrame, by: str, label: str = "label") -> DataFrame:
    """Per group: rows, normal, anomalous, anomaly rate."""
    return (df.groupBy(by).agg(F.count(F.lit(1)).alias("n"),
                               F.count_if(F.col(label) == 0).alias("normal"),
                               F.coalesce(F.sum(F.col(label)), F.lit(0)).cast("long").alias("anomalous"))
            .withColumn("anomaly_rate", pct("anomalous", "n")))


# --- D17, D26, D27, J12 ------------------------------------------------------

def time_range(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """first, last, whole days between, total rows, rows per day (0 if span 0)."""
    t = F.col(ts).cast("timestamp")
    a = df.agg(F.min(t).alias("first_ts"), F.max(t).alias("last_ts"), F.count(F.lit(1)).alias("total"),
               F.count(t).alias("valid"))
    d = span_days("first_ts", "last_ts")
    return a.select(F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
                    F.col("last_ts").cast("timestamp_ntz").alias("last_ts"),
                    d.alias("span_days"), "total",
                    F.when(d > 0, F.floor(F.col("total") / d)).otherwise(F.lit(0)).cast("long").alias("per_day"))


def basic_stats(df: DataFrame) -> DataFrame:
    """rows, columns, names."""
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        "num_rows", F.lit(len(df.columns)).cast("long").alias("num_columns"),
        F.lit(",".join(df.columns)).alias("column_names"))


def schema_info(df: DataFrame, pos_col: str, k: int = 3) -> DataFrame:
    """(column, dtype, unique_values, sample_values) - strings only get the
    distinct count and the first k distinct values (D26)."""
    strings = string_columns(df)
    dtypes = dict(df.dtypes)
    base = df.sparkSession.createDataFrame([(i, c, dtypes[c]) for i, c in enumerate(df.columns)],
                                           "ordinal int, column string, dtype string")
    if not strings:
        return base.select("ordinal", "column", "dtype", F.lit(None).cast("long").alias("unique_values"),
                           F.lit(None).cast("string").alias("sample_values"))
    dc = distinct_counts(df, strings).withColumnRenamed("distinct", "unique_values")
    sv = sample_values_joined(df, strings, k, pos_col).withColumnRenamed("samples", "sample_values")
    return (base.join(dc, "column", "left").join(sv, "column", "left")
            .select("ordinal", "column", "dtype", F.col("unique_values").cast("long").alias("unique_values"),
                    "sample_values"))


def column_profile(df: DataFrame, digits: int = 6) -> DataFrame:
    """non-null, null count, null %, distinct, mean/min/max for numerics.

    One scan: cells are counted and summed by the hash of their value, then by column."""
    cols = df.columns
    number = lambda x, kind: (x.cast("double") if isinstance(kind, NUMERIC) else F.lit(None).cast("double")).alias("x")
    values = cells(df, cols, number).groupBy("c", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    there = F.col("h1").isNotNull()
    found = values.groupBy("c").agg(F.sum("n").alias("rows"), F.sum(F.when(there, F.col("n"))).alias("non_null"), F.count_if(there).alias("unique"),
                                    F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    dtypes = dict(df.dtypes)
    kinds = df.sparkSession.createDataFrame([(c, dtypes[c]) for c in cols], "column string, dtype string")
    n, rows = F.coalesce("non_null", F.lit(0)).cast("long"), F.coalesce("rows", F.lit(0)).cast("long")
    return _per_column(df, cols, found).join(F.broadcast(kinds), "column").select(
        "column", "dtype", n.alias("non_null"), (rows - n).alias("null_count"), pct(rows - n, rows).alias("null_pct"),
        F.coalesce("unique", F.lit(0)).cast("long").alias("unique"), F.round(F.try_divide("s", n), digits).alias("mean"),
        F.round("lo", digits).alias("min"), F.round("hi", digits).alias("max"))
