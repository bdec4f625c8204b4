"""Contract validation (J1-J6): one aggregate for every count, data unchanged."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.contracts import K8S_LOG, Contract, FieldRule
from logsift.functions import rules as R

ERROR_SCHEMA = "field string, rule string, invalid_count long, sample string, message string"


def _py_num(v) -> str:
    """Python repr of a contract bound (float keeps '.0')."""
    return repr(float(v)) if isinstance(v, float) else repr(v)


def _py_list(values) -> str:
    return "[" + ", ".join(repr(v) for v in values) + "]"


def _checks(df: DataFrame, contract: Contract, strict: bool) -> list[tuple[str, str, Column, str]]:
    """(field, rule, invalid predicate, message template with {n}) in reference order."""
    out = []
    for r in contract:
        if r.name not in df.columns:
            continue
        c = F.col(r.name)
        if r.allowed is not None:
            out.append((r.name, "allowed_values", R.not_in_list(c, r.allowed),
                        f"Field '{r.name}': {{n}} rows have invalid values. Sample: {{sample}}"))
        if r.numeric:
            if r.min is not None:
                out.append((r.name, "below_min", R.below_min(c, r.min),
                            f"Field '{r.name}': {{n}} values below minimum {_py_num(r.min)}"))
            if r.max is not None:
                out.append((r.name, "above_max", R.above_max(c, r.max),
                            f"Field '{r.name}': {{n}} values above maximum {_py_num(r.max)}"))
        if strict:
            if not r.nullable:
                out.append((r.name, "not_null", c.isNull(), f"Field '{r.name}': {{n}} null values"))
            if r.min_len is not None or r.max_len is not None:
                out.append((r.name, "length", c.isNotNull() & ~R.length_between(c, r.min_len, r.max_len),
                            f"Field '{r.name}': {{n}} values outside length bounds"))
            if r.pattern is not None and r.name not in ("pod_name",):
                out.append((r.name, "pattern", c.isNotNull() & ~R.matches(c, r.pattern),
                            f"Field '{r.name}': {{n}} values do not match the pattern"))
    if "pod_name" in df.columns:
        out.append(("pod_name", "pod_name_format", ~R.is_pod_name("pod_name"),
                    "pod_name: {n} invalid pod names detected"))
    if "namespace" in df.columns:
        out.append(("namespace", "namespace_format", ~R.is_namespace("namespace"),
                    "namespace: {n} invalid namespace names detected"))
    return out


def validate(df: DataFrame, contract: Contract = K8S_LOG, pos_col: str | None = None,
             strict: bool = False, sample_size: int = 5) -> DataFrame:
    """Errors table (field, rule, invalid_count, sample, message).

    Samples are the first distinct invalid values in order of appearance
    (``pos_col``), null shown as None, like the reference's list text.
    """
    spark = df.sparkSession
    missing = [(r.name, "missing_column", None, None, f"Required field '{r.name}' is missing from data")
               for r in contract if r.required and r.name not in df.columns]
    checks = _checks(df, contract, strict)
    rows = list(missing)
    if checks:
        counts = df.agg(*[F.count_if(p).alias(f"c{i}") for i, (_, _, p, _) in enumerate(checks)]).first()
        # samples for allowed-value failures, all fields in one pass
        samp_fields = [(i, f) for i, (f, rule, _, _) in enumerate(checks)
                       if rule == "allowed_values" and counts[f"c{i}"] > 0]
        samples: dict[int, str] = {}
        if samp_fields:
            pos = F.col(pos_col) if pos_col else F.lit(0)
            arr = F.array(*[F.when(checks[i][2], F.struct(F.lit(i).alias("ci"),
                                                          F.col(f).cast("string").alias("value"),
                                                          F.lit(contract.get(f).dtype == "string").alias("q")))
                            for i, f in samp_fields])
            firsts = (df.select(pos.alias("_pos"), F.explode(arr).alias("_e")).where(F.col("_e").isNotNull())
                      .select("_pos", "_e.*").groupBy("ci", "value", "q").agg(F.min("_pos").alias("_first")))
            w = W.partitionBy("ci").orderBy("_first", F.asc_nulls_first("value"))
            top = firsts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= sample_size)
            shown = F.when(F.col("value").isNull(), F.lit("None")).when(
                F.col("q"), F.concat(F.lit("'"), F.col("value"), F.lit("'"))).otherwise(F.col("value"))
            for r in (top.groupBy("ci").agg(F.concat(F.lit("["), F.concat_ws(", ", F.transform(
                    F.array_sort(F.collect_list(F.struct("_first", shown.alias("s")))), lambda s: s["s"])),
                    F.lit("]")).alias("sample")).collect()):
                samples[r["ci"]] = r["sample"]
        for i, (f, rule, _, tmpl) in enumerate(checks):
            n = counts[f"c{i}"]
            if n > 0:
                s = samples.get(i)
                rows.append((f, rule, int(n), s, tmpl.format(n=n, sample=s)))
    return spark.createDataFrame(rows, ERROR_SCHEMA)


# --- J6 -----------------------------------------------------------------------

TYPE_TEXT = {"string": "a string", "integer": "an integer", "float": "a float", "datetime": "a datetime or string"}
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
CONFORMING = {"string": (T.StringType,), "integer": INTEGERS,
              "float": (*INTEGERS, T.FloatType, T.DoubleType, T.DecimalType),
              "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType)}


def _type_error(r: FieldRule, c: Column, dtype: T.DataType) -> Column | None:
    """Condition for a value of the wrong type (B12); numbers may come as text that casts."""
    if r.numeric and isinstance(dtype, T.StringType):
        return R.nonconforming(c, r.dtype)
    return None if isinstance(dtype, CONFORMING[r.dtype]) else c.isNotNull()


def _field_error(r: FieldRule, c: Column, dtype: T.DataType) -> Column:
    """First failing rule of one value: required -> null -> type -> range -> allowed."""
    e = None

    def add(cond, msg):
        nonlocal e
        e = F.when(cond, msg) if e is None else e.when(cond, msg)

    if r.required:
        add(c.isNull(), F.lit(f"Required field '{r.name}' is missing"))
    elif not r.nullable:
        add(c.isNull(), F.lit(f"Field '{r.name}' cannot be null"))
    wrong = _type_error(r, c, dtype)
    if wrong is not None:
        add(wrong, F.lit(f"Field '{r.name}' must be {TYPE_TEXT[r.dtype]}"))
    if r.numeric:
        txt = c.cast("string")
        if not isinstance(dtype, CONFORMING["float"]):
            c = txt.try_cast("double")
        if r.min is not None:
            add(c < F.lit(r.min), F.concat(F.lit(f"Field '{r.name}' value "), txt,
                                             F.lit(f" is below minimum {_py_num(r.min)}")))
        if r.max is not None:
            add(c > F.lit(r.max), F.concat(F.lit(f"Field '{r.name}' value "), txt,
                                             F.lit(f" is above maximum {_py_num(r.max)}")))
    if r.allowed is not None:
        add(c.isNotNull() & ~c.isin(list(r.allowed)),
            F.concat(F.lit(f"Field '{r.name}' value '"), c.cast("string"),
                     F.lit(f"' is not in allowed values {_py_list(r.allowed)}")))
    return e if e is not None else F.lit(None).cast("string")


def error_messages(df: DataFrame, contract: Contract = K8S_LOG) -> Column:
    """Array of the first failing rule of each field of ``df`` that the contract names."""
    return F.filter(F.array(*[_field_error(r, F.col(r.name), df.schema[r.name].dataType) for r in contract if r.name in df.columns]),
                    lambda x: x.isNotNull())


def row_errors(df: DataFrame, contract: Contract = K8S_LOG, pos_col: str = "log_id") -> DataFrame:
    """(pos, n_errors, errors) - per row, the first failing rule of each field."""
    return df.select(F.col(pos_col), error_messages(df, contract).alias("_m")).select(
        pos_col, F.size("_m").cast("long").alias("n_errors"), F.concat_ws("; ", "_m").alias("errors"))
