"""Sources and sinks."""

from __future__ import annotations

import os
from typing import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is the missing marker in the reference: make it NULL at ingest."""
    fixes = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
             for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fixes) if fixes else df


def _no_parquet(e: Exception) -> bool:
    """Whether a read failed because the file is no Parquet file."""
    return any(x in str(e) for x in ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA"))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               nan_as_null: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """Parquet or CSV by suffix; a file that is no Parquet is read as CSV; other suffix -> error (A1, A2).

    With a schema and ``corrupt_col``, that column holds the text of CSV lines
    that do not fit the schema (null for the others)."""
    lower = path.rstrip("/").lower()
    if lower.endswith(".parquet"):
        try:
            df = spark.read.parquet(path)  # reads the footers, so a bad file shows here
            if schema is not None:
                df = spark.read.schema(schema).parquet(path)
        except (PySparkException, Py4JJavaError) as e:
            if not _no_parquet(e):
                raise
            df = _read_csv(spark, path, schema, corrupt_col)
    elif lower.endswith(".csv"):
        df = _read_csv(spark, path, schema, corrupt_col)
    else:
        raise ValueError(f"Unsupported file format: {os.path.splitext(lower)[1] or lower}")
    return nan_to_null(df) if nan_as_null else df


def _read_csv(spark: SparkSession, path: str, schema: T.StructType | None, corrupt_col: str | None = None) -> DataFrame:
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None and corrupt_col:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


#: Fields that may wrap a document's list of records.
WRAPPERS = ("anomalies", "alerts")


def read_records(spark: SparkSession, path: str, list_field: str | None = None,
                 schema: T.StructType | None = None, lines: bool = False) -> DataFrame:
    """JSON documents -> rows (A3): an array, an object that wraps a list (``list_field``,
    else one of ``WRAPPERS``) or a single object; one document per file, or per line with ``lines``.

    With a schema, shapes may be mixed and text that is no JSON is an error."""
    r = spark.read.option("multiLine", not lines)
    names = [list_field] if list_field else list(WRAPPERS)
    if schema is None:
        df = r.json(path)
        found = [w for w in names if w in df.columns and isinstance(df.schema[w].dataType, T.ArrayType)]
        return df.select(F.explode(found[0]).alias("_r")).select("_r.*") if found else df
    names = [w for w in names if w not in schema.names]
    df = (r.option("mode", "FAILFAST")
          .schema(T.StructType([*schema.fields, *[T.StructField(w, T.ArrayType(schema)) for w in names]])).json(path))
    single = F.array(F.struct(*[F.col(c) for c in schema.names]))
    return df.select(F.explode(F.coalesce(*[F.col(w) for w in names], single)).alias("_r")).select("_r.*")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed empty table when the result does not exist yet (A4); any other failure is raised."""
    try:
        if path.endswith(".json"):
            return read_records(spark, path, schema=schema)
        return read_table(spark, path, schema=schema)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, also_csv: bool = False, max_rows_per_file: int | None = None,
                partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet sink, optional CSV mirror and row cap per file."""
    w = df.write.mode(mode)
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", int(max_rows_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if also_csv:
        # mirror from the written Parquet, so the lineage is not recomputed
        src = df.sparkSession.read.parquet(path)
        cw = src.write.mode(mode).option("header", True)
        if max_rows_per_file:
            cw = cw.option("maxRecordsPerFile", int(max_rows_per_file))
        cw.csv(path.rstrip("/") + "_csv")


def write_report(metrics: DataFrame, path: str, group_col: str = "section") -> None:
    """Long metrics (section, column, metric, value, text) -> one nested JSON doc per dataset and section.

    One row per column and metric, so a document and the single output file stay small."""
    keys = [c for c in ("dataset", group_col) if c in metrics.columns]
    nested = (metrics.groupBy(*dict.fromkeys(keys))
              .agg(F.map_from_entries(F.collect_list(F.struct(
                  F.concat_ws(".", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("column", "metric")]),
                  F.coalesce(F.col("value").cast("string"), F.col("text"))))).alias("metrics")))
    nested.coalesce(1).write.mode("overwrite").json(path)


# --- Kafka-shaped frames (A9, A10, A12, A13) ---------------------------------

def record_json(cols: Sequence[str], ignore_null_fields: bool = False) -> Column:
    """JSON object text of the given columns; nulls kept by default."""
    opts = {"ignoreNullFields": "true" if ignore_null_fields else "false"}
    return F.to_json(F.struct(*cols), opts)


def to_kafka_frame(df: DataFrame, key: str, ignore_null_fields: bool = False,
                   exclude_key: bool = False) -> DataFrame:
    """(key, value) with the record as a JSON object."""
    cols = [c for c in df.columns if not (exclude_key and c == key)]
    return df.select(F.col(key).cast("string").alias("key"), record_json(cols, ignore_null_fields).alias("value"))


def from_kafka_frame(df: DataFrame, schema: T.StructType | str, keep_corrupt: bool = True) -> DataFrame:
    """Decode ``value`` JSON; rows that do not parse keep ``_corrupt_record`` (A10)."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType(), True)])
    parsed = F.from_json(F.col("value").cast("string"), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    extra = [c for c in df.columns if c in ("key", "topic", "partition", "offset", "timestamp")]
    out = df.select(*[F.col(c).alias(f"kafka_{c}") for c in extra], parsed.alias("_r")).select(
        *[f"kafka_{c}" for c in extra], "_r.*")
    return out if keep_corrupt else out.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def offset_stats(frame: DataFrame) -> DataFrame:
    """Per (topic, partition): first offset, end offset, messages by offsets,
    rows actually present; plus a per-topic total row with partition null (A12)."""
    per = (frame.groupBy("topic", "partition")
           .agg(F.min("offset").alias("first_offset"),
                (F.max("offset") + 1).alias("end_offset"),
                F.count(F.lit(1)).alias("rows")))
    per = per.withColumn("messages", F.col("end_offset") - F.col("first_offset"))
    total = (per.groupBy("topic").agg(F.lit(None).cast(per.schema["partition"].dataType).alias("partition"),
                                      F.min("first_offset").alias("first_offset"),
                                      F.max("end_offset").alias("end_offset"),
                                      F.sum("rows").alias("rows"),
                                      F.sum("messages").alias("messages")))
    return per.unionByName(total)


def sample_messages(frame: DataFrame, n: int = 10) -> DataFrame:
    """First n messages by (partition, offset) (A13); the limit is the feature."""
    return frame.orderBy("partition", "offset").limit(n)


def last_message(frame: DataFrame) -> DataFrame:
    """Last message read per partition (A13), via max_by, no sort."""
    others = [c for c in frame.columns if c not in ("topic", "partition")]
    return (frame.groupBy("topic", "partition")
            .agg(F.max_by(F.struct(*others), F.col("offset")).alias("_m")).select("topic", "partition", "_m.*"))


def write_log_text(df: DataFrame, text_col: Column, path: str) -> None:
    """Text log sink, one block per record (A11).  The text writer ends every
    row with a newline, so the block's own final newline is dropped: the file
    is the plain concatenation of the blocks."""
    df.select(F.regexp_replace(text_col, "\n$", "").alias("value")).write.mode("overwrite").text(path)
