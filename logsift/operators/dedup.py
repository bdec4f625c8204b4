"""Duplicate detection keeping the first occurrence.

"First" is the smallest ingest position.  Keys travel as a digest of fixed size, whatever the key columns hold, and
the input is read once and joined to nothing.  A key that holds a third of all rows is spread: kept rows come from
an aggregate with partial aggregation, flags from two windows, the first over salted parts of a key, the
second over the first rows of the parts together.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.functions.time import floor_time

#: Parts over which the rows of a key are dealt.
PARTS = 64


def digest(cols: Sequence[tuple[Column, T.DataType]]) -> Column:
    """SHA-256 (32 bytes) of some values; equal for equal values only, null being a value of its own."""
    def text(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(F.struct(c.alias("v")))
        if isinstance(kind, T.BinaryType):
            return F.hex(c)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = c + F.lit(0.0).cast(kind)  # -0.0 equals 0.0
        return c.cast("string")

    parts = [F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in (text(c, k) for c, k in cols)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _key(df: DataFrame, keys: Sequence[str], ts_col: str, seconds: int) -> Column:
    """Digest of the keys, the time floored to ``seconds``; nulls in keys are equal."""
    return digest([(floor_time(F.col(k), seconds) if k == ts_col else F.col(k), df.schema[k].dataType) for k in keys])


def flag_duplicates(df: DataFrame, keys: Sequence[str], pos_col: str, ts_col: str = "timestamp",
                    seconds: int = 1, flag: str = "is_duplicate") -> DataFrame:
    """Add ``flag``: true for every row but the first of its key group.

    Timestamps are floored to ``seconds``-wide buckets, so 0.9 s and 1.1 s are
    not duplicates.  If a key column is missing, no row is flagged.
    """
    if not keys or not all(k in df.columns for k in keys):
        return df.withColumn(flag, F.lit(False))
    rows = df.withColumn("_key", _key(df, keys, ts_col, seconds)).withColumn("_part", F.pmod(F.xxhash64(pos_col), F.lit(PARTS)))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_key", "_part").orderBy(pos_col)))
    # the first rows of a key's parts, at most PARTS, meet under the key itself; all others stay in their part
    rows = rows.withColumn("_part", F.when(F.col("_nth") > 1, F.col("_part")).otherwise(-1))
    first = F.row_number().over(Window.partitionBy("_key", "_part").orderBy(pos_col))
    return rows.withColumn(flag, (F.col("_nth") > 1) | (first > 1)).drop("_key", "_part", "_nth")


def drop_duplicates(df: DataFrame, keys: Sequence[str], pos_col: str, ts_col: str = "timestamp",
                    seconds: int = 1) -> DataFrame:
    """Keep the first row of every key group."""
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = F.min_by(row, F.struct(F.col(pos_col).isNull(), pos_col)).alias("_row")
    return df.groupBy(_key(df, keys, ts_col, seconds).alias("_key")).agg(first).select("_row.*")


def flag_row_duplicates(df: DataFrame, pos_col: str, cols: Sequence[str] | None = None,
                        flag: str = "is_duplicate") -> DataFrame:
    """Exact-row duplicates over ``cols`` (default all but the position)."""
    cols = list(cols or [c for c in df.columns if c != pos_col])
    return flag_duplicates(df, cols, pos_col, ts_col="\0none", flag=flag)
