"""Exact quantiles (linear interpolation, like pandas / DuckDB quantile_cont) by radix selection.

A double's 64-bit key keeps its order.  A round fixes 16 more bits of the key: one scan counts, for all
columns together, the values under each open prefix by their next 16 bits, in hash aggregates with
partial aggregation; the prefixes are literals, so nothing is joined.  The bucket that holds a
wanted rank is the next open prefix, unless all its values are equal, which settles the rank.  So
four scans are enough whatever the data, a value that holds a third of all rows is one bucket, and the
driver gets one row for each column and rank.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 16
#: Parts of a double: bits of the fraction, bias and least exponent of normal numbers.
FRACTION, BIAS, LEAST = 52, 1023, -1022


def with_order_key(rows: DataFrame, x: str, key: str) -> DataFrame:
    """``rows`` with a long that orders like the double ``x`` (its magnitude's bits, with its sign); null for null and NaN.

    In steps of one projection each, so that nothing is computed twice.  The row number, which is never below
    0, keeps filters on the key from being pushed into the steps: each would be copied into the next."""
    size = F.col("_size")
    exponent = F.floor(F.log2(F.least(size, F.lit(sys.float_info.max)))).cast("int")
    rows = rows.withColumn("_size", F.when(~F.isnan(x), F.abs(x)))
    rows = rows.withColumn("_e", F.least(F.greatest(exponent, F.lit(LEAST)), F.lit(BIAS)))
    rows = rows.withColumn("_m", size / F.pow(F.lit(2.0), "_e"))
    low, high = F.col("_m") < 1, F.col("_m") >= 2  # the logarithm may be off by one near a power of two
    part = F.when(low, F.col("_m") * 2).when(high, F.col("_m") / 2).otherwise(F.col("_m"))
    power = F.when(low, F.col("_e") - 1).when(high, F.col("_e") + 1).otherwise(F.col("_e"))
    normal = (power + BIAS).cast("long") * (1 << FRACTION) + (part * float(1 << FRACTION)).cast("long") - (1 << FRACTION)
    tiny = (size * 2.0 ** 537 * 2.0 ** 537).cast("long")
    bits = (F.when(size == float("inf"), F.lit((2 * BIAS + 1) << FRACTION).cast("long"))
            .when(size < 2.0 ** LEAST, tiny).otherwise(normal))
    rows = rows.withColumn("_bits", F.when(size.isNotNull(), bits))
    signed = F.when(F.col(x) < 0, -F.col("_bits")).otherwise(F.col("_bits"))
    return rows.withColumn(key, F.when(F.monotonically_increasing_id() >= 0, signed)).drop("_size", "_e", "_m", "_bits")


def _round(df: DataFrame, cols: list[str], done: int, open_: dict[int, list[int]], ranks: Callable[[Column], Column]) -> list:
    """One scan: per column and open prefix the buckets of the next bits that hold a wanted rank.

    ``open_``: prefixes by column; ``done``: rounds before; ``ranks``: the wanted ranks under a prefix."""
    shift = 64 - BITS * (done + 1)
    own = [F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols) if not done or i in open_]
    rows = with_order_key(df.select(F.inline(F.array(*own))).where(F.col("x").isNotNull()), "x", "k").where(F.col("k").isNotNull())
    if done:
        inside = F.lit(False)
        for i, prefixes in open_.items():
            inside = inside | ((F.col("c") == i) & F.shiftright("k", shift + BITS).isin(prefixes))
        rows = rows.where(inside)
    hist = (rows.groupBy("c", F.shiftright("k", shift).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    parent = F.shiftright("b", BITS) if done else F.lit(0)
    group = Window.partitionBy("c", "up")  # at most 2 ** BITS buckets
    hist = hist.withColumn("up", parent).withColumn("before", F.sum("n").over(group.orderBy("b")) - F.col("n"))
    hist = hist.withColumn("total", F.sum("n").over(group)).withColumn("rank", F.explode(ranks(F.col("total"))))
    return hist.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))).collect()


def select_ranks(df: DataFrame, cols: Sequence[str], ranks: Callable[[Column], Column]) -> tuple[dict[str, int], dict[tuple[str, int], float]]:
    """(number of values by column, value by column and 0-based rank); ``ranks``: array of wanted ranks of a number of values."""
    cols = list(cols)
    total: dict[str, int] = {}
    values: dict[tuple[str, int], float] = {}
    # (column, prefix) -> (values before it, wanted ranks)
    left: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for done in range(64 // BITS):
        if done and not left:
            break
        open_: dict[int, list[int]] = {}
        wanted = None
        for (c, up), (base, rs) in left.items():
            open_.setdefault(c, []).append(up)
            here, array = (F.col("c") == c) & (F.col("up") == up), F.array(*[F.lit(r - base).cast("long") for r in rs])
            wanted = F.when(here, array) if wanted is None else wanted.when(here, array)
        hits = _round(df, cols, done, open_, (lambda n: wanted) if done else ranks)
        before, left = left, {}
        for h in hits:
            base = before[(h["c"], h["up"])][0] if done else 0
            if not done:
                total[cols[h["c"]]] = h["total"]
            rank = h["rank"] + base
            if h["lo"] == h["hi"]:
                values[(cols[h["c"]], rank)] = h["lo"]
            else:
                left.setdefault((h["c"], h["b"]), (base + h["before"], []))[1].append(rank)
    return total, values


def quantile_values(df: DataFrame, cols: Sequence[str], ps: Sequence[float]) -> dict[str, list[float | None]]:
    """{column: [q(p) for p in ps]}; None for a column without values.  Nulls and NaN are no values."""
    cols, ps = list(cols), [float(p) for p in ps]
    if not cols or not ps:
        return {c: [] for c in cols}

    def ranks(n: Column) -> Column:
        places = [F.lit(p) * (n - 1) for p in ps]
        return F.array_distinct(F.array(*[f(x).cast("long") for x in places for f in (F.floor, F.ceil)]))

    total, values = select_ranks(df, cols, ranks)
    out: dict[str, list[float | None]] = {}
    for c in cols:
        out[c] = [None] * len(ps)
        for i, p in enumerate(ps if c in total else []):
            at = p * (total[c] - 1)
            a, b = values[(c, math.floor(at))], values[(c, math.ceil(at))]
            out[c][i] = a if a == b else a + (b - a) * (at - math.floor(at))
    return out


def quantile_long(df: DataFrame, cols: Sequence[str], ps: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """(column, <name per p>...) with one row per column."""
    names = list(names) if names else [f"p{int(round(p * 100)):02d}" for p in ps]
    vals = quantile_values(df, cols, ps)
    schema = T.StructType([T.StructField("column", T.StringType(), False)] +
                          [T.StructField(n, T.DoubleType(), True) for n in names])
    rows = [tuple([c] + [None if v is None else float(v) for v in vals[c]]) for c in cols]
    return df.sparkSession.createDataFrame(rows, schema)


def value_at_rank(df: DataFrame, col: str, rank: int) -> float | None:
    """Exact value of 0-based ``rank`` in ascending order of a numeric column (nulls ignored); None if out of range."""
    if rank < 0:
        return None
    _, values = select_ranks(df, [col], lambda n: F.array(F.lit(rank).cast("long")))
    return values.get((col, rank))
