"""Exact quantiles: fixture values, order of the keys, skewed data, plan."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from logsift.functions import outlier as O
from logsift.operators import clean as C
from logsift.operators import quantiles as Q
from logsift.operators.quantiles import quantile_values, with_order_key

from conftest import SF001


def _df(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def test_iqr_fixture(spark):
    df = _df(spark, list(range(1, 10)) + [100])
    q1, q3 = quantile_values(df, ["x"], [0.25, 0.75])["x"]
    assert (q1, q3) == (3.25, 7.75)
    flags = [r[0] for r in df.select(O.iqr_flag("x", F.lit(q1), F.lit(q3), 1.5, False)).collect()]
    assert flags == [False] * 9 + [True]
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (lo, hi) == (-3.5, 14.5)


def test_cap_fixture(spark):
    df = _df(spark, list(range(1, 10)) + [100])
    capped, log = C.cap_outliers(df, ["x"], k=3.0)
    vals = [r[0] for r in capped.collect()]
    assert max(vals) == 21.25 and min(vals) == 1.0 and log[0][1] == 1


def test_cap_in_table(spark):
    df = _df(spark, [10, 20, 30, 40, 50, 200])
    b = C.outlier_bounds(df, ["x"], 3.0)["x"]
    assert (b["q1"], b["q3"]) == (22.5, 47.5)
    capped, _ = C.cap_outliers(df, ["x"], k=3.0)
    assert max(r[0] for r in capped.collect()) == 122.5


def test_iqr_zero_guard(spark):
    df = _df(spark, [5, 5, 5, 5, 9])
    q1, q3 = quantile_values(df, ["x"], [0.25, 0.75])["x"]
    guarded = df.select(O.iqr_flag("x", F.lit(q1), F.lit(q3), 3.0, True)).collect()
    unguarded = df.select(O.iqr_flag("x", F.lit(q1), F.lit(q3), 3.0, False)).collect()
    assert sum(r[0] for r in guarded) == 0 and sum(r[0] for r in unguarded) == 1


def test_not_outliers_fixture(spark):
    """F-1 'not outliers': nothing is capped at k=3 (the reference test's own assertion disagrees)."""
    df = spark.createDataFrame([(150.0, 1024.0), (85.0, 200000.0), (95.0, 4096.0)], "cpu double, mem double")
    _, log = C.cap_outliers(df, ["cpu", "mem"], k=3.0)
    assert log == []


def percentiles(df, cols, ps):
    """Spark's own exact percentile."""
    row = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*[F.lit(p) for p in ps])).alias(c) for c in cols]).first()
    return {c: list(row[c]) for c in cols}


def test_hot_value_and_long_tail(spark):
    rnd = random.Random(7)
    vals = [rnd.random() * 1000 for _ in range(3000)] + [42.0] * 2000 + [1e9, -1e9, 1e-320, -1e-320, 0.0, -0.0, 1e307, -1e307]
    df = _df(spark, vals).withColumn("y", -F.col("x") * 3)
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    got, want = quantile_values(df, ["x", "y"], ps), percentiles(df, ["x", "y"], ps)
    for c in ("x", "y"):
        assert got[c] == pytest.approx(want[c], rel=1e-12, abs=1e-9)


def test_lineitem(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_orderkey"]
    got, want = quantile_values(li, cols, [0.1, 0.5, 0.9]), percentiles(li, cols, [0.1, 0.5, 0.9])
    for c in cols:
        assert got[c] == pytest.approx(want[c], rel=1e-12)


def test_no_values(spark):
    df = spark.createDataFrame([(None, float("nan"), 1.0), (None, None, None)], "x double, y double, z double")
    assert quantile_values(df, ["x", "y", "z"], [0.5]) == {"x": [None], "y": [None], "z": [1.0]}
    assert quantile_values(df.limit(0), ["x"], [0.5, 1.0]) == {"x": [None, None]}
    assert quantile_values(df, [], [0.5]) == {}


def test_many_rows_with_a_hot_value(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.pow(F.col("id") * 1.0001, 1.5)).alias("x"))
    ps = [0.0, 0.001, 0.1, 0.3333, 0.5, 0.9, 0.999, 1.0]
    assert quantile_values(df, ["x"], ps)["x"] == pytest.approx(percentiles(df, ["x"], ps)["x"], rel=1e-12, abs=1e-9)


def test_keys_keep_the_order_of_all_doubles(spark):
    rnd = random.Random(1)
    vals = [struct.unpack(">d", rnd.randbytes(8))[0] for _ in range(5000)]
    vals = [v for v in vals if v == v] + [s * 2.0 ** e for e in range(-1074, 1024) for s in (1, -1)]
    vals += [s * math.nextafter(2.0 ** e, to) for e in range(-1022, 1024, 7) for to in (0.0, math.inf) for s in (1, -1)] + [math.inf, -math.inf, 0.0]
    rows = with_order_key(spark.createDataFrame([(v,) for v in vals], "x double"), "x", "k").collect()
    for r in rows:
        bits = struct.unpack(">q", struct.pack(">d", abs(r["x"])))[0]
        assert r["k"] == (-bits if r["x"] < 0 else bits), r


def test_plan_joins_nothing_and_reads_at_most_four_times(spark, monkeypatch):
    plans = []

    def spy(df, *a):
        out = one_round(df, *a)
        plans.append(a[1])
        return out

    one_round = Q._round
    monkeypatch.setattr(Q, "_round", spy)
    df = spark.range(40000).select((F.col("id") * 1e-9 + 1).alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    assert quantile_values(df, ["x", "y"], [0.5]) == {"x": [1 + 19999.5e-9], "y": [2.0]}
    assert plans == list(range(len(plans))) and len(plans) <= 4
    for done, open_ in ((0, {}), (1, {0: [16368], 1: [16384]})):
        seen = []
        monkeypatch.setattr(type(df), "collect", lambda self: seen.append(self._jdf.queryExecution().executedPlan().toString()) or [])
        one_round(df, ["x", "y"], done, open_, lambda n: F.array(F.lit(1).cast("long")))
        monkeypatch.undo()
        assert "Join" not in seen[0] and "partial_count" in seen[0]


def test_value_at_rank(spark):
    df = _df(spark, [5, 1, 1, 3, 9, 7])
    assert [Q.value_at_rank(df, "x", r) for r in range(6)] == [1.0, 1.0, 3.0, 5.0, 7.0, 9.0]
    assert Q.value_at_rank(df, "x", 6) is None and Q.value_at_rank(df, "x", -1) is None


def test_sample_n_equals_md5_order(spark):
    from logsift.operators.label import sample_n
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey")
    got = sorted(r[0] for r in sample_n(orders, 1234, "o_orderkey").collect())
    exp = sorted(r[0] for r in orders.orderBy(F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit("-42"))))
                 .limit(1234).collect())
    assert got == exp
