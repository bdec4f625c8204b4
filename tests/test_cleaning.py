"""Cleaning steps and pipeline on the F-1 fixture and its variants."""

import os
import tempfile

from pyspark.sql import functions as F

from logsift.contracts import HYBRID, K8S_LOG
from logsift.operators import clean as C
from logsift.operators import dedup as D
from logsift.operators import stats as S
from logsift.operators import validate as V
from logsift.sources import io as IO

from conftest import SF001
from fixtures import LOGS_SMALL, logs_small


def test_missing_variant(spark):
    rows = [list(r) for r in LOGS_SMALL]
    rows[0][2] = None      # message (critical): 33 % > 5 % -> dropped
    rows[1][8] = None      # cpu (non-nullable) -> dropped
    df = logs_small(spark, [tuple(r) for r in rows])
    plan = C.plan_missing(df, K8S_LOG)
    out = C.apply_missing(df, plan)
    assert out.count() == 1
    assert [(r[2], r[3]) for r in plan.log] == [("message", "removed_rows"), ("cpu_usage_percent", "removed_rows")]


def test_median_and_mode_fill_on_alive_rows(spark):
    df = spark.createDataFrame([(1.0, "a", 0, "x"), (None, None, 1, "x"), (3.0, "b", 0, "x"), (5.0, "b", 1, "x")],
                               "cpu_usage double, anomaly_type string, label long, memory_usage_s string")
    plan = C.plan_missing(df.withColumnRenamed("memory_usage_s", "other"), HYBRID, critical=())
    assert plan.fills == {"cpu_usage": 3.0}
    assert plan.log[-1][3] == "removed_rows"  # anomaly_type is not nullable in the hybrid contract


def test_duplicate_variant(spark):
    df = logs_small(spark, LOGS_SMALL + [LOGS_SMALL[0]])
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = D.drop_duplicates(df, ["timestamp", "pod_name", "message"], "log_id")
    assert out.count() == 3


def test_duplicate_flags_keep_first(spark):
    df = spark.createDataFrame([(0, "2024-01-01 12:00:00", "pod-1", "msg1"), (1, "2024-01-01 12:00:00", "pod-1", "msg1"),
                                (2, "2024-01-01 12:01:00", "pod-2", "msg2")], "log_id long, ts string, pod string, m string")
    df = df.withColumn("timestamp", F.col("ts").cast("timestamp"))
    flags = D.flag_duplicates(df, ["timestamp", "pod", "m"], "log_id").orderBy("log_id")
    assert [r["is_duplicate"] for r in flags.collect()] == [False, True, False]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0, "2024-01-01 00:00:00.9"), (1, "2024-01-01 00:00:01.1"),
                                (2, "2024-01-01 00:00:01.1"), (3, "2024-01-01 00:00:01.9")], "log_id long, ts string")
    df = df.withColumn("timestamp", F.col("ts").cast("timestamp")).withColumn("k", F.lit("a"))
    a = D.flag_duplicates(df.where("log_id in (0, 1)"), ["timestamp", "k"], "log_id").orderBy("log_id").collect()
    b = D.flag_duplicates(df.where("log_id in (2, 3)"), ["timestamp", "k"], "log_id").orderBy("log_id").collect()
    assert [r["is_duplicate"] for r in a] == [False, False]
    assert [r["is_duplicate"] for r in b] == [False, True]


def test_missing_key_column_flags_nothing(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a")], "log_id long, k string")
    assert D.flag_duplicates(df, ["k", "absent"], "log_id").where("is_duplicate").count() == 0


def test_text_variant(spark):
    rows = [list(r) for r in LOGS_SMALL]
    rows[0][2] = "  Pod   started  \n\t"
    r = C.clean(logs_small(spark, [tuple(x) for x in rows]), "log_id", K8S_LOG)
    msgs = {x["message"] for x in r.data.collect()}
    assert "Pod started" in msgs


def test_long_messages_stay_whole_and_apart(spark):
    rows = [list(LOGS_SMALL[0]) for _ in range(2)]
    rows[0][2], rows[1][2] = "x" * 12000 + " one", "x" * 12000 + " two"
    df = logs_small(spark, [tuple(x) for x in rows])
    r = C.clean(df, "log_id", K8S_LOG)
    assert {x["message"] for x in r.data.collect()} == {rows[0][2], rows[1][2]}
    # the cut is an option, and counted
    r = C.clean(df, "log_id", K8S_LOG, max_length=10000)
    assert [x["message"] for x in r.data.collect()] == ["x" * 10000]
    assert {x["metric"]: x["value"] for x in r.summary.collect()}["text_cut"] == 2


def test_time_formats(spark):
    rows = [list(r) for r in LOGS_SMALL[:2]]
    rows[0][0] = "2024-01-01T12:00:00"
    rows[1][0] = "2024-01-01 12:00:00"
    rows[1][2] = "other"
    r = C.clean(logs_small(spark, [tuple(x) for x in rows]), "log_id", K8S_LOG)
    iso = {x[0] for x in r.data.select(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).collect()}
    assert iso == {"2024-01-01T12:00:00.000000Z"}


def test_invalid_values(spark):
    rows = [list(r) for r in LOGS_SMALL]
    rows[0][1] = "INVALID"
    rows[0][8] = 150.0
    errs = V.validate(logs_small(spark, [tuple(x) for x in rows]), K8S_LOG, pos_col="log_id").collect()
    assert {(e["field"], e["rule"], e["invalid_count"]) for e in errs} == {
        ("log_level", "allowed_values", 1), ("cpu_usage_percent", "above_max", 1)}
    msg = [e["message"] for e in errs if e["rule"] == "allowed_values"][0]
    assert msg == "Field 'log_level': 1 rows have invalid values. Sample: ['INVALID']"


def test_absent_columns(spark):
    df = spark.createDataFrame([("2024-01-01T12:00:00", "INFO", "pod-1")], "timestamp string, log_level string, pod_name string")
    df = df.withColumn("log_id", F.lit(0).cast("long"))
    plan = C.plan_missing(df, K8S_LOG)
    assert C.apply_missing(df, plan).count() == 1
    errs = V.validate(df, K8S_LOG).where(F.col("rule") == "missing_column").select("field").collect()
    assert "message" in {e[0] for e in errs}


def test_ordering(spark):
    df = spark.createDataFrame([("12:00", "msg1"), ("10:00", "msg2"), ("11:00", "msg3")], "t string, m string")
    df = df.withColumn("timestamp", F.concat(F.lit("2024-01-01 "), "t").cast("timestamp")) \
           .withColumn("log_id", F.monotonically_increasing_id())
    assert [r["m"] for r in C.order_by_time(df, "timestamp", "log_id").collect()] == ["msg2", "msg3", "msg1"]


def test_full_pipeline_csv_to_parquet(spark):
    d = tempfile.mkdtemp(prefix="logsift-test-")
    src = os.path.join(d, "logs.csv")
    spark.createDataFrame(LOGS_SMALL, "timestamp string, log_level string, message string, pod_name string, "
                          "namespace string, container_name string, node_name string, service string, "
                          "cpu_usage_percent double, memory_usage_mb double, network_bytes long, is_anomaly long, "
                          "anomaly_type string").coalesce(1).write.option("header", True).csv(src)
    df = IO.read_table(spark, src).withColumn("log_id", F.monotonically_increasing_id())
    r = C.clean(df, "log_id", K8S_LOG)
    out = os.path.join(d, "clean.parquet")
    IO.write_table(r.data, out, also_csv=True)
    back = spark.read.parquet(out)
    assert back.count() == 3
    assert [x["message"] for x in back.collect()] == ["Pod crashed", "High CPU usage", "Pod started"]
    summary = {x["metric"]: x["value"] for x in r.summary.collect()}
    assert summary["initial_rows"] == summary["final_rows"] + summary["rows_removed"]


def test_missing_stats_fixture(spark):
    df = spark.createDataFrame([(1.0, "a", 1), (2.0, "b", 2), (None, "c", 3), (4.0, None, 4)],
                               "col1 double, col2 string, col3 long")
    m = {r["column"]: r["missing_count"] for r in S.missing_stats(df).collect()}
    assert m == {"col1": 1, "col2": 1, "col3": 0}
    assert S.missing_overall(df).first()["overall_missing_pct"] == 16.67


def test_metrics_fixture(spark):
    df = spark.createDataFrame([(float(i), t) for i, t in zip(range(1, 6), "abcde")], "numeric double, text string")
    n = S.numeric_profile(df, ["numeric"]).first()
    assert (n["mean"], n["median"], n["q25"], n["q75"], n["outliers_iqr"]) == (3.0, 3.0, 2.0, 4.0, 0)
    t = S.text_profile(df, ["text"]).first()
    assert (t["unique_count"], t["most_frequent"], t["avg_length"], t["max_length"]) == (5, "a", 1.0, 1)


def test_sequential_fallback_equals_histogram(spark, monkeypatch):
    from logsift.plans.views import logs
    from conftest import SF0001
    lg = logs(spark, SF0001)
    a = C.plan_missing(lg, K8S_LOG)
    monkeypatch.setattr(C, "MAX_PATTERN_FIELDS", 1)
    b = C.plan_missing(lg, K8S_LOG)
    assert [r[2:4] + r[5:] for r in a.log] == [r[2:4] + r[5:] for r in b.log]
    assert (a.rows_in, a.rows_out) == (b.rows_in, b.rows_out)
    assert C.apply_missing(lg, a).count() == C.apply_missing(lg, b).count()


def test_profiles_of_odd_columns(spark):
    schema = "a string, b double, c array<int>, d string"
    df = spark.createDataFrame([("x" * 70 + "b", 0.0, [1], None), ("x" * 70 + "a", -0.0, [1], None), ("y", float("nan"), None, None), (None, None, None, None)], schema)
    got = {r["column"]: tuple(r)[1:] for r in S.column_profile(df.drop("c")).collect()}
    assert got["a"][1:5] == (3, 1, 25.0, 3) and got["b"][1:5] == (3, 1, 25.0, 2) and got["d"][1:] == (0, 4, 100.0, 0, None, None, None)
    assert {r["column"]: r["distinct"] for r in S.distinct_counts(df).collect()} == {"a": 3, "b": 2, "c": 1, "d": 0}
    assert {r["column"]: r["most_frequent"] for r in S.text_profile(df, ["a", "d"]).collect()} == {"a": "x" * 70 + "a"}
    assert {r["column"]: r["distinct"] for r in S.distinct_counts(df.limit(0)).collect()} == dict.fromkeys("abcd", 0)
    assert S.text_profile(df.limit(0), ["a"]).count() == 0
    assert tuple(S.duplicate_rows(df.drop("a")).first())[:2] == (4, 1)


def test_a_hot_key_is_flagged_once(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), F.lit(None).cast("string").alias("z")).repartition(7)
    out = D.flag_duplicates(df, ["k", "z"], "id")
    assert sorted(r["id"] for r in out.where("not is_duplicate").collect()) == sorted([1, *range(0, 5000, 3)])
    assert out.count() == 5000 and out.columns == ["id", "k", "z", "is_duplicate"]
    assert sorted(r["id"] for r in D.drop_duplicates(df, ["k"], "id").collect()) == sorted([1, *range(0, 5000, 3)])


def test_length_prefixed_digests_tell_values_apart(spark):
    df = spark.createDataFrame([(1, "a", "b1:c"), (2, "a1:b", "c"), (3, None, "a"), (4, "a", None), (5, "", "a"), (6, None, "a")], "id long, x string, y string")
    assert [r["id"] for r in D.flag_row_duplicates(df, "id").where("is_duplicate").collect()] == [6]


def test_cleaning_takes_few_jobs(spark):
    sc = spark.sparkContext
    sc.setJobGroup("clean-jobs", "")
    df = spark.read.parquet(f"{SF001}/events.parquet").select(F.col("event_id").alias("log_id"), F.col("ts").alias("timestamp"), F.col("props").alias("message"),
                                                             F.col("value").alias("cpu_usage_percent"))
    r = C.clean(df, "log_id", K8S_LOG)
    r.summary.collect()
    n = len(sc.statusTracker().getJobIdsForGroup("clean-jobs"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert n <= 20 and "errors" not in vars(r)  # nothing is validated before the errors are asked for


def test_hot_and_null_join_keys_are_split(spark):
    from logsift.operators import label as L
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.lit("l").alias("v"))
    right = spark.createDataFrame([(None, "n1"), (None, "n2"), ("hot", "h"), ("2", "two")], "k string, v string")
    plain = L.join_metrics(left, right, ["k"])
    split = L.join_metrics(left, right, ["k"], hot_rows=100)
    assert split.columns == plain.columns == ["id", "k", "v_x", "v_y"]
    rows = lambda d: sorted(map(str, map(tuple, d.collect())))
    assert rows(split) == rows(plain) and len(rows(split)) == 2000 + 1000 + 1
    a, b = L.split_hot_keys(left, right, ["k"], 100)
    assert a.groupBy("k", "_part").count().agg(F.max("count")).first()[0] <= 200 and b.where("k is null").count() == 2 * 10
    assert rows(L.join_metrics(left, right, ["k"], how="left", hot_rows=100)) == rows(L.join_metrics(left, right, ["k"], how="left"))


def test_split_keys_repeat_no_more_rows_than_the_left_side_has(spark):
    from logsift.operators import label as L
    left = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    right = spark.range(600).select(F.col("id").alias("r"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    a, b = L.split_hot_keys(left, right, ["k"], 10)  # 1,500 and 300 rows without a key: 5 parts of 300, not 150 of 10
    assert b.where("k is null").count() == 300 * 5 and b.where("k is not null").count() == 300
    assert a.count() == 3000 and a.where("k is null").select("_part").distinct().count() == 5
    got = L.join_metrics(left, right, ["k"], hot_rows=10)
    assert got.count() == 1500 * 300 + 300 == got.select("id", "r").distinct().count()


def test_split_keys_get_tasks_by_their_pairs(spark, monkeypatch):
    from logsift.operators import label as L
    left = spark.range(800).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 8).alias("k"), F.lit("l").alias("v"))
    right = spark.range(240).select(F.when(F.col("id") % 4 != 0, F.col("id") % 8).alias("k"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("r"), F.lit("r").alias("v"))
    right = right.where("k is null or k <> 2")  # a hot key that the right side has not
    rows = lambda d: sorted(map(str, map(tuple, d.collect())))
    monkeypatch.setattr(L, "TASK_PAIRS", 1000)
    for how, null_safe in (("inner", True), ("left", False)):
        plain = L.join_metrics(left, right, ["k"], how=how, null_safe=null_safe)
        split = L.join_metrics(left, right, ["k"], how=how, null_safe=null_safe, hot_rows=50)
        assert split.columns == plain.columns == ["id", "k", "v_x", "r", "v_y"] and rows(split) == rows(plain)
    a, b = L.split_hot_keys(left, right, ["k"], 50)
    assert a.where("k is null or k in (0, 2, 4, 6)").groupBy("_part").agg(F.count_distinct("k").alias("n"), F.count_if(F.col("k").isNull()).alias("o")).where("n + sign(o) > 1").isEmpty()
    tasks = L.join_metrics(left, right, ["k"], hot_rows=50).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 400 * 60 + 100 * 30 and max(r["count"] for r in tasks) < 24000 / 2
