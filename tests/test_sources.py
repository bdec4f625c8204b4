"""Sources and sinks: JSON documents, typed empty tables, reports, text logs."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.functions import rules as R
from logsift.operators.report import quality_report
from logsift.sources import io as IO

from fixtures import logs_small

ANOM = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("server_id", T.StringType()),
                     T.StructField("severity", T.StringType())])


def _write(d, name, obj):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        json.dump(obj, f)
    return p


def test_read_records_shapes(spark):
    d = tempfile.mkdtemp(prefix="logsift-json-")
    rec = {"timestamp": "2024-01-01T00:00:00Z", "server_id": "server-01", "severity": "high"}
    arr = _write(d, "arr.json", [rec, rec])
    wrapped = _write(d, "wrapped.json", {"anomalies": [rec, rec, rec]})
    one = _write(d, "one.json", rec)
    assert IO.read_records(spark, arr, schema=ANOM).count() == 2
    assert IO.read_records(spark, wrapped, "anomalies", ANOM).count() == 3
    got = IO.read_records(spark, one, schema=ANOM).collect()
    assert len(got) == 1 and got[0]["server_id"] == "server-01"


def test_read_or_empty(spark):
    df = IO.read_or_empty(spark, "/nonexistent/logsift/status.parquet", ANOM)
    assert df.count() == 0 and df.schema == ANOM


def test_unsupported_suffix(spark):
    with pytest.raises(ValueError):
        IO.read_table(spark, "/tmp/file.xlsx")


def test_nan_becomes_null(spark):
    d = tempfile.mkdtemp(prefix="logsift-nan-")
    p = os.path.join(d, "t.parquet")
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(p)
    assert IO.read_table(spark, p).where(F.col("x").isNull()).count() == 1


def test_report_and_text_sinks(spark):
    d = tempfile.mkdtemp(prefix="logsift-sink-")
    df = logs_small(spark)
    rep = quality_report(df, "logs")
    IO.write_report(rep, os.path.join(d, "report"))
    back = spark.read.json(os.path.join(d, "report"))
    assert {r["section"] for r in back.collect()} == {"missing", "duplicates", "numeric", "text", "types"}
    txt = R.render_log_text(F.col("timestamp"), "log_level", F.lit("server-01"), "pod_name", "namespace",
                            "node_name", "container_name", "cpu_usage_percent",
                            F.col("memory_usage_mb").cast("long"), "network_bytes", "is_anomaly", "anomaly_type",
                            F.lit("unknown"), F.lit("unknown"), "message")
    IO.write_log_text(df, txt, os.path.join(d, "logs.txt"))
    lines = spark.read.text(os.path.join(d, "logs.txt")).count()
    assert lines == 3 * 5


def test_max_rows_per_file(spark):
    d = tempfile.mkdtemp(prefix="logsift-chunk-")
    p = os.path.join(d, "t.parquet")
    IO.write_table(spark.range(0, 50000).toDF("id").repartition(1), p, max_rows_per_file=20000)
    files = [f for f in os.listdir(p) if f.endswith(".parquet")]
    assert len(files) == 3


def test_plan_time_helpers(spark):
    df = spark.createDataFrame([(1, None, "x")], "a long, b string, bytes_rate string")
    assert R.drop_null(df, ["b", "absent"]).count() == 0
    assert R.with_default(df, "anomaly_count", 0).first()["anomaly_count"] == 0
    assert R.with_default(df, "a", 9).first()["a"] == 1
    assert R.rename_if_present(df, {"bytes_rate": "flow_bytes_per_second", "nope": "x"}).columns[-1] == \
        "flow_bytes_per_second"
    assert R.select_available(df, ["b", "zz", "a"]).columns == ["b", "a"]
    s = spark.createDataFrame([("12.5",), ("abc",), (None,)], "v string")
    assert [r[0] for r in s.select(R.nonconforming("v", "float")).collect()] == [False, True, False]
    assert R.filter_eq(df, "a", "All").count() == 1 and R.filter_eq(df, "a", 2).count() == 0


def test_shapes_are_found_without_a_hint(spark):
    d = tempfile.mkdtemp(prefix="logsift-shapes-")
    rec = {"timestamp": "t", "server_id": "s", "severity": "high"}
    for name, doc, n in (("anomalies.json", {"anomalies": [rec] * 3}, 3), ("alerts.json", {"alerts": [rec] * 2}, 2),
                         ("none.json", {"alerts": []}, 0), ("array.json", [rec] * 4, 4), ("object.json", rec, 1)):
        got = IO.read_or_empty(spark, _write(d, name, doc), ANOM).collect()
        assert len(got) == n and all(tuple(r) == ("t", "s", "high") for r in got), name
    with open(os.path.join(d, "bad.json"), "w") as f:
        f.write("{broken")
    with pytest.raises(Exception):
        IO.read_or_empty(spark, os.path.join(d, "bad.json"), ANOM).collect()


def test_absent_parquet_is_no_csv(spark):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        IO.read_table(spark, "/nonexistent/logsift/t.parquet")
