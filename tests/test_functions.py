"""Column expressions: text, time, predicates (FIXTURES F-3)."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from logsift.functions import rules as R
from logsift.functions import text as TX
from logsift.functions import time as TM


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", [
    ("  Hello   World  \n\t", "Hello World"),
    ("a\rb", "ab"),
    ("a\u00a0b", "a b"),
    ("\ufb01x", "fix"),
    ("a\u200bb", "ab"),
    (None, None),
])
def test_standardise_text_fixtures(spark, raw, expected):
    assert _one(spark, TX.standardise_text, raw) == expected


def test_truncate_to_max_length(spark):
    out = _one(spark, lambda c: TX.standardise_text(c, max_length=100), "A" * 20000)
    assert len(out) == 100


def _py_standardise(t, n=None):
    if t is None:
        return None
    t = unicodedata.normalize("NFKD", t)
    t = "".join(ch for ch in t if unicodedata.category(ch)[0] != "C" or ch in "\n\t")
    t = " ".join(t.split())
    return t[:n].strip()


def test_standardise_matches_python_on_unicode_corpus(spark):
    corpus = ["x\u00a0y", "e\u0301te\u0301", "tab\there", "nl\nhere", "\u0085a\u001cb", " \u3000lead",
              "\u2028sep", "mix \u00bd \u2460", "\u200e\u200fmarks", "\u00e9", "trail \u2009 "]
    df = spark.createDataFrame([(t,) for t in corpus], "x string")
    got = [r[0] for r in df.select(TX.standardise_text("x")).collect()]
    assert got == [_py_standardise(t) for t in corpus]


def test_preview_and_first_present(spark):
    assert _one(spark, lambda c: TX.preview(c, 5), "abcdefgh") == "abcde..."
    assert _one(spark, lambda c: TX.preview(c, 5), "abc") == "abc"
    df = spark.createDataFrame([(None, "d")], "message string, description string")
    assert df.select(TX.first_present("message", "description", default="No message")).first()[0] == "d"


@pytest.mark.parametrize("raw", ["2024-01-01T12:00:00", "2024-01-01 12:00:00", "2024-01-01T12:00:00Z",
                                 "2024-01-01T14:00:00+02:00", "2024-01-01T14:00:00+0200",
                                 "2024-01-01T12:00:00.000000", "2024-01-01 12:00:00.000000",
                                 "2024-01-01T12:00:00.000000Z", "2024-01-01T14:00:00.000000+02:00"])
def test_parse_formats_to_iso_utc(spark, raw):
    assert _one(spark, lambda c: TM.iso_utc(TM.parse_ts(c)), raw) == "2024-01-01T12:00:00.000000Z"


def test_unparseable_is_null(spark):
    assert _one(spark, TM.parse_ts, "not a time") is None
    assert _one(spark, TM.display_ts, "not a time") == "not a time"
    assert _one(spark, TM.display_ts, "2024-01-01T12:00:00.5Z") == "2024-01-01 12:00:00"


def test_floor_time_buckets(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.9",), ("2024-01-01 00:00:01.1",),
                                ("2024-01-01 00:00:01.9",), ("1969-12-31 23:59:59.5",)], "s string")
    out = [r[0] for r in df.select(TM.floor_time(F.col("s").cast("timestamp"), 1).cast("string")).collect()]
    assert out[0] != out[1] and out[1] == out[2]
    assert out[3] == "1969-12-31 23:59:59"
    out5 = [r[0] for r in df.select(TM.floor_time(F.col("s").cast("timestamp"), 5).cast("string")).collect()]
    assert out5[3] == "1969-12-31 23:59:55"


def test_span_days_counts_whole_periods(spark):
    df = spark.createDataFrame([("2024-01-01 23:00:00", "2024-01-02 01:00:00"),
                                ("2024-01-01 00:00:00", "2024-01-03 00:00:00")], "a string, b string")
    out = [r[0] for r in df.select(TM.span_days(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))).collect()]
    assert out == [0, 2]


@pytest.mark.parametrize("name,ok", [("test-pod-123", True), ("test.pod.123", True), ("Test-Pod-123", False),
                                     ("", False), (None, False)])
def test_pod_name(spark, name, ok):
    assert _one(spark, R.is_pod_name, name) is ok


@pytest.mark.parametrize("name,ok", [("default", True), ("production", True), ("Test-Namespace", False),
                                     ("", False), (None, False)])
def test_namespace(spark, name, ok):
    assert _one(spark, R.is_namespace, name) is ok


@pytest.mark.parametrize("n,cpu,mem,status", [
    (581, 0, 0, "critical"), (0, 0.81, 0, "critical"), (0, 0, 150001, "critical"), (551, 0, 0, "warning"),
    (0, 0.61, 0, "warning"), (550, 0.1, 1, "warning"), (0, 0.6, 0, "warning"), (549, 0.59, 99999, "healthy")])
def test_status_rule(spark, n, cpu, mem, status):
    df = spark.createDataFrame([(n, float(cpu), float(mem))], "n long, cpu double, mem double")
    assert df.select(R.classify_status("n", "cpu", "mem")).first()[0] == status


def test_severity_rank_and_pct(spark):
    df = spark.createDataFrame([("critical",), ("warning",), ("info",), ("weird",)], "s string")
    assert [r[0] for r in df.select(R.severity_rank("s")).collect()] == [4, 0, 0, 0]
    z = spark.createDataFrame([(1, 0)], "n long, d long")
    assert z.select(R.pct("n", "d")).first()[0] == 0.0


def test_nfkd_ascii_fast_path_and_unicode(spark):
    df = spark.createDataFrame([("plain",), ("ﬁ",), (None,)], "x string")
    assert [r[0] for r in df.select(TX.nfkd("x")).collect()] == ["plain", "fi", None]
