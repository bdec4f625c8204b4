"""Registry, entry point, brute-force checks of queries without a SQL oracle."""

import unicodedata

from pyspark.sql import functions as F

import __spark_entry__ as E
from logsift.operators.positions import with_position
from logsift.plans.registry import QUERIES as REGISTERED

from conftest import SF0001, SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["server_id", "total_logs", "error_count", "warning_count", "last_update", "max_cpu",
                          "max_memory_mb", "anomaly_count", "status"]


def test_every_query_has_an_oracle_except_nfkd():
    missing = set(REGISTERED) - set(E.oracle_sql())
    assert missing == {"standardise_text", "nfkd_text"}


def _py_standardise(t, n=None):
    if t is None:
        return None
    t = unicodedata.normalize("NFKD", t)
    t = "".join(ch for ch in t if unicodedata.category(ch)[0] != "C" or ch in "\n\t")
    t = " ".join(t.split())
    return t[:n].strip()


def test_standardise_text_whole_documents_brute_force(spark):
    got = {r["doc_id"]: r["text_std"] for r in E.queries()["standardise_text"](spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d["doc_id"]] == _py_standardise(d["text"]), d["doc_id"]


def test_nfkd_whole_documents_brute_force(spark):
    got = {r["doc_id"]: r["text_nfkd"] for r in E.queries()["nfkd_text"](spark, SF001).collect()}
    for d in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect():
        assert got[d["doc_id"]] == (None if d["text"] is None else unicodedata.normalize("NFKD", d["text"]))


def test_positions_match_row_number(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_totalprice")
    p = with_position(df, [F.asc("o_totalprice"), F.asc("o_orderkey")], "pos", num_partitions=5)
    got = [r["o_orderkey"] for r in p.orderBy("pos").collect()]
    exp = [r["o_orderkey"] for r in df.orderBy("o_totalprice", "o_orderkey").collect()]
    assert got == exp
    assert [r["pos"] for r in p.orderBy("pos").collect()] == list(range(len(exp)))


def test_small_scale_queries_run(spark):
    qs = E.queries()
    for name in ("missing_stats", "clean_logs", "hourly_metrics", "system_labels", "audit_status"):
        assert qs[name](spark, SF0001).count() >= 0


def test_kpi_fallbacks(spark):
    from logsift.operators import dashboards as DB
    empty = spark.createDataFrame([], "server_id string, anomaly_count long")
    stats = spark.createDataFrame([(70, 5, 3)], "total_logs long, total_anomalies long, servers_monitored long")
    assert tuple(DB.kpis_or_estimates(empty, None, stats).first()) == (70, 5, 3, 0.0)
    assert tuple(DB.kpis_or_estimates(empty).first()) == (0, 0, 10, 0.0)
    errs = spark.createDataFrame([("a", 4, 8)], "server_id string, anomaly_count long, error_count long")
    assert tuple(DB.kpis_or_estimates(errs).first()) == (40, 4, 1, 20.0)
    full = spark.createDataFrame([("a", 50, 4, 5)], "server_id string, total_logs long, anomaly_count long, error_count long")
    assert tuple(DB.kpis_or_estimates(full).first()) == (50, 4, 1, 10.0)


def test_sample_is_exact_when_keys_repeat(spark):
    from logsift.operators.label import sample_n
    df = spark.range(0, 3000).selectExpr("id % 7 as k", "id")
    assert sample_n(df, 100, "k").count() == 100
    assert sample_n(df, 5000, "k").count() == 3000
