"""Property checks: expressions vs the Python standard library on a fuzzed
Unicode corpus, invariants of cleaning, repartition invariance."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from logsift.contracts import K8S_LOG, NAMESPACE_PATTERN, POD_NAME_PATTERN
from logsift.functions import rules as R
from logsift.functions import text as TX
from logsift.operators import clean as C
from logsift.operators.label import sample_n
from logsift.operators.positions import with_position
from logsift.plans.views import dup_logs

from conftest import SF0001, SF001

POOL = (list("abcXYZ019-. ") + [
    "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2000", "\u2009",
    "\u200a", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\x00", "\x07", "\x7f", "\x9f",
    "\u200b", "\u200e", "\ufeff", "\ue000", "\u0301", "\u00e9", "\ufb01", "\u00bd", "\u2460", "\u212b",
    "\u1e9b", "\u3300", "\U0001d400", "\u0378"])


def _corpus(n=400, seed=11):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(POOL) for _ in range(rnd.randint(0, 24))) for _ in range(n)]


def _py_collapse(t):
    return " ".join(t.split())


def _py_strip(t):
    return "".join(ch for ch in t if unicodedata.category(ch)[0] != "C" or ch in "\n\t")


def _py_std(t):
    return _py_collapse(_py_strip(unicodedata.normalize("NFKD", t))).strip()


def test_text_expressions_match_stdlib(spark):
    corpus = _corpus()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "i int, x string")
    rows = df.select("i", TX.collapse_ws("x").alias("c"), TX.strip_control("x").alias("s"),
                     TX.standardise_text("x").alias("std")).orderBy("i").collect()
    for r, t in zip(rows, corpus):
        assert r["s"] == _py_strip(t), repr(t)
        assert r["std"] == _py_std(t), repr(t)
        # H1 alone also collapses the separators Python's split() knows
        assert r["c"] == _py_collapse(t).strip(" "), repr(t)


def test_pod_and_namespace_regex_match_python(spark):
    rnd = random.Random(5)
    alphabet = "ab0-.A_\n"
    names = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(names)], "i int, x string")
    rows = df.select("i", R.is_pod_name("x").alias("p"), R.is_namespace("x").alias("n")).orderBy("i").collect()
    for r, t in zip(rows, names):
        assert r["p"] == bool(re.match(POD_NAME_PATTERN, t)), repr(t)
        assert r["n"] == (bool(re.match(NAMESPACE_PATTERN, t)) and len(t) <= 253), repr(t)


def test_cleaning_counts_balance_and_text_idempotent(spark):
    r = C.clean(dup_logs(spark, SF0001), "log_id", K8S_LOG)
    s = {x["metric"]: x["value"] for x in r.summary.collect()}
    assert s["initial_rows"] == s["final_rows"] + s["rows_removed"]
    assert s["rows_removed"] == (s["initial_rows"] - s["rows_after_missing"]) + s["duplicates_removed"]
    again = r.data.select(TX.changed("message", TX.standardise_text("message")).alias("c")).where("c").count()
    assert again == 0


def test_repartition_invariance(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey")
    a = sorted(r[0] for r in sample_n(orders.repartition(3), 500, "o_orderkey").collect())
    b = sorted(r[0] for r in sample_n(orders.repartition(11), 500, "o_orderkey").collect())
    assert a == b
    p1 = {r[0]: r[1] for r in with_position(orders.repartition(2), ["o_orderkey"], "p", 3).collect()}
    p2 = {r[0]: r[1] for r in with_position(orders.repartition(9), ["o_orderkey"], "p", 7).collect()}
    assert p1 == p2
