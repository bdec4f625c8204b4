import hashlib
import re

from logsift.llm.dedup import exact_dedup, keep_first_copies

SCHEMA = "doc_id long, text string, keep_id string, _run int"


def brute(rows):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc or 0, i, doc))
    out = []
    for key, g in groups.items():
        best = min(g)
        for x in g:
            out.append((x[4], best[4], len(g), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_matches_brute_force_with_nulls_ties_blanks_and_clashing_columns(spark):
    data = [(1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, None), (5, ""), (6, "\x0b \r"), (7, "é "), (8, "é"), (None, "ab"),
            (None, "zz"), (9, "x" * 200_000), (10, "x" * 200_000), (9, "x" * 200_000), (2, "ab")]
    df = spark.createDataFrame([(d, t, "k", 3) for d, t in data], SCHEMA).repartition(5)
    out = exact_dedup(df)
    assert rows_of(out) == brute(data)
    kept = out.where("kept").collect()
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({b[3] for b in brute(data)})


def test_one_group_holds_most_rows(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('t', id)) as text")
    out = {r.doc_id: r for r in exact_dedup(df, runs=8, fan_in=2).collect()}
    assert len(out) == 3000 and out[2997].keep_id == 0 and out[2997].group_size == 1000 and out[1].group_size == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(df).count() == 0 and keep_first_copies(df).columns == df.columns


def test_filter_keeps_columns_and_one_of_repeated_rows(spark):
    data = [(1, "a b"), (2, "ab"), (2, "a  b"), (3, "c"), (3, "c"), (None, None), (4, "")]
    df = spark.createDataFrame([(d, t, "k", 3) for d, t in data], SCHEMA)
    out = keep_first_copies(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == [(2, "a  b"), (3, "c"), (4, "")]
