"""Physical-plan checks: pruning, pushdown, partial aggregation, grouped limits."""

import __spark_entry__ as E

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_per_server_has_partial_group_limit(spark):
    p = _plan(E.queries()["top_per_server"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_reads_only_needed_columns(spark):
    """The level frequency table reads one column (the total is a separate count)."""
    import re
    p = _plan(E.queries()["value_counts_level"](spark, SF001))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", p))
    assert schemas == {"struct<event_type:string>"}


def test_filters_reach_the_scan(spark):
    p = _plan(E.queries()["sample_values_priority"](spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderpriority)]" in p


def test_dedup_reads_once_and_joins_nothing(spark):
    from logsift.operators import dedup as D
    df = spark.read.parquet(f"{SF001}/events.parquet")
    p = _plan(D.drop_duplicates(df, ["event_type", "user_id"], "event_id"))
    assert "Join" not in p and p.count("FileScan") == 1 and "partial_min_by" in p
    p = _plan(D.flag_duplicates(df, ["event_type", "user_id"], "event_id"))
    assert "Join" not in p and p.count("FileScan") == 1


def test_counts_by_value_expand_no_rows_and_shuffle_no_texts(spark):
    import re
    from logsift.operators import stats as S
    df = spark.read.parquet(f"{SF001}/conversations.parquet")
    for out in (S.distinct_counts(df), S.column_profile(df), S.duplicate_rows(df), S.text_profile(df, ["role", "text"])):
        p = _plan(out)
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", p)
        assert "Expand" not in p and keys and not any(re.search(r"\b(text|role|value)#", k) for k in keys)


def test_text_profile_two_level_aggregation(spark):
    p = _plan(E.queries()["text_profile_logs"](spark, SF001))
    assert p.count("HashAggregate") + p.count("ObjectHashAggregate") + p.count("SortAggregate") >= 4


def test_no_cartesian_products(spark):
    for name in ("system_labels", "hourly_metrics", "server_status", "clean_logs", "dedup_window",
                 "value_counts_level", "zscore_outliers", "severity_distribution", "scaled_logs",
                 "pipeline_health", "normalise_label", "cap_outliers"):
        p = _plan(E.queries()[name](spark, SF001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
