"""Streaming job = batch answer on the smallest scale; sinks and readers."""

import hashlib
import json
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from logsift.functions.rules import normalise_record
from logsift.plans.views import logs
from logsift.streaming import pipeline as P
from logsift.operators import dashboards as DB

from conftest import SF0001


def published(spark, path, lines):
    """Each list of lines becomes one file, that is one micro-batch."""
    rows = [(i, x) for i, some in enumerate(lines) for x in some]
    return P.publish_files(spark.createDataFrame(rows, "slot int, value string"), path, key="slot")


def run_job(spark, root, lines, **how):
    published(spark, f"{root}/src", lines)
    job = P.start(spark, P.read_source(spark, f"{root}/src", max_files_per_trigger=1), f"{root}/out", f"{root}/ck",
                  available_now=True, files_per_batch=1, **how)
    job.awaitTermination()
    assert job.exception() is None
    return f"{root}/out"


LINE = '{"log_id": %d, "timestamp": "%s", "server_id": "s", "pod_name": "p", "message": "%s", "cpu_usage_percent": %s}'
END = [P.heartbeat("2030-01-01T00:00:00Z")]


def line(i, at, message, cpu=1.0):
    return LINE % (i, at, message, cpu)


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="logsift-stream-")
    recs = normalise_record(logs(spark, SF0001), keep=("log_id",))
    values = recs.select((F.col("log_id") / 30).cast("int").alias("slot"), P.record_values(recs).alias("value"))
    values = values.union(spark.createDataFrame([(99, END[0])], "slot int, value string"))
    done = P.publish_files(values, f"{root}/src", key="slot")
    assert done.rows == recs.count() + 1 and done.rows_per_second > 0
    job = P.start(spark, P.read_source(spark, f"{root}/src", max_files_per_trigger=1), f"{root}/out",
                  f"{root}/ck", available_now=True)
    job.awaitTermination()
    assert job.exception() is None
    st = {r["server_id"]: r["total_logs"] for r in P.read_status(spark, f"{root}/out").collect()}
    batch = {r["server_id"]: r["n"] for r in recs.groupBy("server_id").agg(F.count("*").alias("n")).collect()}
    assert st == batch
    hourly = P.read_hourly(spark, f"{root}/out")
    exp = DB.hourly_metrics(recs.withColumn("timestamp", F.col("timestamp")))
    assert hourly.count() == exp.count()
    assert P.read_alerts(spark, f"{root}/out").count() == 50
    h = P.health(spark, f"{root}/out", job).first()
    assert h["servers_count"] == 10
    assert P.throughput(job.ingest).agg(F.sum("rows")).first()[0] == done.rows
    # compaction keeps the answer and is idempotent
    before = sorted(tuple(r) for r in P.read_hourly(spark, f"{root}/out").collect())
    P.compact(spark, f"{root}/out", 1)
    P.compact(spark, f"{root}/out", 1)
    assert sorted(tuple(r) for r in P.read_hourly(spark, f"{root}/out").collect()) == before
    assert {r["server_id"]: r["total_logs"] for r in P.read_status(spark, f"{root}/out").collect()} == batch


def test_bad_records_are_quarantined_and_counted(spark):
    root = tempfile.mkdtemp(prefix="logsift-quarantine-")
    good = ['{"log_id": %d, "timestamp": "2024-01-01T00:00:0%dZ", "server_id": "s", "message": "m"}' % (i, i) for i in range(5)]
    bad = ["{broken", "not json", '{"log_id": 7, "timestamp": "never"}', '{"log_id": 8}', '{"log_id": 9, "timestamp": "12:30"}']
    raw = spark.createDataFrame([(x,) for x in good + bad], "value string")
    assert P.decode(raw).where("reason is null").count() == len(good)
    out = run_job(spark, root, [good + bad, END])
    got = sorted((r["value"], r["reason"]) for r in P.read_quarantine(spark, out).collect())
    assert got == sorted(zip(bad, ["corrupt", "corrupt", "timestamp", "timestamp", "timestamp"]))
    assert sum(r["total_logs"] for r in P.read_status(spark, out).collect()) == len(good)
    assert P.balance(spark, out).first().asDict() == {"rows_in": 10, "accepted": 5, "quarantined": 5, "invalid": 5, "kept": 5, "duplicates": 0, "late": 0}


def test_long_messages_stay_whole_in_the_stream(spark):
    texts = ["x" * 12000 + end for end in (" one", " two")]
    raw = spark.createDataFrame([('{"log_id": 1, "timestamp": "2024-01-01T00:00:00Z", "message": "%s"}' % t,) for t in texts], "value string")
    assert sorted(r["message"] for r in P.decode(raw).collect()) == texts


def test_the_earliest_copy_is_kept_across_micro_batches(spark):
    at = "2024-01-01T12:00:0%dZ"
    batches = [[line(5, at % 1, "a"), line(7, at % 1, "b"), line(9, at % 2, "a")],
               [line(4, at % 1, "a"), line(8, at % 1, "b"), line(3, "2024-01-01T12:00:01.9Z", "a")],
               [line(2, at % 1, "b"), line(10, "2024-01-01T13:00:00Z", "z")],
               [line(11, "2024-01-01T13:00:01Z", "z")],
               [line(1, at % 1, "a"), line(12, "2024-01-01T13:00:01Z", "z")],  # the first is late: its second has closed
               END]
    out = run_job(spark, tempfile.mkdtemp(prefix="logsift-earliest-"), batches)
    assert sorted((r["log_id"], r["copies"]) for r in P.read_clean(spark, out).collect()) == [(2, 3), (3, 3), (9, 1), (10, 1), (11, 2)]
    b = P.balance(spark, out).first()
    assert (b["rows_in"], b["kept"], b["duplicates"], b["late"]) == (11, 5, 5, 1)


def test_late_rows_are_counted_over_more_batches_than_the_progress_keeps(spark):
    times = ["2024-01-01T12:00:00Z", "2024-01-01T13:00:00Z", "2024-01-01T13:00:01Z", "2024-01-01T01:00:00Z"] + ["2024-01-01T13:01:%02dZ" % i for i in range(5)]
    kept = "spark.sql.streaming.numRecentProgressUpdates"  # 100 by default
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set(kept, "2")
    try:
        out = run_job(spark, tempfile.mkdtemp(prefix="logsift-late-"), [[line(i, t, f"m{i}")] for i, t in enumerate(times)] + [END])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        spark.conf.unset(kept)
    assert P.dropped_late_rows(spark, out) == 1


def test_a_replayed_ingest_batch_changes_nothing(spark):
    root = tempfile.mkdtemp(prefix="logsift-replay-")
    batch = P.decode(spark.createDataFrame([(line(i, "2024-01-01T12:00:00Z", f"m{i}", i),) for i in range(50)] + [("bad",)], "value string"))
    t = P.Tables(root)
    write = P.make_ingest_writer(t)
    write(batch, 0)
    files = P._names(spark, f"{t.route('accepted')}/batch_id=0")
    write(batch, 0)
    P._delete(spark, f"{t.profile}/batch_id=0")  # lost between the two writes
    P._delete(spark, f"{t.route('quarantined')}/batch_id=0")
    write(batch, 0)
    write(batch, 1)
    assert P._names(spark, f"{t.route('accepted')}/batch_id=0") == files
    assert P.read_quarantine(spark, root).count() == 2
    assert tuple(P.balance(spark, root).first())[:3] == (102, 100, 2)
    assert {r["n"] for r in P.read_profile(spark, root).where("column_name = 'cpu_usage_percent'").collect()} == {100}


def test_bounds_from_merged_sketches_are_within_their_rank_error(spark):
    root = tempfile.mkdtemp(prefix="logsift-bounds-")
    write = P.make_ingest_writer(P.Tables(root), sketch_k=256)
    values = [((i * 7919) % 20011) / 10 for i in range(20000)]
    for b in range(4):
        lines = [(line(i, "2024-01-01T12:00:00Z", "m", values[i]),) for i in range(b * 5000, b * 5000 + 5000)]
        write(P.decode(spark.createDataFrame(lines, "value string")), b)
    got = P.read_profile(spark, root).where("column_name = 'cpu_usage_percent'").first()
    ranks = [sum(v <= got[q] for v in values) / len(values) for q in ("q1", "q3")]
    assert got["n"] == 20000 and abs(ranks[0] - 0.25) < 0.02 and abs(ranks[1] - 0.75) < 0.02


def test_outliers_come_from_the_bounds(spark):
    at = "2024-01-01T12:00:%02dZ"
    rows = [line(i, at % (i % 60), f"m{i}", 10 + i % 7) for i in range(60)] + [line(60, at % 5, "far", 90)]
    out = run_job(spark, tempfile.mkdtemp(prefix="logsift-outliers-"), [rows, END])
    assert [(r["log_id"], r["column_name"], r["value"]) for r in P.read_outliers(spark, out).collect()] == [(60, "cpu_usage_percent", 90.0)]
    assert P.read_anomalies(spark, out).count() == 0


def test_a_micro_batch_of_many_files_is_taken_whole(spark, monkeypatch):
    import duckdb
    import __spark_entry__ as E
    from logsift.plans import stream_queries as S
    monkeypatch.setattr(S, "ROWS_PER_FILE", 300)
    monkeypatch.setattr(S, "_RUNS", {})
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF0001}/events.parquet'")
    for name in ("stream_balance", "stream_dedup", "stream_quarantine", "stream_anomalies"):
        got = E.queries()[name](spark, SF0001)
        want = con.execute(E.oracle_sql()[name]).fetchall()
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)), name
    out = next(iter(S._RUNS.values()))
    route = P.Tables(out).route("accepted")
    files = [len([n for n in P._names(spark, f"{route}/batch_id={b}") if n.endswith(".parquet")]) for b in P._numbers(spark, route, "batch_id")]
    assert len(set(files)) == 1 and files[0] > 1  # the batch of the heartbeat alone has as many
    rows = spark.read.parquet(f"{route}/batch_id=0").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert rows <= 2 * 300


def test_null_server_is_no_grand_total(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", None, "INFO"), ("2024-01-01 00:10:00", "a", "ERROR")],
                               "timestamp string, server_id string, log_level string").withColumn("timestamp", F.to_timestamp("timestamp"))
    got = {r["server_id"]: r["log_count"] for r in DB.hourly_metrics(df).collect()}
    assert got == {None: 1, "a": 1, "all": 2}
    st = spark.createDataFrame([("healthy", None), ("healthy", "a")], "status string, server_id string")
    assert sorted(map(str, map(tuple, DB.status_hierarchy(st).collect()))) == sorted(map(str, [("healthy", "", 2), (None, "healthy", 1), ("a", "healthy", 1)]))


def _batch(spark, i):
    rows = [(100 * i + j, f"2024-01-01 {i % 24:02d}:00:{j:02d}", f"server-{j % 3}", "ERROR" if j % 5 == 0 else "INFO", f"m{j}", float(j), 1.0,
             int(j % 5 == 0), "normal") for j in range(20)]
    return spark.createDataFrame(rows, "log_id long, timestamp string, server_id string, log_level string, message string, "
                                       "cpu_usage_percent double, memory_usage_mb double, is_anomaly long, anomaly_type string"
                                 ).withColumn("timestamp", F.to_timestamp("timestamp")).coalesce(1)


def test_compaction_and_retention_bound_the_tables(spark):
    root = tempfile.mkdtemp(prefix="logsift-compact-")
    write = P.make_batch_writer(P.Tables(root), compact_every=2)
    for i in range(9):
        write(_batch(spark, i), i)
    write(_batch(spark, 8), 8)  # a replay changes nothing
    # batches after the base before the last one (6) and the last two bases are left
    assert P._numbers(spark, P.Tables(root).status, "batch_id") == [7, 8]
    assert P._numbers(spark, P.Tables(root).hourly + "_base", "upto_batch") == [6, 8]
    assert P._numbers(spark, P.Tables(root).alerts, "batch_id") == [6, 7, 8]
    assert sum(r["total_logs"] for r in P.read_status(spark, root).collect()) == 9 * 20
    hourly = P.read_hourly(spark, root).where("server_id = 'all'").collect()
    assert len(hourly) == 9 and all(r["log_count"] == 20 and r["error_rate"] == 0.2 for r in hourly)
    assert P.read_alerts(spark, root).count() == 9 * 4
    assert P.health(spark, root).first()["active"]


def test_packed_tables_keep_a_bounded_number_of_files(spark):
    root = tempfile.mkdtemp(prefix="logsift-pack-")
    path = f"{root}/rows"
    most, total = 0, 0
    for i in range(300):
        P._write_partition(spark.range(i * 10, i * 10 + 10).coalesce(1), path, i)
        if i and i % 20 == 0:
            P.pack(spark, path, i, target=6000)
            P.pack(spark, path, i, target=6000)  # a replay changes nothing
            folders = len(P._numbers(spark, path, "batch_id"))
            most = max(most, folders + len([n for n in P._names(spark, f"{path}_packed") if n.startswith("upto=")]))
        if i % 50 == 0 or i == 299:
            ids = [r[0] for r in P.read_packed(spark, path).select("id").collect()]
            assert sorted(ids) == list(range(i * 10 + 10))
        total = i
    segments = P._manifest(spark, path)["segments"]
    assert total == 299 and most <= 41 + 8 and all(s["bytes"] >= 6000 for s in segments[:-1])
    # a reader that has opened the manifest before the last one still finds its files
    m = P._manifest(spark, path, 1)
    paths = [f"{path}_packed/{s['name']}" for s in m["segments"]] + [f"{path}/batch_id={n}" for n in P._numbers(spark, path, "batch_id") if n > m["upto"]]
    assert spark.read.parquet(*paths).count() == 3000


def _files(folder, end):
    return {p: p.stat().st_size for p in Path(str(folder).removeprefix("file:")).rglob(f"*{end}") if p.is_file()}


def test_the_job_leaves_little_on_disk(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f: n for d in blocks.localDirsString() for f, n in _files(d, ".data").items()}
    was, n = shuffles(), 3000
    lines = [line(i, "2024-01-01T12:%02d:%02dZ" % (i // 60 % 60, i % 60), hashlib.sha256(b"%d" % i).hexdigest()[:60], i) for i in range(n)]
    size, root = sum(map(len, lines)), tempfile.mkdtemp(prefix="logsift-disk-")
    published(spark, f"{root}/src", [lines, END])
    assert sum(_files(f"{root}/src", "").values()) < size / 2  # all that is published lies there at once
    job = P.start(spark, P.read_source(spark, f"{root}/src", max_files_per_trigger=1, keep_source=False), f"{root}/out", f"{root}/ck",
                  available_now=True, files_per_batch=1, state_partitions=1)
    job.awaitTermination()
    assert job.exception() is None and P.read_clean(spark, f"{root}/out").count() == n
    left = lambda: sum(n for f, n in shuffles().items() if f not in was)
    for _ in range(50):  # executors are told to remove them
        if left() < size / 20:
            break
        time.sleep(0.1)
    assert left() < size / 20
    assert sum(_files(f"{root}/src", ".gz").values()) < size / 20  # what ingest has taken goes
    assert 0 < sum(_files(f"{root}/ck/results/state", ".sst").values()) / n < 150


def test_the_key_of_a_text_is_itself_or_its_digest(spark):
    digest = hashlib.sha256(b"x" * 70).hexdigest()
    texts = ["a", "a", "", "x" * 63, "x" * 64, "x" * 70, digest, None, None, "x" * 70]
    raw = spark.createDataFrame([(json.dumps({"log_id": i, "timestamp": "2024-01-01T12:00:00Z", "pod_name": "p", "message": t}),) for i, t in enumerate(texts)], "value string")
    kept = P.dedup_stream(P.decode(raw).drop("reason", "value"))
    assert sorted((r["log_id"], r["copies"]) for r in kept.collect()) == [(0, 2), (2, 1), (3, 1), (4, 1), (5, 2), (6, 1), (7, 2)]
