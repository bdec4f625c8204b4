"""Structured Streaming job: two chained queries, each record decoded once.

    source (Kafka | files) -> INGEST: decode, clean, validate -> records (accepted | quarantined), profile
    records/accepted       -> RESULTS: keep the earliest copy -> clean rows, anomalies and outliers,
                              status and hourly partials, latest alerts

Ingest reads and parses the source once.  One write per micro-batch routes every record to the
accepted or the quarantined ones; counts and quantile sketches are observed by that same write
and folded into a running profile, so that at any instant records in = accepted + quarantined.
Results read the accepted rows as typed columns.  Copies of a record (same pod, message and second)
meet in one event-time window that holds its earliest row and the number of copies, and comes out when
the watermark passes it; copies of a hot key are combined in each task before they reach the state.

Every write of a micro-batch goes to a ``batch_id=<id>`` folder that a replay writes again, so replays change
nothing.  Status, hourly and profile tables hold additive values; tables of rows are packed into files of a
wanted size under a manifest that is swapped as a whole.
"""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logsift.contracts import K8S_LOG, OUTLIER_FIELDS, OUTLIER_K_AUDIT
from logsift.functions.outlier import iqr_bounds
from logsift.functions.rules import classify_status, severity_of_level
from logsift.functions.text import standardise_text
from logsift.functions.time import parse_ts
from logsift.operators.dashboards import ERROR_LEVELS
from logsift.operators.validate import error_messages

DEFAULT_DELAY = "10 minutes"
DEFAULT_TRIGGER = "10 seconds"
ALERTS_KEPT = 50
#: Values that a quantile sketch holds before it begins to thin them; the rank error falls with about 1/k.
SKETCH_K = 4096
#: Micro-batches between two compactions, and the size that packed files are to have.
COMPACT_EVERY = 100
PACKED_BYTES = 128 << 20
#: State store of the open groups, unless the session names another: memory is bounded over all stores of an executor; its files lie on the
#: executor's disk and again in the checkpoint, so they are packed well (rows of a block are compressed together, no space is reserved).
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
               "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
               "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "64",
               "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
               "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}

#: Shuffle files go once the write or the micro-batch that made them is done, not when the driver next collects its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

RECORD_SCHEMA = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("server_id", T.StringType()),
    T.StructField("log_level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("pod_name", T.StringType()),
    T.StructField("namespace", T.StringType()),
    T.StructField("node_name", T.StringType()),
    T.StructField("container_name", T.StringType()),
    T.StructField("cpu_usage_percent", T.DoubleType()),
    T.StructField("memory_usage_mb", T.LongType()),
    T.StructField("network_bytes", T.LongType()),
    T.StructField("is_anomaly", T.LongType()),
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("app_type", T.StringType()),
    T.StructField("source_component", T.StringType()),
])

#: What results read of an accepted record.
ACCEPTED_SCHEMA = T.StructType([
    *[T.StructField(f.name, T.TimestampType() if f.name == "timestamp" else f.dataType) for f in RECORD_SCHEMA],
    T.StructField("heartbeat", T.BooleanType()), T.StructField("errors", T.ArrayType(T.StringType()))])


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """The session's settings for what is written or started meanwhile; a streaming query copies them when it starts."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- K1 publish ------------------------------------------------------------------

def record_values(records: DataFrame) -> Column:
    """The JSON text of a record, its time as ISO text."""
    stamped = [F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp") if c == "timestamp" else F.col(c) for c in records.columns]
    return F.to_json(F.struct(*stamped))


@dataclass(frozen=True)
class Published:
    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def publish_files(values: DataFrame, path: str, key: str = "server_id", order_col: str | None = None, files_per_key: int = 1) -> Published:
    """Write column ``value`` as lines, keyed (K1): every key goes whole, in order, to one file of its own folder.

    With more ``files_per_key`` a key's rows are dealt by a hash over exactly so many files, each in order (some may be empty), which so
    many tasks write.  The files are dated in key order, a second apart, so that a file stream takes them in that order.  They are
    compressed, since all of them are there at once; a reader takes a file whole anyway."""
    began, seen = time.time(), Observation()
    out, folders = values.observe(seen, F.count(F.lit(1)).alias("rows")), [key]
    if files_per_key > 1:
        out, folders = out.withColumn("part", F.pmod(F.xxhash64(*values.columns), F.lit(files_per_key)).cast("int")), [key, "part"]
        out = out.repartition(4 * files_per_key, *folders)  # few tasks get several of the files
    else:
        out = out.repartition(F.col(key))
    order = [*folders, order_col] if order_col else folders
    spark = values.sparkSession
    with session_settings(spark, SHUFFLES_GO):
        out.sortWithinPartitions(*order).select("value", *folders).write.mode("overwrite").partitionBy(*folders).option("compression", "gzip").text(path)
    fs, root = _folder(spark, path)
    kind = values.schema[key].dataType
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    names.sort(key=lambda n: int(n.split("=", 1)[1]) if isinstance(kind, T.IntegralType) else n)
    now = int(began * 1000)
    for i, name in enumerate(names):
        for part in (range(files_per_key) if files_per_key > 1 else [None]):
            folder = f"{path}/{name}" + ("" if part is None else f"/part={part}")
            if not _exists(spark, folder):
                fs.create(_folder(spark, f"{folder}/empty.txt")[1]).close()
            for s in fs.listStatus(_folder(spark, folder)[1]):
                fs.setTimes(s.getPath(), now - (len(names) - i) * 1000, -1)
    return Published(seen.get["rows"], time.time() - began)


def publish_kafka(records: DataFrame, bootstrap: str, topic: str, key: str = "server_id") -> None:
    """Keyed JSON records to Kafka, all acks, idempotent producer.
    Needs the Kafka connector on the classpath."""
    (records.select(F.col(key).cast("string").alias("key"), record_values(records).alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
     .option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save())


def heartbeat(at: str) -> str:
    """A record without content: it only says that the source has reached the time ``at``, so that older windows close."""
    return json.dumps({"heartbeat": True, "timestamp": at})


def throughput(query: StreamingQuery) -> DataFrame:
    """(batch_id, rows, rows_per_second, seconds) of the query's recent micro-batches (K1)."""
    rows = [(p["batchId"], int(p["numInputRows"]), float(p.get("processedRowsPerSecond") or 0.0), p["batchDuration"] / 1000.0) for p in query.recentProgress]
    return SparkSession.getActiveSession().createDataFrame(rows, "batch_id long, rows long, rows_per_second double, seconds double")


# --- K2, K3 decode, clean, validate -------------------------------------------------

def read_source(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                max_files_per_trigger: int | None = None, keep_source: bool = True) -> DataFrame:
    """Raw stream with a string ``value`` column: Kafka topic or a folder of JSON lines.

    Without ``keep_source`` Spark deletes the files of a micro-batch some time after it is committed."""
    if kafka:
        r = spark.readStream.format("kafka")
        for k, v in kafka.items():
            r = r.option(k, v)
        return r.load().select(F.col("value").cast("string").alias("value"))
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if not keep_source:
        r = r.option("cleanSource", "delete")
    return r.load(path).select("value")


def decode(raw: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """One row per raw record, parsed once (K2, K3).

    ``reason``: why it is not taken, ``corrupt`` (no JSON record) or ``timestamp`` (missing or not a
    time), with its text in ``value``; else both are null, the time is parsed, the whole message
    standardised and ``errors`` holds the first failing rule of each field (J6), which keeps no record out."""
    extra = [T.StructField("heartbeat", T.BooleanType()), T.StructField("_corrupt_record", T.StringType())]
    r = F.from_json("value", T.StructType([*schema.fields, *extra]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    at = parse_ts("r.timestamp")
    reason = F.when(F.col("r").isNull() | F.col("r._corrupt_record").isNotNull(), "corrupt").when(at.isNull(), "timestamp")
    rows = raw.select("value", r.alias("r")).select("value", reason.alias("reason"), at.alias("at"), "r")
    fields = [F.col("at").alias("timestamp") if f.name == "timestamp" else F.col(f"r.{f.name}") for f in schema.fields]
    rows = rows.select("reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"), *fields,
                       F.coalesce("r.heartbeat", F.lit(False)).alias("heartbeat")).withColumn("message", standardise_text("message"))
    taken = F.col("reason").isNull() & ~F.col("heartbeat")
    return rows.withColumn("errors", F.when(taken, error_messages(rows, K8S_LOG)))


# --- K4 ------------------------------------------------------------------------------

def dedup_stream(df: DataFrame, delay: str = DEFAULT_DELAY, seconds: int = 1, pos_col: str = "log_id") -> DataFrame:
    """Of the rows with the same pod and message in the same ``seconds`` the one with the smallest position, and its ``copies`` (K4).

    A group comes out once the watermark passes its window; rows that come later still are late and dropped."""
    rank = F.struct(F.col(pos_col).isNull(), F.col(pos_col), F.col("timestamp"))
    # a digest has 64 characters: a shorter text is its own key, which the state's compression meets again in the row
    text = F.when(F.length("message") < 64, F.col("message")).otherwise(F.sha2("message", 256))
    groups = df.withWatermark("timestamp", delay).groupBy(F.window("timestamp", f"{seconds} seconds"), "pod_name", text.alias("_message"))
    best = groups.agg(F.min_by(F.struct(*df.columns), rank).alias("_row"), F.count(F.lit(1)).alias("copies")).select("_row.*", "copies")
    return best.where(~F.coalesce("heartbeat", F.lit(False))).drop("heartbeat") if "heartbeat" in df.columns else best


# --- tables -------------------------------------------------------------------------------

@dataclass
class Tables:
    root: str

    def __getattr__(self, name: str) -> str:
        if name not in ("records", "profile", "clean", "anomalies", "status", "hourly", "alerts"):
            raise AttributeError(name)
        return f"{self.root}/{name}" + ("_partials" if name in ("status", "hourly") else "")

    def route(self, name: str) -> str:
        return f"{self.records}/route={name}"


def _folder(spark: SparkSession, path: str):
    """Hadoop file system and path of a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _numbers(spark: SparkSession, path: str, column: str, finished: bool = False) -> list[int]:
    """Numbers N of the sub-folders ``column=N``; only those written to their end with ``finished``."""
    out = [int(n.split("=", 1)[1]) for n in _names(spark, path) if n.startswith(f"{column}=")]
    return sorted(n for n in out if not finished or _exists(spark, f"{path}/{column}={n}/_SUCCESS"))


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if nothing has been written there yet; other failures are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _write_partition(df: DataFrame, path: str, batch_id: int, *more: str) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("compression", "zstd")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*more, "batch_id").parquet(path))


def _latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest version of a table of versions ``batch_id=N`` (before ``before``)."""
    found = [n for n in _numbers(spark, path, "batch_id") if before is None or n < before]
    return spark.read.parquet(f"{path}/batch_id={found[-1]}") if found else None


# --- packed tables: a manifest names the segments and the last batch that they cover ---

def _manifest(spark: SparkSession, path: str, back: int = 0) -> dict:
    """The newest manifest of a table (or one ``back`` before it); an empty one if there is none."""
    names = [n for n in _names(spark, f"{path}_packed/_manifest") if n.endswith(".json")]
    if len(names) <= back:
        return {"upto": -1, "segments": []}
    fs, p = _folder(spark, f"{path}_packed/_manifest/{names[-1 - back]}")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _bytes(spark: SparkSession, path: str) -> int:
    fs, p = _folder(spark, path)
    return int(fs.getContentSummary(p).getLength())


def read_packed(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of rows: the manifest's segments and the batches after them; None if there is nothing yet."""
    m = _manifest(spark, path)
    paths = [f"{path}_packed/{s['name']}" for s in m["segments"]]
    paths += [f"{path}/batch_id={n}" for n in _numbers(spark, path, "batch_id") if n > m["upto"]]
    return spark.read.parquet(*paths) if paths else None


def pack(spark: SparkSession, path: str, upto_batch: int, target: int = PACKED_BYTES) -> None:
    """Pack the batches up to ``upto_batch`` into files of about ``target`` bytes (K7).

    A last segment under the target is filled up first, so that a row is rewritten only until its segment is
    full.  Readers see a new segment once its manifest is renamed into place; what the manifest before
    it does not need any more goes then, so a reader that has just opened that one still finds its files."""
    m = _manifest(spark, path)
    new = [n for n in _numbers(spark, path, "batch_id") if m["upto"] < n <= upto_batch]
    if not new:
        return
    full, tail = m["segments"], []
    if full and full[-1]["bytes"] < target:
        full, tail = full[:-1], full[-1:]
    sources = [f"{path}_packed/{s['name']}" for s in tail] + [f"{path}/batch_id={n}" for n in new]
    size = sum(_bytes(spark, p) for p in sources)
    name = f"upto={upto_batch:012d}"
    spark.read.parquet(*sources).coalesce(max(1, -(-size // target))).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}_packed/{name}")
    body = json.dumps({"upto": upto_batch, "segments": [*full, {"name": name, "bytes": _bytes(spark, f"{path}_packed/{name}")}]})
    fs, tmp = _folder(spark, f"{path}_packed/_manifest/.{upto_batch:012d}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    fs.rename(tmp, _folder(spark, f"{path}_packed/_manifest/{upto_batch:012d}.json")[1])
    used = {s["name"] for k in (0, 1) for s in _manifest(spark, path, k)["segments"]}
    for n in _numbers(spark, path, "batch_id"):
        if n <= m["upto"]:
            _delete(spark, f"{path}/batch_id={n}")
    for n in _names(spark, f"{path}_packed"):
        if n.startswith("upto=") and n not in used:
            _delete(spark, f"{path}_packed/{n}")
    for n in [x for x in _names(spark, f"{path}_packed/_manifest") if x.endswith(".json")][:-2]:
        _delete(spark, f"{path}_packed/_manifest/{n}")


# --- ingest: records and profile ---------------------------------------------------------

COUNTS = ("rows_in", "accepted", "quarantined", "invalid")


def _profile_metrics(k: int) -> list[Column]:
    real = ~F.col("heartbeat")
    taken = real & F.col("reason").isNull()
    return [F.count_if(real).alias("rows_in"), F.count_if(taken).alias("accepted"), F.count_if(F.col("reason").isNotNull()).alias("quarantined"),
            F.count_if(taken & (F.size("errors") > 0)).alias("invalid"),
            *[F.kll_sketch_agg_double(F.when(taken, F.col(c).cast("double")), F.lit(k)).alias(c) for c in OUTLIER_FIELDS]]


def _fold_profile(p: DataFrame, k: int) -> DataFrame:
    return p.agg(*[F.sum(c).alias(c) for c in COUNTS], *[F.kll_merge_agg_double(c, F.lit(k)).alias(c) for c in OUTLIER_FIELDS])


def _fill_up(spark: SparkSession, path: str, files: int) -> None:
    """Bring an accepted batch of fewer rows than ``files`` to so many files, so that results take it alone; each holds one row
    without a time, which no accepted record is and results leave out."""
    there = len([n for n in _names(spark, path) if n.endswith(".parquet")])
    if 0 < there < files:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in ACCEPTED_SCHEMA]
        spark.range(0, files - there, 1, files - there).select(*empty).write.mode("append").parquet(path)


def make_ingest_writer(tables: Tables, sketch_k: int = SKETCH_K, compact_every: int = COMPACT_EVERY, files_per_batch: int | None = None):
    """One write per micro-batch that routes all records and observes the counts and sketches; then the running profile.

    ``files_per_batch``: so many accepted files and at most so many quarantined ones, written by as many tasks; else one for each task."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _exists(spark, f"{tables.profile}/batch_id={batch_id}/_SUCCESS"):
            return  # a replay of a batch that was written to its end
        seen = Observation()
        # a replay leaves a route alone that is there: its readers may have taken its files
        there = [r for r in ("accepted", "quarantined") if _exists(spark, f"{tables.route(r)}/batch_id={batch_id}")]
        routed = batch.observe(seen, *_profile_metrics(sketch_k)).withColumn("route", F.when(F.col("reason").isNull(), "accepted").otherwise("quarantined"))
        missing = routed.where(~F.col("route").isin(there))
        if files_per_batch:  # rows are dealt by their place in the source
            missing = missing.repartitionById(files_per_batch, F.pmod(F.monotonically_increasing_id(), F.lit(files_per_batch)).cast("int"))
        _write_partition(missing, tables.records, batch_id, "route")
        if files_per_batch:
            _fill_up(spark, f"{tables.route('accepted')}/batch_id={batch_id}", files_per_batch)
        got = seen.get
        kinds = ", ".join([f"{c} long" for c in COUNTS] + [f"{c} binary" for c in OUTLIER_FIELDS])
        now = spark.createDataFrame([tuple(got[c] if c in COUNTS else bytearray(got[c]) for c in (*COUNTS, *OUTLIER_FIELDS))], kinds)
        before = _latest(spark, tables.profile, before=batch_id)
        total = _fold_profile(now if before is None else before.unionByName(now), sketch_k)
        total.write.mode("overwrite").parquet(f"{tables.profile}/batch_id={batch_id}")
        for n in _numbers(spark, tables.profile, "batch_id")[:-10]:  # the newest versions stay for readers and a replay
            _delete(spark, f"{tables.profile}/batch_id={n}")
        if batch_id and batch_id % compact_every == 0:
            pack(spark, tables.route("quarantined"), batch_id)
    return write


def read_quarantine(spark: SparkSession, out_root: str) -> DataFrame:
    """Quarantined records (value, reason); empty if there is none."""
    df = read_packed(spark, Tables(out_root).route("quarantined"))
    return df.select("value", "reason") if df is not None else spark.createDataFrame([], "value string, reason string")


def read_profile(spark: SparkSession, out_root: str) -> DataFrame:
    """Per column of OUTLIER_FIELDS: n, q1, q3, lower and upper bound, from the merged sketches of all accepted records (K7)."""
    p = _latest(spark, Tables(out_root).profile)
    if p is None:
        return spark.createDataFrame([], "column_name string, n long, q1 double, q3 double, lower double, upper double")
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in OUTLIER_FIELDS])).alias("x")
    rows = p.select(one).select("x.column_name", F.kll_sketch_get_n_double("x.s").alias("n"), "x.s")
    q = lambda v: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(v)))
    lower, upper = iqr_bounds(F.col("q1"), F.col("q3"), OUTLIER_K_AUDIT)
    return rows.select("column_name", "n", q(0.25).alias("q1"), q(0.75).alias("q3")).select("*", lower.alias("lower"), upper.alias("upper"))


# --- results: writers (K5-K8) ---------------------------------------------------------------

def is_anomaly_row() -> Column:
    """Anomaly rule: labelled anomaly or cpu above 100 % (K7)."""
    return F.coalesce(F.col("is_anomaly") == 1, F.lit(False)) | F.coalesce(F.col("cpu_usage_percent") > 100, F.lit(False))


def breaches(bounds: dict[str, tuple[float, float]]) -> Column:
    """Names of the columns whose value lies outside its bounds."""
    out = [F.when((F.col(c) < lo) | (F.col(c) > hi), F.lit(c)) for c, (lo, hi) in bounds.items()]
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


def anomaly_rows(batch: DataFrame, bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Rows that the rule (``by_rule``) or the profile's bounds (``breach``) single out."""
    marked = batch.withColumn("by_rule", is_anomaly_row()).withColumn("breach", breaches(bounds or {}))
    return marked.where(F.col("by_rule") | (F.size("breach") > 0)).select(
        "log_id", "timestamp", "server_id", severity_of_level("log_level").alias("severity"),
        "message", "anomaly_type", "log_level", "by_rule", "breach", *[F.col(c).cast("double").alias(c) for c in bounds or {}])


def status_partials(batch: DataFrame) -> DataFrame:
    lvl = F.upper("log_level")
    return batch.groupBy("server_id").agg(
        F.count(F.lit(1)).alias("total_logs"), F.sum("copies").alias("copies"), F.count_if(lvl.isin(*ERROR_LEVELS)).alias("error_count"),
        F.count_if(lvl == "WARNING").alias("warning_count"), F.max("timestamp").alias("last_update"),
        F.max("cpu_usage_percent").alias("max_cpu"), F.max("memory_usage_mb").alias("max_memory_mb"),
        F.count_if(is_anomaly_row()).alias("anomaly_count"))


def hourly_partials(batch: DataFrame) -> DataFrame:
    """Per (hour, server) and (hour, 'all'): one row becomes two, one aggregate."""
    both = batch.select(F.window("timestamp", "1 hour").start.alias("hour"),
                        F.explode(F.array(F.col("server_id"), F.lit("all"))).alias("server_id"),
                        F.upper("log_level").isin(*ERROR_LEVELS).alias("_err"))
    return both.groupBy("hour", "server_id").agg(F.count(F.lit(1)).alias("log_count"),
                                                 F.count_if("_err").alias("errors"))


def make_batch_writer(tables: Tables, compact_every: int = COMPACT_EVERY, packed_bytes: int = PACKED_BYTES):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch if "copies" in batch.columns else batch.withColumn("copies", F.lit(1).cast("long"))
        _write_partition(rows, tables.clean, batch_id)
        path = f"{tables.clean}/batch_id={batch_id}"
        if not _exists(spark, path):
            return  # no group closed; partials are additive and alerts fall back to the newest version
        b = spark.read.schema(rows.schema).parquet(path)  # the other tables come from the written rows
        bounds = {r["column_name"]: (r["lower"], r["upper"]) for r in read_profile(spark, tables.root).collect()
                  if r["n"] and r["q1"] < r["q3"]}  # one row per column
        found = anomaly_rows(b).where("by_rule").select(ALERT_COLUMNS)
        before = _latest(spark, tables.alerts, before=batch_id)
        pool = found if before is None else before.unionByName(found)
        latest = pool.orderBy(F.desc("timestamp"), F.desc("log_id")).limit(ALERTS_KEPT)
        writes = [(anomaly_rows(b, bounds), tables.anomalies), (status_partials(b), tables.status),
                  (hourly_partials(b), tables.hourly), (latest, tables.alerts)]
        with ThreadPoolExecutor(len(writes)) as pool_of_writers:  # small jobs over the same rows: side by side
            list(pool_of_writers.map(inheritable_thread_target(spark)(lambda w: _write_partition(*w, batch_id)), writes))
        if batch_id and batch_id % compact_every == 0:
            compact(spark, tables.root, batch_id)
            retire(spark, tables.root, batch_id)
            for p in (tables.clean, tables.anomalies):
                pack(spark, p, batch_id, packed_bytes)
    return write


# --- the job ------------------------------------------------------------------------------------

@dataclass
class Job:
    """Both queries of the job."""
    ingest: StreamingQuery
    results: StreamingQuery

    def awaitTermination(self) -> None:
        for q in (self.ingest, self.results):
            q.awaitTermination()

    def exception(self):
        return self.ingest.exception() or self.results.exception()

    def stop(self) -> None:
        for q in (self.ingest, self.results):
            q.stop()

    @property
    def lastProgress(self):
        return self.results.lastProgress


def start(spark: SparkSession, raw: DataFrame, out_root: str, checkpoint: str, delay: str = DEFAULT_DELAY,
          trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False, compact_every: int = COMPACT_EVERY,
          sketch_k: int = SKETCH_K, files_per_batch: int | None = None, keep_accepted: bool = True,
          state_partitions: int | None = None) -> Job:
    """Start the job (K9: 10 s micro-batches by default).

    With ``available_now`` ingest takes all there is before this returns, then results do. With ``files_per_batch``
    each micro-batch of ingest writes so many accepted files, and results take as many at a time: with ``available_now`` the same
    rows that ingest took at a time.  ``state_partitions``: partitions of the groups' state (by default those of the session's shuffles).
    Without ``keep_accepted`` Spark deletes the accepted files that results have taken.

    The groups still open live in the RocksDB state store (off-heap, spills to local
    disk, checkpointed incrementally) unless the session already names a
    provider; the choice is fixed per checkpoint at the first run."""
    for key, value in STATE_STORE.items():
        if not spark.conf.get(key, None):
            spark.conf.set(key, value)
    tables = Tables(out_root)
    when = {"availableNow": True} if available_now else {"processingTime": trigger}
    with session_settings(spark, SHUFFLES_GO):
        ingest = (decode(raw).writeStream.foreachBatch(make_ingest_writer(tables, sketch_k, compact_every, files_per_batch))
                  .option("checkpointLocation", f"{checkpoint}/ingest").trigger(**when).start())
    if available_now:
        ingest.awaitTermination()
    fs, p = _folder(spark, tables.route("accepted"))
    fs.mkdirs(p)
    r = spark.readStream.schema(ACCEPTED_SCHEMA)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if not keep_accepted:
        r = r.option("cleanSource", "delete")
    accepted = r.parquet(tables.route("accepted")).select(*ACCEPTED_SCHEMA.names).where(F.col("timestamp").isNotNull())
    stream = dedup_stream(accepted, delay)
    shuffles = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with session_settings(spark, SHUFFLES_GO | shuffles):
        results = (stream.writeStream.foreachBatch(make_batch_writer(tables, compact_every)).outputMode("append")
                   .option("checkpointLocation", f"{checkpoint}/results").trigger(**when).start())
    return Job(ingest, results)


# --- readers of the result tables -------------------------------------------------------

ALERT_COLUMNS = ["log_id", "timestamp", "server_id", "severity", "message", "anomaly_type", "log_level"]
ALERTS_SCHEMA = "log_id long, timestamp timestamp, server_id string, severity string, message string, anomaly_type string, log_level string"


def read_clean(spark: SparkSession, out_root: str) -> DataFrame:
    """Cleaned rows without copies, with ``copies`` and the ``errors`` of each (K3, K4)."""
    df = read_packed(spark, Tables(out_root).clean)
    if df is None:
        df = spark.createDataFrame([], ACCEPTED_SCHEMA).drop("heartbeat").withColumn("copies", F.lit(1).cast("long"))
    return df


def read_anomalies(spark: SparkSession, out_root: str) -> DataFrame:
    """Rows that the rule singles out (K7)."""
    df = read_packed(spark, Tables(out_root).anomalies)
    return df.where("by_rule").select(ALERT_COLUMNS) if df is not None else spark.createDataFrame([], ALERTS_SCHEMA)


def read_outliers(spark: SparkSession, out_root: str) -> DataFrame:
    """(log_id, timestamp, server_id, column_name, value): values outside the profile's bounds (K7)."""
    df = read_packed(spark, Tables(out_root).anomalies)
    if df is None or not set(OUTLIER_FIELDS) & set(df.columns):
        return spark.createDataFrame([], "log_id long, timestamp timestamp, server_id string, column_name string, value double")
    value = F.coalesce(*[F.when(F.col("column_name") == c, F.col(c)) for c in OUTLIER_FIELDS if c in df.columns])
    return (df.withColumn("column_name", F.explode("breach")).withColumn("value", value)
            .select("log_id", "timestamp", "server_id", "column_name", "value"))


def balance(spark: SparkSession, out_root: str) -> DataFrame:
    """One row: rows_in = accepted + quarantined; accepted = kept + duplicates + late, where ``late`` also counts rows of
    groups that are still open (none once a heartbeat has closed them); invalid: accepted with a failing rule."""
    p = _latest(spark, Tables(out_root).profile)
    if p is None:
        p = spark.createDataFrame([(0,) * len(COUNTS)], ", ".join(f"{c} long" for c in COUNTS))
    kept, copies = 0, 0
    if _exists(spark, Tables(out_root).status):
        kept, copies = (x or 0 for x in _base_and_partials(spark, Tables(out_root).status).agg(F.sum("total_logs"), F.sum("copies")).first())
    return p.select(*COUNTS, F.lit(kept).cast("long").alias("kept"), F.lit(copies - kept).cast("long").alias("duplicates"),
                    (F.col("accepted") - copies).alias("late"))


def dropped_late_rows(spark: SparkSession, out_root: str) -> int:
    """Rows that came after their group was closed, over all batches and restarts (see ``balance``)."""
    return int(balance(spark, out_root).first()["late"])


def _fold_status(p: DataFrame) -> DataFrame:
    return p.groupBy("server_id").agg(
        F.sum("total_logs").alias("total_logs"), F.sum("copies").alias("copies"), F.sum("error_count").alias("error_count"),
        F.sum("warning_count").alias("warning_count"), F.max("last_update").alias("last_update"),
        F.max("max_cpu").alias("max_cpu"), F.max("max_memory_mb").alias("max_memory_mb"),
        F.sum("anomaly_count").alias("anomaly_count"))


def _fold_hourly(p: DataFrame) -> DataFrame:
    return p.groupBy("hour", "server_id").agg(F.sum("log_count").alias("log_count"), F.sum("errors").alias("errors"))


def _base_and_partials(spark: SparkSession, partials_path: str, upto: int | None = None) -> DataFrame:
    """Latest finished base (before ``upto`` if given) and the partials written after it (up to ``upto``)."""
    base_path = partials_path + "_base"
    done = [n for n in _numbers(spark, base_path, "upto_batch", finished=True) if upto is None or n < upto]
    p = spark.read.parquet(partials_path)
    if upto is not None:
        p = p.where(F.col("batch_id") <= upto)
    if not done:
        return p.drop("batch_id")
    p = p.where(F.col("batch_id") > done[-1]).drop("batch_id")
    return spark.read.parquet(f"{base_path}/upto_batch={done[-1]}").unionByName(p)


def compact(spark: SparkSession, out_root: str, upto_batch: int) -> None:
    """Fold status and hourly partials up to ``upto_batch`` into a new base table each
    (folder ``upto_batch``), so that readers touch one base and the newer partials.
    It starts from an earlier base, so running it again gives the same folder."""
    t = Tables(out_root)
    for path, fold in ((t.status, _fold_status), (t.hourly, _fold_hourly)):
        fold(_base_and_partials(spark, path, upto_batch)).write.mode("overwrite").parquet(
            f"{path}_base/upto_batch={upto_batch}")


def retire(spark: SparkSession, out_root: str, upto_batch: int) -> None:
    """Delete what the base before ``upto_batch`` covers: its partials, older bases and older alert versions.

    That base and all later partials stay, for readers that have just opened them and for a replay of the batch."""
    t = Tables(out_root)
    for path in (t.status, t.hourly):
        before = [n for n in _numbers(spark, f"{path}_base", "upto_batch", finished=True) if n < upto_batch]
        if not before:
            continue
        old = [f"{path}/batch_id={n}" for n in _numbers(spark, path, "batch_id") if n <= before[-1]]
        old += [f"{path}_base/upto_batch={n}" for n in before[:-1]]
        if path == t.status:
            old += [f"{t.alerts}/batch_id={n}" for n in _numbers(spark, t.alerts, "batch_id") if n < before[-1]]
        for x in old:
            _delete(spark, x)


def read_status(spark: SparkSession, out_root: str, cpu_scale: float = 100.0) -> DataFrame:
    s = _fold_status(_base_and_partials(spark, Tables(out_root).status)).drop("copies")
    return s.withColumn("status", classify_status("anomaly_count", F.col("max_cpu") / cpu_scale, "max_memory_mb"))


def read_hourly(spark: SparkSession, out_root: str) -> DataFrame:
    p = _fold_hourly(_base_and_partials(spark, Tables(out_root).hourly))
    return p.select(F.col("hour").cast("timestamp_ntz").alias("timestamp"), "server_id", "log_count",
                    F.round(F.col("errors") / F.col("log_count"), 6).alias("error_rate"),
                    F.lit(None).cast("double").alias("avg_response_time"))


def read_alerts(spark: SparkSession, out_root: str) -> DataFrame:
    v = _latest(spark, Tables(out_root).alerts)
    return v if v is not None else spark.createDataFrame([], ALERTS_SCHEMA)


def health(spark: SparkSession, out_root: str, query=None) -> DataFrame:
    """Pipeline health from the result tables plus the last progress; active once there is an anomaly or a server."""
    a = read_anomalies(spark, out_root).agg(F.count(F.lit(1)).alias("anomalies_count"))
    s = read_status(spark, out_root).agg(F.count(F.lit(1)).alias("servers_count"),
                                         F.max("last_update").cast("timestamp_ntz").alias("last_update"))
    prog = query.lastProgress if query is not None else None
    rows_per_s = float(prog.get("processedRowsPerSecond") or 0.0) if prog else None
    n_anoms = a.first()["anomalies_count"]
    return s.select(F.lit(n_anoms).cast("long").alias("anomalies_count"), "servers_count", "last_update",
                    ((F.col("servers_count") > 0) | F.lit(n_anoms > 0)).alias("active"),
                    F.lit(rows_per_s).cast("double").alias("processed_rows_per_second"))
