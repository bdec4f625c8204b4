"""WARC archives: written with payload dedup, read back by boundary-chain verification.

Writing.  One aggregate per payload digest finds the response, which alone keeps
its payload (copies are combined before the exchange); all other pages become
revisit records.  The text writer ends each record with the two line ends that
WARC asks for.

Reading.  The archives are split at the version line, so that any task can read any
part of a file.  Every hit is only a candidate: it has a byte offset, and its
Content-Length gives the offset of its successor.  Runs of candidates that follow one another are
taken as one; starting from the file's first byte, pointer jumping doubles the
known part of the chain of runs in each round; hits off the chain stand inside
payloads and are rejected.  Payloads are digested in the
first scan; only records whose payload holds the version line are put together
from their pieces in a second one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from logsift.llm.common import checkpoint, spread_join, text_of
from logsift.session import scratch_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
RECORDS_PER_FILE = 20_000
#: Digits 0-9A-V of base conversion, and the letters of RFC 4648 for them (fixed values).
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 hex digits as 8 groups of 20 bits, 4 letters each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), BASE32_DIGITS, BASE32_LETTERS)


def _recode(df: DataFrame, kind: str, pack: bool) -> DataFrame:
    """The ``payload`` column compressed (binary) or plain again (string), in bounded batches."""
    def run(batches):
        import zstandard
        zip_, unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for b in batches:
            at = b.schema.get_field_index("payload")
            old = b.column(at)
            new = (pa.array((zip_.compress(x.as_py().encode()) for x in old), pa.binary(), size=len(old)) if pack else
                   pa.array((unzip.decompress(x.as_py()).decode() for x in old), pa.string(), size=len(old)))
            yield pa.RecordBatch.from_arrays([new if i == at else b.column(i) for i in range(b.num_columns)], b.schema.names)

    schema = ", ".join(f"`{n}` {kind if n == 'payload' else t}" for n, t in df.dtypes)
    return df.mapInArrow(run, schema)


def packed(df: DataFrame) -> DataFrame:
    return _recode(df, "binary", True)


def unpacked(df: DataFrame) -> DataFrame:
    return _recode(df, "string", False)


def record_lines(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                 min_bytes: int = 0) -> DataFrame:
    """``value``: the text of one WARC record per page, without the two closing line ends.

    Of pages with equal payloads of at least ``min_bytes`` bytes the largest id
    (then url; null ids are smallest) is the response, the others are revisits.
    Rows equal in id, url and payload are counted: one of them can be a response.
    """
    src = pages.select(F.col(f"`{id_col}`").cast("string").alias("name"), F.col(f"`{id_col}`").alias("id"),
                       F.regexp_replace(text_of(url_col), "[\\x00-\\x20]+", "%20").alias("url"),
                       text_of(payload_col).alias("payload"))
    size = F.octet_length("payload")
    # payloads below min_bytes are no copies of each other: their pages are keys of their own
    own = F.when(size < min_bytes, F.sha2(F.to_json(F.struct("id", "url")), 256))
    src = src.withColumns({"sha": F.unhex(F.sha2("payload", 256)), "own": own})
    top = F.struct("id", "url", "name", "payload")
    # payloads travel compressed; copies are combined before the exchange
    responses = unpacked(packed(src.select("sha", "own", "id", "url", "name", "payload")).groupBy("sha", "own")
                         .agg(F.max(top).alias("t")).select("sha", "own", "t.*")).withColumns(
        {"digest": base32_sha1(F.col("payload")), "size": size})

    rows = (src.groupBy("sha", "own", "id", "name", "url").agg(F.count(F.lit(1)).alias("n"), F.first(size).alias("size"),
                                                        F.first(base32_sha1(F.col("payload"))).alias("digest"))
            .withColumn("_run", F.pmod(F.xxhash64("name", "url"), F.lit(64)).cast("int"))
            .withColumn("key", F.xxhash64("sha", "own")))
    tops = rows.groupBy("key", "sha").agg(F.max(F.struct("id", "url", "name")).alias("top"))
    rows = spread_join(rows, tops, ["key", "sha"])
    is_top = F.col("id").eqNullSafe(F.col("top.id")) & (F.col("url") == F.col("top.url"))
    copies = F.when(F.col("size") >= min_bytes, F.col("n") - is_top.cast("long")).otherwise(F.lit(0))
    again = rows.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))

    def head(kind, name, length, extra):
        line = [F.lit(f"{MAGIC}WARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:"), F.coalesce(name, F.lit("")),
                F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.col("url"),
                F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), *extra,
                F.lit("\r\nContent-Length: "), length.cast("string"), F.lit(END)]
        return F.concat(*line)

    http = F.lit(HTTP_HEAD + END)
    kept = responses.select(F.concat(
        head("response", F.col("name"), F.col("size") + len(HTTP_HEAD + END),
             [F.lit("\r\nContent-Type: application/http; msgtype=response")]), http, F.col("payload")).alias("value"))
    extra = [F.lit("\r\nWARC-Refers-To: <urn:page:"), F.coalesce(F.col("top.name"), F.lit("")), F.lit(">")]
    copied = again.select(head("revisit", F.col("name"), F.lit(0), extra).alias("value"))
    small = F.col("size") < min_bytes
    if min_bytes > 0:  # further copies of one row below the bound are responses of their own
        more = rows.where(small & (F.col("n") > 1)).withColumn("copy", F.explode(F.sequence(F.lit(2).cast("long"), F.col("n"))))
        more = more.select("sha", "own", "copy").join(responses.where(small), ["sha", "own"])
        kept = kept.union(more.select(F.concat(
            head("response", F.col("name"), F.col("size") + len(HTTP_HEAD + END),
                 [F.lit("\r\nContent-Type: application/http; msgtype=response")]), http, F.col("payload"))))
    return kept.union(copied)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE,
                   compression: str = "none") -> str:
    """Write WARC files into the folder ``path``; see ``record_lines``.

    ``compression``: "none" (files can be split anywhere) or "gzip" (about a third of
    the size; a file is read by one task, so ``records_per_file`` bounds its work).
    Offsets always count plain bytes.
    """
    (record_lines(pages, id_col, url_col, payload_col, min_bytes).write.mode("errorifexists")
     .option("lineSep", END).option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path))
    return path


def header_field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, f"(?i)(?:^|\\r\\n){name}:[\\x20\\t]*([^\\r\\n]*)", 1)


def with_offsets(pieces: DataFrame) -> DataFrame:
    """Byte offset of the version line before each piece (negative: the piece before the file's first).

    Files are of bounded size, so a window over one file's narrow rows is bounded.
    """
    w = Window.partitionBy("file").orderBy("part", "at").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("off", F.coalesce(F.sum(F.col("bytes") + len(MAGIC)).over(w), F.lit(0)) - len(MAGIC))


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every version line: file (hash of its path), part (split start), at (order), bytes, value."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("at"), F.octet_length("value").cast("long").alias("bytes"), "value")


def payload_of(block: Column, http_head: Column) -> Column:
    """The payload of a record's block (bytes): what follows the HTTP head, if it has one."""
    http = F.octet_length(F.substring_index(block.cast("string"), END, 1)) + len(END)
    return F.when(http_head, F.substr(block, http + 1)).otherwise(block)


def reached(links: DataFrame) -> DataFrame:
    """(file, off) of the nodes on the chain from offset 0; ``links``: file, off, next.

    After round k, ``next`` is 2^k nodes ahead and the first 2^k nodes are seen.
    """
    per_file = links.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    most = per_file.agg(F.max("n")).first()[0] or 0
    state = links.select("file", "off", "next", (F.col("off") == 0).alias("seen"))
    for _ in range(max(0, most - 1).bit_length()):
        ahead = state.select("file", F.col("off").alias("next"), F.col("next").alias("after"))
        met = state.join(ahead, ["file", "next"], "left")
        rows = met.select("file", F.explode(F.array(
            F.struct("off", F.col("after").alias("next"), "seen", F.lit(True).alias("real")),
            F.struct(F.col("next").alias("off"), F.lit(None).cast("long").alias("next"), "seen", F.lit(False).alias("real"))
        )).alias("r")).select("file", "r.*").where(F.col("real") | (F.col("seen") & F.col("off").isNotNull()))
        state = checkpoint(rows.groupBy("file", "off").agg(F.max("next").alias("next"), F.max("seen").alias("seen"),
                                                    F.max("real").alias("real")).where("real").drop("real"))
    return state.where("seen").select("file", "off")


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, off) of the candidates on the chain from offset 0; ``candidates``: file, off, next.

    Candidates of which each is the other's successor form a run: who enters a run
    leaves it at its end.  Pointer jumping goes over runs, one per file where no
    payload holds a version line; a run is entered once, as offsets only grow.
    """
    w = Window.partitionBy("file").orderBy("off")
    here = candidates.select("file", "off", "next", F.coalesce(F.lag("next").over(w) != F.col("off"), F.lit(True)).alias("first"))
    here = checkpoint(here.withColumn("run", F.last(F.when(F.col("first"), F.col("off")), ignorenulls=True).over(w)).drop("first"))
    runs = here.groupBy("file", "run").agg(F.max_by("next", "off").alias("exit"))
    entered = here.select("file", F.col("off").alias("exit"), F.col("run").alias("to"))
    links = checkpoint(runs.join(entered, ["file", "exit"], "left"))
    on = reached(links.select("file", F.col("run").alias("off"), F.col("to").alias("next"))).withColumnRenamed("off", "run")
    entries = (links.where(F.col("to").isNotNull()).join(on, ["file", "run"])
               .select("file", F.col("to").alias("run"), F.col("exit").alias("entry")))
    entries = entries.union(on.where(F.col("run") == 0).select("file", "run", F.lit(0).cast("long")))
    return here.join(entries, ["file", "run"]).where(F.col("off") >= F.col("entry")).select("file", "off")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record on the chain: file, off, type, name, refers, digest, size (payload bytes).

    Digest and size are computed from the payload that was read; for revisits
    they are null.  Bytes after a break of the chain (a damaged record) are not read.
    """
    head = F.substring_index("value", END, 1)
    bytes_ = F.col("value").cast("binary")
    cut = pieces_of(spark, path).withColumn("head", F.when(F.contains("value", F.lit(END)), head))
    length = header_field(F.col("head"), "Content-Length")
    cut = cut.withColumns({"length": F.when(length.rlike("^[0-9]{1,18}$"), length.cast("long")),
                           "start": F.octet_length("head").cast("long") + len(END)})
    whole = F.col("start") + F.col("length") <= F.col("bytes")
    block = F.when(whole, F.substr(bytes_, (F.col("start") + 1).cast("int"), F.col("length").cast("int")))
    cut = cut.withColumn("payload", payload_of(block, header_field(F.col("head"), "Content-Type").startswith("application/http")))
    narrow = cut.select(
        "file", "part", "at", "bytes", "length", "start", header_field(F.col("head"), "WARC-Type").alias("type"),
        F.regexp_extract(header_field(F.col("head"), "WARC-Record-ID"), "<urn:page:(.*)>", 1).alias("name"),
        F.regexp_extract(header_field(F.col("head"), "WARC-Refers-To"), "<urn:page:(.*)>", 1).alias("refers"),
        header_field(F.col("head"), "Content-Type").startswith("application/http").alias("http"),
        F.when(F.col("type") == "revisit", F.regexp_replace(header_field(F.col("head"), "WARC-Payload-Digest"), "^sha1:", ""))
        .otherwise(base32_sha1(F.col("payload"))).alias("digest"), F.octet_length("payload").cast("long").alias("size"), whole.alias("whole"))
    placed = with_offsets(narrow)
    candidates = checkpoint(placed.where((F.col("off") >= 0) & F.col("length").isNotNull()).drop("part", "at", "bytes")
                            .withColumn("next", F.col("off") + len(MAGIC) + F.col("start") + F.col("length") + len(END)))
    chain = candidates.join(reachable(candidates), ["file", "off"], "left_semi")
    good = chain.where("whole").select("file", "off", "type", "name", "refers", "digest", "size")
    broken = checkpoint(chain.where(~F.col("whole")).select("file", "off", "next", "length", "start", "type", "name", "refers", "http"))
    if not broken.take(1):
        return good
    files = broken.select("file").distinct()
    parts = with_offsets(pieces_of(spark, path).join(files, "file", "left_semi")).select("file", F.col("off").alias("piece"), "value")
    # a piece belongs to the last chain record that starts at or before it
    marks = chain.select("file", F.col("off").alias("piece"), F.lit(None).cast("string").alias("value"), F.col("off").alias("owner"))
    w = Window.partitionBy("file").orderBy("piece", F.col("owner").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    owned = (parts.withColumn("owner", F.lit(None).cast("long")).unionByName(marks)
             .withColumn("owner", F.last("owner", ignorenulls=True).over(w)).where(F.col("value").isNotNull()))
    owned = owned.join(broken.withColumnRenamed("off", "owner"), ["file", "owner"]).where(F.col("piece") < F.col("next"))
    full = owned.groupBy("file", F.col("owner").alias("off"), "length", "start", "type", "name", "refers", "http").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "value"))), lambda x: x["value"]), MAGIC).alias("text"))
    block = F.substr(F.col("text").cast("binary"), (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    full = full.withColumn("payload", payload_of(block, F.col("http")))
    return good.union(full.select("file", "off", "type", "name", "refers", base32_sha1(F.col("payload")).alias("digest"),
                                  F.octet_length("payload").cast("long").alias("size")))


def warc_round_trip(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                    payload_col: str = "html", min_bytes: int = 0, compression: str = "gzip") -> DataFrame:
    """Write the pages as WARC files, read them back and give one row per page:
    the id, payload_bytes, payload_digest, record_type and refers_to.

    A null payload counts as empty; null ids come back as null; a revisit's
    payload_bytes are those of the response that it refers to.  An empty table
    gives an empty result.
    """
    spark = pages.sparkSession
    id_type = pages.schema[id_col].dataType.simpleString()
    path = write_archives(pages, path or scratch_path(spark, "warc"), id_col, url_col, payload_col, min_bytes,
                          compression=compression)
    records = checkpoint(read_archives(spark, path))
    named = lambda c: F.when(F.col(c) != "", F.col(c)).cast(id_type)
    answers = records.where(F.col("type") == "response").groupBy("digest").agg(F.max("size").alias("full"))
    again = records.where(F.col("type") == "revisit").withColumn("_run", F.pmod(F.xxhash64("name"), F.lit(64)).cast("int"))
    again = spread_join(again, answers, ["digest"])
    out = [F.col("digest").alias("payload_digest"), F.col("type").alias("record_type")]
    return (records.where(F.col("type") == "response")
            .select(named("name").alias(id_col), F.col("size").alias("payload_bytes"), *out, F.lit(None).cast(id_type).alias("refers_to"))
            .union(again.select(named("name"), "full", *out, named("refers"))))
