"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logsift.session import checkpoint_dir, scratch_path

#: Salted sub-groups per key: a key that holds a third of all rows is spread over so many tasks.
RUNS = 64

#: UTF-8 bytes of text that a Python task handles at a time.
CHUNK_BYTES = 4 << 20

#: Passages of a long text in a training sample.
PASSAGES = 12


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared folder, which survive a lost executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """A text column with null counted as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the two columns needed, under private names (other columns cannot clash with them), and ``more``."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"), *more)


def with_run(df: DataFrame, runs: int = RUNS) -> DataFrame:
    """Number the rows and deal them out evenly over salted runs (``_rid``, ``_run``)."""
    return (df.withColumn("_rid", F.monotonically_increasing_id())
            .withColumn("_run", F.pmod(F.col("_rid"), F.lit(runs)).cast("int")))


def spread_join(base: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` joined to ``facts`` (one row per key) without a hot key in one task.

    ``base`` carries ``_run``.  The facts go first to the distinct (run, key)
    pairs, at most one row per run for a key; the rows then meet them on both.
    """
    pairs = base.select("_run", *keys).distinct()
    return base.join(pairs.join(facts, keys), ["_run", *keys])


#: Up to so many rows to drop are broadcast; more are dropped in a join.
BROADCAST_ROWS = 2_000_000
ROW_KEY = ["_file", "_at"]


def in_files(docs: DataFrame) -> DataFrame:
    """``docs`` if they are just a table read from files, else a written copy of them, read again: its rows have fixed places."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        return docs
    path = scratch_path(docs.sparkSession, "rows")
    docs.write.parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)


def row_key(files: DataFrame) -> list[Column]:
    """Columns ROW_KEY of a table read from files: hash of the file's path, and the row's place in the file."""
    place = files.metadataColumn("_metadata")
    return [F.xxhash64(place["file_path"]).alias("_file"), place["row_index"].alias("_at")]


def drop_rows(files: DataFrame, losers: DataFrame) -> DataFrame:
    """The rows of ``files`` (see ``in_files``) whose ROW_KEY is not in ``losers``, all columns unchanged.

    Few losers are broadcast, so that no row moves; beyond a checked number both sides meet in a join."""
    losers = checkpoint(losers.select(*ROW_KEY))
    if losers.count() <= BROADCAST_ROWS:
        losers = F.broadcast(losers)
    rows = files.select(F.struct(*[F.col(f"`{c}`") for c in files.columns]).alias("_row"), *row_key(files))
    return rows.join(losers, ROW_KEY, "left_anti").select("_row.*")


def held_out(id_col: str) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def label_sample(docs: DataFrame, id_col: str, text_col: str, label_col: str, rows_per_label: int,
                 max_chars: int) -> list[tuple[str, str]]:
    """(text, label) of a bounded training sample: per label the ``rows_per_label``
    rows with the smallest id hash among texts that are not empty.

    Every label gets its own top-k, so that each task keeps only that many rows; of a text of more than
    ``max_chars`` characters PASSAGES evenly spaced passages are taken, so
    the sample is at most labels x rows_per_label x max_chars characters.
    """
    from pyspark.sql import Window
    label = F.col(f"`{label_col}`").cast("string")
    docs = docs.where(F.length(text_of(text_col)) > 0)
    # one row per label; rows whose hash is beyond four times the share needed go before anything moves
    counts = {r["label"]: r["n"] for r in docs.select(label.alias("label")).where("label is not null").groupBy("label")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 4.0 * rows_per_label / n)))])
    src = docs.select(text_of(text_col).alias("text"), label.alias("label"), F.xxhash64(F.col(f"`{id_col}`").cast("string")).alias("h"))
    src = src.where(F.col("label").isNotNull() & (F.pmod(F.col("h"), F.lit(1 << 20)) < share[F.col("label")] * (1 << 20)))
    part, size = max_chars // PASSAGES - 1, F.length("text")
    spread = F.concat_ws(" ", *[F.substring("text", F.floor((size - part) * i / (PASSAGES - 1)).cast("int") + 1, F.lit(part)) for i in range(PASSAGES)])
    src = src.withColumn("text", F.when(size > max_chars, spread).otherwise(F.col("text")))
    w = Window.partitionBy("label").orderBy("h", "text")
    rows = src.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= rows_per_label).select("text", "label", "h")
    return [(r["text"], r["label"]) for r in sorted(rows.collect(), key=lambda r: (r["label"], r["h"], r["text"]))]


def byte_groups(values: Iterator[tuple], size, limit: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Group consecutive items until their sizes add up to ``limit`` (one item at least)."""
    group, held = [], 0
    for v in values:
        n = size(v)
        if group and held + n > limit:
            yield group
            group, held = [], 0
        group.append(v)
        held += n
    if group:
        yield group
