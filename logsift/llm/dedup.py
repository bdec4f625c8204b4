"""Exact dedup by a tree merge of sorted digest runs (DataFrame functions only).

Rows are dealt into runs.  A run holds one row per digest: the best row seen
so far and the number of copies.  In each binomial round, the runs whose
numbers agree after the last ``log2(fan_in)`` bits are dropped exchange their
rows and are merged (Spark sorts both sides of the exchange by digest and merges
equal digests, as the buffer is a struct).  Every level verifies: the 64-bit
digest that orders a run never merges two texts alone, their SHA-256 and byte
length must agree as well.

A group of copies that holds a third of all rows costs one row per task before
each exchange and meets its result salted by run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logsift.llm.common import ROW_KEY, RUNS, checkpoint, drop_rows, in_files, row_key, spread_join, texts, with_run

#: Characters that do not count when texts are compared: \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"

KEYS = ["_digest", "_sha", "_bytes"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """doc_id, n_chars of the whole text, the digest columns of the text without blanks, and ``more``."""
    t = texts(docs, id_col, text_col, *more)
    others = t.columns[2:]
    t = t.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.translate("text", BLANKS, "").alias("norm"), *others)
    return t.select("doc_id", "n_chars", F.xxhash64("norm").alias("_digest"), F.unhex(F.sha2("norm", 256)).alias("_sha"),
                    F.octet_length("norm").alias("_bytes"), *others)


def merge_runs(run_rows: DataFrame, fan_in: int) -> DataFrame:
    """One round: runs i*fan_in .. (i+1)*fan_in-1 become run i."""
    return (run_rows.groupBy(F.floor(F.col("_run") / fan_in).cast("int").alias("_run"), *KEYS)
            .agg(F.min("_best").alias("_best"), F.sum("_size").alias("_size")))


def grouped(rows: DataFrame, runs: int, fan_in: int) -> DataFrame:
    """``rows`` (see ``digests``) with keep_id, group_size and kept."""
    base = checkpoint(with_run(rows, runs))
    best = F.struct((-F.col("n_chars")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "_rid")
    level = base.groupBy("_run", *KEYS).agg(F.min(best).alias("_best"), F.count(F.lit(1)).alias("_size"))
    left = runs
    while left > 1:
        level = merge_runs(level, fan_in)
        left = -(-left // fan_in)
    facts = level.select(*KEYS, F.col("_best.doc_id").alias("keep_id"), F.col("_best._rid").alias("_keep_rid"),
                         F.col("_size").alias("group_size"))
    return spread_join(base, facts, KEYS).withColumn("kept", F.col("_rid") == F.col("_keep_rid"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS,
                fan_in: int = 4) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    The row with the most code points stays, then the smallest doc_id (a null id
    comes last); of fully equal rows exactly one stays.  A null text counts as
    empty, and all texts of blanks only are one group.  Other columns are not
    looked at.  An empty table gives an empty result.
    """
    return grouped(digests(docs, id_col, text_col), runs, fan_in).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("_sha")).alias("text_sha256"), "n_chars")


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS, fan_in: int = 4) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns unchanged, each row judged by itself."""
    files = in_files(docs)
    rows = grouped(digests(files, id_col, text_col, *row_key(files)), runs, fan_in)
    return drop_rows(files, rows.where(~F.col("kept")).select(*ROW_KEY))
