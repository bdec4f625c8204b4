"""SimHash near-dedup over a byte-position inverted index with count filtering.

Two 64-bit fingerprints with at most 3 differing bits differ in at most 3 of
their 8 bytes: they share at least 5 positional bytes.  Single (position, byte)
postings are far too long at scale, so postings are keyed by four positions at
once.  The four-position sets are those of {0..7} whose XOR is zero (14 sets;
every three positions lie in exactly one of them, and the complement of a set is
a set): wherever the at most 3 differing bytes lie, the complement of the set
that holds them is intact in both fingerprints, so no link is lost.  For every
pair that meets in a posting the shared positional bytes are tallied; pairs with
at least 5 are kept and verified bit by bit.

Equal fingerprints are one node, so copies cost nothing; links between nodes
go through connected components.
"""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logsift.llm.common import ROW_KEY, RUNS, checkpoint, drop_rows, in_files, row_key, spread_join, texts, with_run
from logsift.llm.components import connected_components

BYTES = 8
SHINGLES_AT_ONCE = 1 << 16


def fingerprint_int(text: str, words: int = 3) -> int:
    """SimHash of one text; see ``fingerprints``."""
    import numpy as np
    from xxhash import xxh64_intdigest
    w = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and \x20\x09-\x0D are touched
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        h = np.array([xxh64_intdigest(b" ".join(w[i:i + words]), 42) for i in range(at, min(n, at + SHINGLES_AT_ONCE))],
                     dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, *more: Column) -> DataFrame:
    """doc_id and ``fp`` (the 64 bits as a long) of every whole text, and ``more`` (long columns)."""
    src = texts(docs, id_col, text_col, *more)
    others = src.columns[2:]

    def run(batches):
        import numpy as np
        for b in batches:
            fps = [fingerprint_int(t.as_py(), words) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64), type=pa.int64()), *b.columns[2:]], ["doc_id", "fp", *others])

    kinds = "".join(f", {c} long" for c in others)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long{kinds}")


def position_sets() -> list[tuple[int, ...]]:
    return [s for s in combinations(range(BYTES), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]


def posting_keys(fp: Column) -> Column:
    """One key per position set: the fingerprint with the other bytes cleared, and the set's number."""
    keys = []
    for i, s in enumerate(position_sets()):
        mask = sum(0xFF << (8 * p) for p in s)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(i).cast("byte").alias("pos"), fp.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*keys)


def shared_bytes(x: Column) -> Column:
    """Positional bytes that two fingerprints share, from their XOR."""
    total = F.lit(0)
    for p in range(BYTES):
        total = total + (F.shiftrightunsigned(x, 8 * p).bitwiseAND(F.lit(0xFF)) == 0).cast("int")
    return total


def fingerprint_links(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column ``fp``) within ``max_bits`` differing bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the position sets guarantee every link up to 3 bits")
    posts = nodes.select("fp", F.explode(posting_keys(F.col("fp"))).alias("k")).select("fp", "k.pos", "k.key")
    a, b = posts.withColumnRenamed("fp", "a"), posts.withColumnRenamed("fp", "b")
    x = F.col("a").bitwiseXOR(F.col("b"))
    met = a.join(b, ["pos", "key"]).where((F.col("a") < F.col("b")) & (shared_bytes(x) >= BYTES - max_bits)
                                          & (F.bit_count(x) <= max_bits))
    return met.select("a", "b").distinct()


def grouped(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows`` (see ``fingerprints``) with component_id, and whether the row is ``kept``: the component's first by id (nulls last)."""
    base = checkpoint(with_run(rows))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_rid")
    nodes = checkpoint(base.groupBy("fp").agg(F.min(first).alias("low")))
    roots = connected_components(fingerprint_links(nodes, max_bits))
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = nodes.groupBy("root").agg(F.min("low").alias("best"))
    # a root of many fingerprints is met salted
    salted = nodes.select("fp", "root", F.pmod(F.xxhash64("fp"), F.lit(RUNS)).cast("int").alias("_run"))
    facts = spread_join(salted, lows, ["root"]).select("fp", F.col("best.doc_id").alias("component_id"), F.col("best._rid").alias("_keep_rid"))
    return spread_join(base, facts, ["fp"]).withColumn("kept", F.col("_rid") == F.col("_keep_rid"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                   max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), one row per input row.

    A null text counts as empty; texts without a word have fingerprint zero and
    are linked like any other.  Null ids are no component's id unless all its ids
    are null.  Repeated rows give repeated results; an empty table an empty one.
    """
    return grouped(fingerprints(docs, id_col, text_col, words), max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       max_bits: int = 3) -> DataFrame:
    """Of each component the row with the smallest id (of several, one), all columns unchanged, each row judged by itself."""
    files = in_files(docs)
    rows = grouped(fingerprints(files, id_col, text_col, words, *row_key(files)), max_bits)
    return drop_rows(files, rows.where(~F.col("kept")).select(*ROW_KEY))
