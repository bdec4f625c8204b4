"""Hard-negative mining by a secondary-sort shuffle.

Anchors are a stated query set that meets all rows, block by block: a task holds one block of
rows and one block of anchors and scores them as one matrix product.  Pairs are
packed into byte keys (anchor, descending score, positive before negative, id) and
go through ``repartitionAndSortWithinPartitions``; an iterator then reads each anchor's pairs
in order, opens a window at each of its first positives and gives every negative
that follows to the windows it fits, holding no more than these windows.

Before the shuffle each block drops, exactly, what cannot be asked for: it keeps its
best positives of each anchor and, once the positives are known, the first negatives
of each window.  So no anchor brings all its pairs, however many rows there are.
"""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logsift.llm.common import checkpoint

#: Rows and anchors that one task scores at a time; matrices hold at most ROWS x STEP scores.
ROWS, ANCHORS, STEP = 8192, 4096, 256
#: anchor row, anchor id, score (descending), kind, id, row; big-endian, so that bytes sort as the numbers do
KEY = ">QQQBQQ"
SIGN, TOP = 1 << 63, (1 << 63) - 1
POSITIVE, NEGATIVE = 0, 1


def prepared(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """rid, id, label (as text), vec (floor(scale * x) as longs) of the rows that take part."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    src = rows.where(F.col(f"`{label_col}`").isNotNull() & v.isNotNull() & whole)
    return src.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("long").alias("id"),
                      F.col(f"`{label_col}`").cast("string").alias("label"),
                      F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("vec"))


def matrix(vectors: pa.ChunkedArray, width: int):
    """Vectors as rows of a matrix; missing components are 0."""
    import numpy as np
    vectors = vectors.combine_chunks()
    flat, ends = vectors.flatten().to_numpy(), np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy())])
    out = np.zeros((len(vectors), width), np.int64)
    for i in range(len(vectors)):
        out[i, : ends[i + 1] - ends[i]] = flat[ends[i]:ends[i + 1]]
    return out


def products(a, b):
    """Exact inner products of the rows of ``a`` and ``b`` as longs; sums beyond a long count as its ends."""
    import numpy as np
    most = lambda m: int(max(m.max(initial=0), -int(m.min(initial=0))))
    if most(a) * most(b) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    full = a.astype(object) @ b.astype(object).T
    return np.clip(full, -SIGN, TOP).astype(np.int64)


def ordered_codes(scores):
    """One code for each score and place, so that larger is earlier: the higher score, then the earlier place."""
    import numpy as np
    bits = max(1, int(scores.shape[1] - 1).bit_length())
    back = np.arange(scores.shape[1])[::-1]
    if len(scores) and max(int(scores.max(initial=0)), -int(scores.min(initial=0))) >= 1 << (62 - bits):
        scores = np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
    return (scores.astype(np.int64) << bits) | back


def first_places(codes, mask, k: int):
    """(row, place) of the first ``k`` masked codes of every row."""
    import numpy as np
    none = np.iinfo(np.int64).min
    held = np.where(mask, codes, none)
    places = np.argpartition(held, max(0, held.shape[1] - k), axis=1)[:, -k:] if held.shape[1] > k else np.tile(np.arange(held.shape[1]), (len(held), 1))
    row = np.repeat(np.arange(len(held)), places.shape[1])
    places = places.ravel()
    real = held[row, places] != none
    return row[real], places[real]


def block_pairs(kind: int, per_window: int, num: int, den: int):
    """Function of (block of rows, block of anchors): the pairs that may be asked for."""
    names = ["a_rid", "a_id", "score", "kind", "id", "rid"]

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        import numpy as np
        import pyarrow.compute as pc
        empty = pa.table({n: pa.array([], pa.int64()) for n in names})
        if not len(rows) or not len(anchors):
            return empty
        rows = rows.sort_by([("id", "ascending"), ("rid", "ascending")])  # nulls last
        labels = pc.dictionary_encode(pa.chunked_array([*rows["label"].chunks, *anchors["label"].chunks])).combine_chunks().indices.to_numpy()
        y, ya = labels[:len(rows)], labels[len(rows):]
        width = max(pc.max(pc.list_value_length(t["vec"])).as_py() for t in (rows, anchors))
        vec, avec = matrix(rows["vec"], width), matrix(anchors["vec"], width)
        rid, arid = rows["rid"].to_numpy(), anchors["rid"].to_numpy()
        windows = anchors["windows"].to_pylist() if kind == NEGATIVE else None
        parts = []
        for at in range(0, len(anchors), STEP):
            cut = slice(at, at + STEP)
            score = products(avec[cut], vec)
            codes = ordered_codes(score)
            same = ya[cut][:, None] == y[None, :]
            if kind == POSITIVE:
                found = [first_places(codes, same & (arid[cut][:, None] != rid[None, :]), per_window)]
            else:
                found = []
                for w in range(max((len(x) for x in windows[cut]), default=0)):
                    hi = np.array([x[w] if w < len(x) else -SIGN for x in windows[cut]], np.int64)
                    lo = np.array([-(-num * x[w] // den) if w < len(x) else TOP for x in windows[cut]], dtype=object)
                    lo = np.clip(lo, -SIGN, TOP).astype(np.int64)
                    found.append(first_places(codes, ~same & (score >= lo[:, None]) & (score <= hi[:, None]), per_window))
            pairs = np.unique(np.concatenate([np.stack(f, axis=1) for f in found]), axis=0) if found else np.zeros((0, 2), int)
            a, r = pairs[:, 0], pairs[:, 1]
            parts.append(pa.table([pa.array(arid[cut][a]), anchors["id"].take(pa.array(a + at)), pa.array(score[a, r]),
                                   pa.array(np.full(len(a), kind, np.int64)), rows["id"].take(pa.array(r)), pa.array(rid[r])], names))
        return pa.concat_tables(parts)

    return run


def scored(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, kind: int, per_window: int, num: int, den: int) -> DataFrame:
    """Pairs of all rows and all anchors, one task for each block of rows and block of anchors."""
    row_blocks, anchor_blocks = -(-n_rows // ROWS), -(-n_anchors // ANCHORS)
    blocks = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    r = rows.select("rid", "id", "label", "vec", blocks(row_blocks).alias("rb"), every(anchor_blocks).alias("ab"))
    own = [F.col(c).alias(c) for c in anchors.columns]  # under new expression ids: both sides come from one table
    a = anchors.select(*own).withColumn("ab", blocks(anchor_blocks)).withColumn("rb", every(row_blocks))
    kinds = "a_rid long, a_id long, score long, kind long, id long, rid long"
    return r.groupBy("rb", "ab").cogroup(a.groupBy("rb", "ab")).applyInArrow(block_pairs(kind, per_window, num, den), kinds)


def pack(a_rid: int, a_id: int | None, score: int, kind: int, id_: int | None, rid: int) -> bytes:
    """Key of a pair; a null id counts as the largest."""
    return struct.pack(KEY, a_rid, (TOP if a_id is None else a_id) + SIGN, TOP - score, kind, (TOP if id_ is None else id_) + SIGN, rid)


def mined(pairs, positives: int, negatives: int, num: int, den: int):
    """(anchor, positive, rank, negative, positive score, negative score) from keys in order."""
    anchor, windows = None, []
    for key, _ in pairs:
        a_rid, a_id, score, kind, id_, _ = struct.unpack(KEY, key)
        if a_rid != anchor:
            anchor, windows = a_rid, []
        score = TOP - score
        if kind == POSITIVE:
            if len(windows) < positives:
                windows.append([id_ - SIGN, score, 0])
            continue
        for w in windows:
            if w[2] < negatives and num * w[1] <= den * score <= den * w[1]:
                w[2] += 1
                yield (a_id - SIGN, w[0], w[2], id_ - SIGN, w[1], score)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", anchor_every: int = 100,
                   positives: int = 5, negatives: int = 5, num: int = 80, den: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``anchor_every`` divides; a score is the inner product of the
    components floor(scale * x).  An anchor's positives are its first ``positives`` other rows of the same
    label, by higher score, then smaller id.  For each, its first ``negatives`` rows of another label
    with num * positive score <= den * negative score <= den * positive score, ranked from 1.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A null id
    is no anchor and comes last among equal scores (it is shown as the largest long); rows that repeat an id count each by itself, a repeated anchor
    is mined each time, and its copy is one of its other rows.  Of vectors of different lengths the missing components count as 0;
    components and sums beyond a long count as its ends.  Other columns are not looked at; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    src = checkpoint(prepared(rows, id_col, vec_col, label_col, scale))
    is_anchor = F.col("id") % anchor_every == 0
    n_rows, n_anchors = src.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    if not n_anchors:
        return spark.createDataFrame([], out)
    anchors = src.where(is_anchor)
    near = scored(src, anchors, n_rows, n_anchors, POSITIVE, positives, num, den)
    order = Window.partitionBy("a_rid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "rid")
    near = checkpoint(near.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= positives).drop("rn"))
    opened = near.groupBy(F.col("a_rid").alias("rid")).agg(F.collect_set("score").alias("windows"))
    far = scored(src, anchors.join(opened, "rid"), n_rows, n_anchors, NEGATIVE, negatives, num, den)
    keys = near.union(far).rdd.map(lambda r: (pack(*r), None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_pairs = keys.repartitionAndSortWithinPartitions(parts, lambda k: zlib.crc32(k[:8]))
    return spark.createDataFrame(sorted_pairs.mapPartitions(lambda it: mined(it, positives, negatives, num, den)), out, verifySchema=False)
