"""Benchmark decontamination by greedy string tiling.

A test item contaminates a document if tiles, passages of at least ``least``
words that both share, cover enough of the item, in any order.  The seeds are all
runs of ``least`` words of the items, found in the documents by a rolling
hash (Karp-Rabin); a document and an item that share enough seed words are
tiled: the longest matches of words not yet marked are marked first, again and
again, until none of ``least`` words is left.

The items are a query set that meets all documents, in blocks of bounded size, each
broadcast; documents are scanned, never shuffled, and every task holds a bounded
number of bytes of text.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from logsift.llm.common import CHUNK_BYTES, byte_groups, texts

LEAST = 4
COVERAGE = 0.5
#: Characters of items that are broadcast at a time.
BLOCK_CHARS = 8 << 20
NOT_WORD = r"[^\p{L}\p{N}]+"


def tokenise(texts_: pa.Array) -> pa.ListArray:
    """Lower-case words (letters and digits) of each text; edges give empty words, removed by the caller."""
    import pyarrow.compute as pc
    return pc.split_pattern_regex(pc.utf8_lower(texts_), NOT_WORD)


def greedy_tiles(doc, item, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, words), longest first; earlier places first among equals.

    The item's unmarked runs of ``least`` words are a table by hash (here: the
    run itself, so equal hashes are equal words); every unmarked place of the
    document that hits it is extended as far as both sides are unmarked and equal.
    """
    n, m = len(doc), len(item)
    free_d, free_i = [True] * n, [True] * m
    tiles: list[tuple[int, int, int]] = []
    while True:
        seeds = defaultdict(list)
        for j in range(m - least + 1):
            if all(free_i[j:j + least]):
                seeds[tuple(item[j:j + least])].append(j)
        best, found = least, []
        for i in range(n - least + 1):
            if not free_d[i] or doc[i] < 0:
                continue
            for j in seeds.get(tuple(doc[i:i + least]), ()):
                k = 0
                while i + k < n and j + k < m and free_d[i + k] and free_i[j + k] and doc[i + k] == item[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best:
                    found.append((i, j))
        if not found:
            return tiles
        for i, j in found:
            if all(free_d[i:i + best]) and all(free_i[j:j + best]):
                free_d[i:i + best] = free_i[j:j + best] = [False] * best
                tiles.append((i, j, best))


class Items:
    """A block of test items, ready for lookups."""

    def __init__(self, rows: list[tuple], least: int):
        import numpy as np
        words = [[w for w in ws if w] for ws in tokenise(pa.array([t for _, t in rows], pa.string())).to_pylist()]
        self.ids = [i for i, _ in rows]
        self.vocabulary = sorted({w for ws in words for w in ws})
        place = {w: i for i, w in enumerate(self.vocabulary)}
        self.items = [[place[w] for w in ws] for ws in words]
        self.least = [min(least, len(ws)) for ws in words]  # an item shorter than a seed is one tile or none
        self.by_size = {}
        for size in sorted({k for k in self.least if k}):
            keys, owner, at = [], [], []
            for n, ws in enumerate(self.items):
                if self.least[n] == size:
                    h = rolling(np.array(ws, np.int64), size)
                    keys.append(h)
                    owner += [n] * len(h)
                    at += range(len(h))
            keys = np.concatenate(keys)
            order = np.argsort(keys, kind="stable")
            self.by_size[size] = (keys[order], np.array(owner, np.int64)[order], np.array(at, np.int64)[order])


def rolling(codes, size: int):
    """Hash of every run of ``size`` codes (empty if there are fewer)."""
    import numpy as np
    u = codes.astype(np.uint64)
    n = len(u) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + (u[k:k + n] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return h


def shared_items(codes, items: Items, coverage: float):
    """(item number, document places, seed size) of the items whose seeds in the document could reach ``coverage``.

    The items are judged by the seeds that the document holds, each looked up once however often it occurs; the
    places in the document are gathered only for an item that could reach the coverage."""
    import numpy as np
    for size, (keys, owner, at) in items.by_size.items():
        h = rolling(codes, size)
        seen = np.unique(h)
        lo, hi = np.searchsorted(keys, seen, "left"), np.searchsorted(keys, seen, "right")
        counts = hi - lo
        if not counts.any():
            continue
        which = np.repeat(lo, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        which = which[np.argsort(owner[which], kind="stable")]
        own = owner[which]
        first = np.nonzero(np.diff(own, prepend=-1))[0]
        for a, b in zip(first, [*first[1:], len(own)]):
            n = int(own[a])
            # not more words than seeds x size: most items that share a common seed end here
            if (b - a) * size < coverage * len(items.items[n]):
                continue
            covered = np.zeros(len(items.items[n]), bool)
            for k in range(size):
                covered[at[which[a:b]] + k] = True
            if covered.sum() >= coverage * len(covered):
                yield n, np.nonzero(np.isin(h, keys[which[a:b]]))[0], size


def tile_document(codes, items: Items, coverage: float):
    """(item number, words covered, tiles, first place) of every item covered enough."""
    import numpy as np
    known: dict[tuple, tuple] = {}  # items of the same words have the same tiles
    for n, places, size in shared_items(codes, items, coverage):
        item = tuple(items.items[n])
        if item not in known:
            # only words inside seeds can be in tiles: keep their runs, with a sign between runs that equals nothing
            inside = np.unique((places[:, None] + np.arange(size)).ravel())
            cuts = np.nonzero(np.diff(inside) > 1)[0] + 1
            part: list[int] = []
            for run in np.split(codes[inside], cuts):
                part += [*map(int, run), -1]
            tiles = greedy_tiles(part, items.items[n], size)
            known[item] = (sum(k for _, _, k in tiles), len(tiles))
        words, tiles = known[item]
        if words and words >= coverage * len(item):
            yield n, words, tiles, int(places[0])


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The items in blocks of bounded size; items without a word are left out."""
    rows = ((r["doc_id"], r["text"]) for r in texts(benchmark, id_col, text_col).orderBy("doc_id").toLocalIterator())
    return byte_groups(rows, lambda r: len(r[1]), BLOCK_CHARS)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, matched_words, item_words, coverage, n_tiles, first_word): one row for each
    pair of a document and an item of which tiles cover at least ``coverage``.

    Null texts count as empty and match nothing, as does an item without a word.
    Items of fewer than ``least`` words must occur whole.  Repeated rows give
    repeated results; empty tables an empty one.
    """
    src = texts(docs, id_col, text_col)
    spark = src.sparkSession
    id_kind = src.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {id_kind}, item_id {item_kind}, matched_words int, item_words int, coverage double, n_tiles int, first_word int"
    out = None
    for block in item_blocks(benchmark, item_id, item_text):
        items = spark.sparkContext.broadcast(Items(block, least))  # at most BLOCK_CHARS characters, or one item
        found = src.mapInArrow(_scan(items, coverage), schema)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], schema)


def found_in(whole: pa.Array, items: Items, coverage: float, vocabulary: pa.Array):
    """(row, item number, words covered, tiles, first place) for each text of an Arrow array, a bounded number of bytes at a time."""
    import numpy as np
    import pyarrow.compute as pc
    whole = pc.fill_null(whole.cast(pa.string()), "")
    sizes = pc.binary_length(whole).to_pylist()
    for group in byte_groups(iter(enumerate(sizes)), lambda x: x[1], CHUNK_BYTES):
        words = tokenise(whole.slice(group[0][0], len(group)))
        flat = words.flatten()
        codes = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
        for i, (row, _) in enumerate(group):
            own = slice(ends[i], ends[i + 1])
            for hit in tile_document(codes[own][real[own]], items, coverage):
                yield (row, *hit)


def _scan(shared, coverage: float):
    def run(batches):
        items = shared.value
        vocabulary = pa.array(items.vocabulary, pa.string())
        for b in batches:
            rows = []
            for row, n, k, tiles, first in found_in(b.column(1), items, coverage, vocabulary):
                size = len(items.items[n])
                rows.append((row, items.ids[n], k, size, k / size, tiles, first))
            if rows:
                row, *cols = zip(*rows)
                kinds = [None, pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
                names = ["doc_id", "item_id", "matched_words", "item_words", "coverage", "n_tiles", "first_word"]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *[pa.array(c, t) for c, t in zip(cols, kinds)]], names)
    return run


def _clean(shared, coverage: float, at: int):
    def run(batches):
        import numpy as np
        items = shared.value
        vocabulary = pa.array(items.vocabulary, pa.string())
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            for row, *_ in found_in(b.column(at), items, coverage, vocabulary):
                keep[row] = False
            yield b.filter(pa.array(keep))
    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns unchanged, each row judged by itself.

    The blocks of items filter one after another in one scan of the documents; no row moves."""
    at, spark = docs.columns.index(text_col), docs.sparkSession
    out = docs
    for block in item_blocks(benchmark, item_id, item_text):
        items = spark.sparkContext.broadcast(Items(block, least))  # at most BLOCK_CHARS characters, or one item
        out = out.mapInArrow(_clean(items, coverage, at), docs.schema)
    return out
