"""BPE encoding and decoding through a table of distinct words.

Documents are dealt into blocks of bounded bytes by a hash.  A block gives its
distinct words with their positions in the block's sorted word list; the words of
all blocks meet by word, where each distinct word is encoded once; the ids go
back to (block, position) and the documents of the block are put together from
them.  Decoding joins the ids of the distinct words with the vocabulary's pieces.

What moves is the texts once, compressed, and, per block, one row per distinct word, not one
per occurrence; a very common word has one row per block.  The words that a
small sample shows to be most common (a bounded number) are encoded beforehand
and broadcast; which words these are changes no result.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logsift.llm.common import texts

BLOCK_BYTES = 40 << 20
MOST_PARTS = 20_000
HEAD_WORDS = 1 << 16
HEAD_WORD_BYTES = 48
#: Chunks of more than one word, or not in lower case, that a task remembers.
REMEMBERED = 80_000
SAMPLE_ROWS = 2000
SAMPLE_CHARS = 20_000
#: Bytes of a text that are split into chunks at a time, and words encoded at a time.
PART_BYTES = 1 << 20
WORDS_AT_ONCE = 1000
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def words_of(chunk: bytes) -> tuple[bytes, ...]:
    """Words of a run of non-blank bytes whose encodings follow one another.

    Blanks (ASCII white space) separate words for the tokenizer whatever stands
    around them.  Closing marks after plain letters are a word of their own, and
    plain letters count in lower case; anything else stays together, as special
    strings and composed characters must.
    """
    core = chunk.rstrip(b".,;:!?")
    if not core.isalpha() or not core.isascii():
        return (chunk,)
    return (core.lower(),) if len(core) == len(chunk) else (core.lower(), chunk[len(core):])


def parts_of(text: bytes):
    """A text in parts of about ``PART_BYTES``, cut at blanks (which no word holds)."""
    at = 0
    while len(text) - at > PART_BYTES:
        cut = BLANK.search(text, at + PART_BYTES)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def distinct_words(whole, skip: dict) -> list[bytes]:
    """Sorted words of an iterable of texts, without those of ``skip``.

    A chunk that is a known word is the only word of itself; only the others are looked into.
    """
    words, chunks = set(), set()
    for t in whole:
        for part in parts_of(t):
            new = set(part.split()).difference(skip).difference(words).difference(chunks)
            if len(chunks) > REMEMBERED:
                chunks.clear()
            for c in new:
                of_chunk = words_of(c)
                words.update(of_chunk)
                if of_chunk[0] != c:
                    chunks.add(c)
    del chunks
    words.difference_update(skip)  # in place: a block has hundreds of thousands of words
    return sorted(words)


class WordIds(dict):
    """Ids of the words of a block.  A chunk that is no word gets the ids of its words, the latest chunks are kept."""

    def __init__(self, *args):
        super().__init__(*args)
        self.recent = {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.recent.get(chunk)
        if ids is None:
            words = words_of(chunk)
            if words[0] == chunk:
                raise KeyError(chunk)
            if len(self.recent) > REMEMBERED:
                self.recent.clear()
            self.recent[chunk] = ids = b"".join([self[w] for w in words])
        return ids


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def id_kind(pieces: list[str]) -> str:
    """Ids travel in two bytes where the vocabulary allows it."""
    return "<u2" if len(pieces) <= 1 << 16 else "<u4"


def encoder(tokenizer_json: str, kind: str):
    """A function from words to their ids as little-endian integers of that kind."""
    import numpy as np
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores already
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(tokenizer_json)
    tok.no_padding()
    tok.no_truncation()

    def encode(words):
        out = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = [w.decode("utf-8", "replace") for w in words[at:at + WORDS_AT_ONCE]]
            out += [np.array(e.ids, dtype=kind).tobytes() for e in tok.encode_batch(some, add_special_tokens=False)]
        return out
    return encode


def pieces_of(tokenizer_json: str) -> list[str]:
    """The id-to-piece table: the piece of every id, as many as the vocabulary has."""
    from tokenizers import Tokenizer
    by_piece = Tokenizer.from_str(tokenizer_json).get_vocab(with_added_tokens=True)
    out = [""] * (1 + max(by_piece.values()))
    for piece, i in by_piece.items():
        out[i] = piece
    return out


def decode(encoded: DataFrame, tokenizer_json: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) for a table of ids (one row per id value): each id meets its
    piece in a join with the vocabulary, and the pieces are put in order again.

    Null or empty ids decode to the empty string.
    """
    spark = encoded.sparkSession
    pieces = spark.createDataFrame(list(enumerate(pieces_of(tokenizer_json))), "id int, piece string")
    rows = encoded.select(F.col(f"`{id_col}`").alias("doc_id"),
                          F.posexplode_outer(F.col(f"`{ids_col}`")).alias("at", "id"))
    met = rows.join(F.broadcast(pieces), "id", "left")  # as many rows as the vocabulary
    parts = met.groupBy("doc_id").agg(F.sort_array(F.collect_list(
        F.when(F.col("piece").isNotNull(), F.struct("at", "piece")))).alias("p"))
    return parts.select("doc_id", F.array_join(F.transform("p", lambda x: x["piece"]), " ").alias("decoded"))


def head_words(docs: DataFrame, rows: int) -> list[bytes]:
    """The most common words of about ``SAMPLE_ROWS`` documents, chosen by hash."""
    from collections import Counter
    step = max(1, rows // SAMPLE_ROWS)
    sample = docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0) & (F.length("text") <= SAMPLE_CHARS))
    seen: Counter = Counter()
    for r in sample.select("text").limit(2 * SAMPLE_ROWS).toLocalIterator():
        for c, n in Counter(r["text"].encode().split()).items():
            seen.update({w: n for w in words_of(c) if len(w) <= HEAD_WORD_BYTES})
    return [w for w, n in seen.most_common(HEAD_WORDS) if n > 1]


def encode_decode(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES, output: str = "digests") -> DataFrame:
    """One row per input row: doc_id, n_tokens and, for ``output``

    * "digests": ids_sha256 (ids as little-endian unsigned 32-bit integers) and
      decoded_sha256 (decoded text in UTF-8), lowercase hex;
    * "full": ids (array of int) and decoded (string).

    A null text counts as empty: no ids, decoded text empty.  Ids may be null or
    repeated.  A single document larger than a block makes a block of its size.
    """
    src = texts(docs, id_col, text_col)
    spark = src.sparkSession
    total = src.agg(F.sum(F.octet_length("text").cast("long")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    blocks = max(1, -(-(total["b"] or 0) // block_bytes))
    # more partitions than blocks: hardly a task gets two of them, however large the input
    parts = min(3 * blocks, MOST_PARTS)
    pieces = pieces_of(tokenizer_json)
    kind = id_kind(pieces)
    head = head_words(src, total["n"])
    # at most HEAD_WORDS words of at most HEAD_WORD_BYTES bytes, and the vocabulary
    known = spark.sparkContext.broadcast(dict(zip(head, encoder(tokenizer_json, kind)(head))))
    vocabulary = spark.sparkContext.broadcast(pieces)
    id_type = src.schema["doc_id"].dataType.simpleString()

    def pack(batches):
        import zstandard
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts_ = pa.array((zip_.compress(t.as_py().encode()) for t in b.column(2)), pa.binary(), size=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts_], ["block", "doc_id", "packed"])

    # the texts travel once, compressed; both uses below read the same exchange
    dealt = (src.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), "doc_id", "text")
             .mapInArrow(pack, f"block long, doc_id {id_type}, packed binary").repartition(parts, "block"))

    def unpack(t: pa.Table):
        import zstandard
        unzip = zstandard.ZstdDecompressor()
        return (unzip.decompress(x.as_py()) for x in t.column("packed"))

    def list_words(t: pa.Table) -> pa.Table:
        give_back()
        words = distinct_words(unpack(t), known.value)
        n = len(words)
        return pa.table({"block": pa.array([t.column("block")[0].as_py()] * n, pa.int64()),
                         "at": pa.array(range(n), pa.int32()), "word": pa.array(words, pa.binary())})

    def encode_sorted(batches):
        enc, last, ids = encoder(tokenizer_json, kind), None, None
        for b in batches:
            col = b.column(2).to_pylist()
            new = [w for i, w in enumerate(col) if w != (col[i - 1] if i else last)]
            got = dict(zip(new, enc(new)))
            if last is not None:
                got.setdefault(last, ids)
            out = [got[w] for w in col]
            last, ids = (col[-1], out[-1]) if col else (last, ids)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["block", "at", "ids"])
        del enc
        give_back()

    listed = dealt.groupBy("block").applyInArrow(list_words, "block long, at int, word binary")
    encoded = (listed.repartition(parts, "word").sortWithinPartitions("word")
               .mapInArrow(encode_sorted, "block long, at int, ids binary"))
    full = output == "full"

    def put_together(doc: pa.Table, words: pa.Table) -> pa.Table:
        import gc
        import hashlib
        import numpy as np
        give_back()
        gc.disable()  # millions of small objects without cycles
        pieces, common = vocabulary.value, known.value
        mine = distinct_words(unpack(doc), common)
        if words.num_rows != len(mine):
            raise ValueError("a block's words and their ids differ in number")
        ids_of = words.column("ids").combine_chunks().take(pa.array(np.argsort(words.column("at").to_numpy()))) if mine else []
        table = WordIds(zip(mine, (x.as_py() for x in ids_of)))
        table.update(common)
        del mine, ids_of, words

        n, a, b = [], [], []
        for t in unpack(doc):
            ids_of_text, texts_of_parts, count = [], [], 0
            ids_hash, text_hash = hashlib.sha256(), hashlib.sha256()
            for part in parts_of(t):
                ids = np.frombuffer(b"".join(map(table.__getitem__, part.split())), kind)
                if not len(ids):
                    continue
                text = " ".join(map(pieces.__getitem__, ids.tolist()))
                if full:
                    ids_of_text.append(ids.astype(np.int32))
                    texts_of_parts.append(text)
                else:
                    ids_hash.update(ids.astype("<u4").tobytes())
                    text_hash.update((" " + text if count else text).encode())
                count += len(ids)
            n.append(count)
            a.append(np.concatenate([np.zeros(0, np.int32), *ids_of_text]) if full else ids_hash.hexdigest())
            b.append(" ".join(texts_of_parts) if full else text_hash.hexdigest())
        gc.enable()
        list_kind = pa.list_(pa.int32()) if full else pa.string()
        return pa.table([doc.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, list_kind), pa.array(b, pa.string())],
                        names=names)

    names = ["doc_id", "n_tokens"] + (["ids", "decoded"] if full else ["ids_sha256", "decoded_sha256"])
    kinds = [id_type, "long", "array<int>" if full else "string", "string"]
    return (dealt.groupBy("block").cogroup(encoded.groupBy("block"))
            .applyInArrow(put_together, ", ".join(f"{a} {b}" for a, b in zip(names, kinds))))
