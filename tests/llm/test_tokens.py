import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from logsift.llm import bpe, token_counts
from logsift.llm.queries import tokenizer_file

PIECES = ["a", "Th", "E", " ", "  ", "\n", "\t", ".", ",", "é", "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "'s", "'re", "日本", "😀",
          "x.y", "́", "\x1c", "\x85", "the", "!!", "12", "²", "ΑΣ", "<s>", "▁", "<0x0A>", "　", "\xa0", "<unk>", "word"]
SCHEMA = "doc_id long, text string, block long, n_tokens string"


def sample_texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    return [None, "", " ", "   ", "\n", "x" * 30_000, "long word " * 20_000, "same", "same"] + made


def frame(spark, texts):
    return spark.createDataFrame([(i // 2 if i % 7 else None, t, 1, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3)


def key(rows):
    return sorted(map(str, rows))


def test_counts_equal_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    df = frame(spark, sample_texts())
    want = [(r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or "")), len(sp.encode(r.text or "")) > 50) for r in df.collect()]
    got = token_counts.token_counts(df, tokenizer_file("piece_bpe_32k.model"), limit=50)
    assert key(tuple(r) for r in got.collect()) == key(want)
    assert token_counts.token_counts(df.limit(0), tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_safe_parts_fuzz():
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(9)
    for _ in range(4000):
        t = "".join(rng.choice(PIECES + [" "] * 6) for _ in range(rng.randint(0, 12)))
        assert sum(map(len, sp.encode(token_counts.safe_parts(t)) if token_counts.safe_parts(t) else [])) == len(sp.encode(t)), repr(t)


def test_encode_decode_equals_the_library_over_many_blocks(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    df = frame(spark, sample_texts())
    want, full = [], []
    for r in df.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        full.append((r.doc_id, len(ids), ids, text))
    json = tokenizer_file("word_bpe_49k.json").decode()
    assert key(tuple(r) for r in bpe.encode_decode(df, json, block_bytes=40_000).collect()) == key(want)
    assert key(tuple(r) for r in bpe.encode_decode(df, json, output="full").collect()) == key(full)
    assert bpe.encode_decode(df.limit(0), json).count() == 0


def test_decode_join(spark):
    json = tokenizer_file("word_bpe_49k.json").decode()
    tok = Tokenizer.from_str(json)
    ids = tok.encode("Hello there, the 12 <|endoftext|> worlds", add_special_tokens=False).ids
    df = spark.createDataFrame([(1, ids), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(df, json).collect()} == {1: tok.decode(ids, skip_special_tokens=False), 2: "", 3: ""}


def test_parts_of_a_text_lose_nothing(monkeypatch):
    from logsift.llm import bpe
    monkeypatch.setattr(bpe, "PART_BYTES", 7)
    for t in (b"", b" ", b"one", b"a b c d e f g h i", b"averyveryverylongword and more", b"tail blank   \t\n", b"x" * 50):
        parts = list(bpe.parts_of(t))
        assert [w for p in parts for w in p.split()] == t.split()
        assert all(len(p) <= 7 + max(map(len, t.split()), default=0) for p in parts[:-1])


def test_the_words_of_a_pipeline_block_take_bounded_memory():
    import tracemalloc
    import corpus_pipeline
    from logsift.llm import bpe
    size = getattr(corpus_pipeline, "ENCODING_BLOCK", bpe.BLOCK_BYTES)
    skip = {b"common": b""}
    text = b"%08d " + b"common " * 7
    texts = [b"".join(text % i for i in range(at, at + 1000)) for at in range(0, size // 58, 1000)]
    tracemalloc.start()
    words = bpe.distinct_words(iter(texts), skip)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words) == 1000 * len(texts) and words == sorted(set(words)) and peak < 60e6
