"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's features are the hashes of its letter n-grams (with word borders); its
vector is the mean of their embeddings, and a linear softmax gives the
languages' probabilities.  Embeddings and weights are trained together by
stochastic gradient descent in numpy on short passages of a bounded sample;
a temperature and the rejection threshold are calibrated on texts kept apart.
As everything after the lookup is linear, scoring needs one table of
(bucket, language) values.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logsift.llm.common import CHUNK_BYTES, held_out, label_sample

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
DIM = 16
#: Bounds of the training sample.
SAMPLE_ROWS, SAMPLE_CHARS = 600, 6000
PASSAGE = 120
REJECTED = "und"


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    table: bytes  # float32, BUCKETS x languages: embeddings times weights, over the temperature
    bias: tuple[float, ...]
    reject_below: float


def gram_hashes(text: str):
    """Hashes of the n-grams of a text's letters; all else is one border sign."""
    import numpy as np
    import re
    words = re.sub(r"[\W\d_]+", " ", text.lower())
    u = np.frombuffer((" " + words + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out = []
    h = np.zeros(len(u), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h = (h[: len(u) - n + 1] * np.uint64(0x9E3779B97F4A7C15)) ^ u[n - 1:]
        if n in GRAMS and len(h):
            mixed = (h + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((mixed >> np.uint64(49)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def softmax(z):
    import numpy as np
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def passages(text: str) -> list[str]:
    return [text[i:i + PASSAGE] for i in range(0, len(text), PASSAGE)]


def fit(sample: list[tuple[str, str]], epochs: int = 3, rate: float = 20.0, batch: int = 64, seed: int = 1) -> LanguageModel:
    """Train on four fifths of the sample's texts, calibrate on the rest."""
    import numpy as np
    rng = np.random.default_rng(seed)
    langs = tuple(sorted({y for _, y in sample}))
    place = {y: i for i, y in enumerate(langs)}
    rows = [(t, place[y]) for t, y in sample if has_letter(t)]
    rng.shuffle(rows)
    cut = max(1, len(rows) * 4 // 5)
    parts = {i: [] for i in range(len(langs))}
    for t, y in rows[:cut]:
        y = int(y)
        ps = [p for p in passages(t) if has_letter(p)]
        parts[y] += [gram_hashes(ps[i]) for i in rng.permutation(len(ps))[:6]]
    most = max((len(p) for p in parts.values()), default=0)
    data = [(x, y) for y, p in parts.items() for x in p]
    weight = {y: most / max(1, len(p)) for y, p in parts.items()}
    k = max(1, len(langs))
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, k), np.float32), np.zeros(k, np.float32)
    steps, done = max(1, epochs * -(-len(data) // batch)), 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            some = [data[i] for i in order[at:at + batch]]
            ids = np.concatenate([x for x, _ in some])
            sizes = np.array([len(x) for x, _ in some])
            y = np.array([y for _, y in some])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(emb[ids], starts, axis=0) / sizes[:, None]
            p = softmax(mean @ out + bias)
            p[np.arange(len(y)), y] -= 1
            g = p * np.array([weight[int(v)] for v in y])[:, None] / len(y)
            step = rate * (1 - done / steps)
            back = (g @ out.T) / sizes[:, None]
            out -= step * 0.05 * (mean.T @ g)
            bias -= step * 0.05 * g.sum(axis=0)
            np.subtract.at(emb, ids, (step * np.repeat(back, sizes, axis=0)).astype(np.float32))
            done += 1
    table = emb @ out
    rest = rows[cut:] or rows
    logits = np.array([logits_of(t, table, bias) for t, _ in rest]).reshape(len(rest), k)
    y = np.array([int(v) for _, v in rest], dtype=int)
    temps = [0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5, 2.0, 3.0, 5.0]
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in temps]
    temp = temps[int(np.argmin(loss))] if len(rest) else 1.0
    best = softmax(logits / temp).max(axis=1) if len(rest) else np.ones(1)
    # well below what all but one in a thousand known texts reach: only texts unlike any language go
    threshold = float(min(0.4, 0.6 * np.quantile(best, 0.001)))
    return LanguageModel(langs, (table / temp).astype(np.float32).tobytes(), tuple(map(float, bias / temp)), threshold)


def logits_of(text: str, table, bias):
    """Mean over all n-grams of the whole text, taken in pieces of bounded size."""
    import numpy as np
    total, n = np.zeros(table.shape[1]), 0
    for at in range(0, len(text), CHUNK_BYTES):
        h = gram_hashes(text[at:at + CHUNK_BYTES])
        total += np.bincount(h, minlength=BUCKETS).astype(np.float64) @ table if len(h) > 20_000 else table[h].sum(axis=0, dtype=np.float64)
        n += len(h)
    return total / max(1, n) + bias


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """At most SAMPLE_ROWS texts of each language, at most SAMPLE_CHARS characters of each, from rows that may be learned from."""
    free = docs.where(F.col(f"`{id_col}`").isNotNull() & ~held_out(f"`{id_col}`"))
    return label_sample(free, id_col, text_col, lang_col, SAMPLE_ROWS, SAMPLE_CHARS)


def predictions(whole: pa.Array, model: LanguageModel) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and whether the text is rejected, for each text of an Arrow array."""
    import numpy as np
    table, bias = np.frombuffer(model.table, np.float32).reshape(BUCKETS, -1), np.array(model.bias)
    lang, score = [], []
    for t in whole:
        t = t.as_py()
        if t is None or not model.langs or not has_letter(t):
            lang.append(REJECTED)
            score.append(0.0)
            continue
        p = softmax(logits_of(t, table, bias))
        lang.append(model.langs[int(p.argmax())])
        score.append(float(p.max()))
    return lang, score, [y == REJECTED or s < model.reject_below for y, s in zip(lang, score)]


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, one row per input row.

    ``lang_pred`` is the likeliest language of the whole text, ``und`` with score 0
    for null texts and texts without a letter.  ``rejected``: ``und``, or a score
    under the calibrated threshold.  Ids may be null or repeated.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for b in batches:
            lang, score, bad = predictions(b.column(1), model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(bad, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def keep_known_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns unchanged, each row judged by itself; no row moves."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([not x for x in predictions(b.column(at).cast(pa.string()), model)[2]], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
