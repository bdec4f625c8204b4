"""Toxicity by compression distance: zstandard dictionaries from toxic text and from ordinary text.

A window that compresses better with the toxic dictionary than with
the ordinary one speaks for toxicity; the gain in bytes is compared with
thresholds calibrated on labelled texts that no dictionary was trained on.  A text has windows of two sizes:

* overlapping passages of several words; their dictionaries are trained on passages of the classes' whole sample
  texts, so that phrases of ordinary words count;
* single words, inside a fixed frame that both dictionaries hold, so that a short window's cost is not hidden by the
  overhead of a block; their dictionaries are trained on what is typical of each class: words that occur in
  clearly more different contexts per text of the class than in the other (copies
  share their contexts, so a group of copies counts once).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logsift.llm.common import held_out, texts

#: Bounds of the training sample: rows of each class and characters of a text.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 2000, 4000, 20_000
DICTIONARY_BYTES = 16_384
REMEMBERED = 300_000
THRESHOLD = 0.3
#: Bytes around a window; dictionaries hold their typical words inside them.
OPEN, CLOSE = b"\x02<< ", b" >>\x03"
WORD = re.compile(r"[^\W\d_]+")
#: Passages: words of one, words from one to the next (two are shared, so three words in a row are whole in one), bytes of a dictionary, passages that train it at most.
PASSAGE, STRIDE, PASSAGE_DICTIONARY, PASSAGES = 8, 6, 32_768, 60_000
PASSAGE_GAINS = (2, 4, 6, 8, 10, 12, 15)
RIDGES = (100.0, 30.0, 3.0, 0.05)


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes  # raw dictionary contents
    ordinary: bytes
    words: int  # of a window
    gains: tuple[float, ...]  # thresholds on a window's gain
    weights: tuple[float, ...]  # one for each feature, then the bias
    toxic_passages: bytes = b""  # trained dictionaries
    ordinary_passages: bytes = b""


def passages(words: list[str]) -> list[bytes]:
    """Overlapping passages of a text's words; a short text is one."""
    return [f" {' '.join(words[i:i + PASSAGE])} ".encode("utf-8", "surrogatepass")
            for i in range(0, max(1, len(words) - PASSAGE + STRIDE), STRIDE)] if words else []


def passage_dictionary(sample: list[str], seed: int) -> bytes:
    """Dictionary trained on passages of whole texts, at most PASSAGES of them."""
    import random
    import zstandard as z
    some = [p for t in sample for p in passages(WORD.findall(t.lower()))]
    random.Random(seed).shuffle(some)
    some = some[:PASSAGES]
    try:
        return z.train_dictionary(PASSAGE_DICTIONARY, some, k=64, d=6).as_bytes()
    except (z.ZstdError, ValueError):  # too few passages
        return b"".join(some)[-PASSAGE_DICTIONARY:]


def passage_scorer(m: ToxicityModel):
    """A function from a text's words to the gains of its passages."""
    import zstandard as z
    params = z.ZstdCompressionParameters(
        strategy=z.STRATEGY_BTLAZY2, min_match=4, window_log=18, hash_log=16, chain_log=16, search_log=5, target_length=24,
        format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    if not m.toxic_passages or not m.ordinary_passages:
        return lambda words: []
    toxic, ordinary = (z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d), compression_params=params) for d in (m.toxic_passages, m.ordinary_passages))
    return lambda words: [len(ordinary.compress(p)) - len(toxic.compress(p)) for p in passages(words)]


def compressors(m: ToxicityModel):
    import zstandard as z
    params = z.ZstdCompressionParameters(
        strategy=z.STRATEGY_BTLAZY2, min_match=4, window_log=17, hash_log=14, chain_log=15, search_log=4, target_length=16,
        format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    return [z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=params)
            for d in (m.ordinary, m.toxic)]


def window_scorer(m: ToxicityModel):
    """A function from a text to the gains of its words (the bytes that the toxic
    dictionary saves, less the bytes that it leaves over an empty window) and of its passages."""
    of_passages = passage_scorer(m)
    ordinary, toxic = compressors(m)
    known: dict[str, int] = {}
    least = len(toxic.compress(OPEN + CLOSE))

    def gain(window: str) -> int:
        w = OPEN + window.encode("utf-8", "surrogatepass") + CLOSE
        t = len(toxic.compress(w))
        known[window] = g = len(ordinary.compress(w)) - t - (t - least)
        return g

    def gains(text: str) -> tuple[list[int], list[int]]:
        if len(known) > REMEMBERED:
            known.clear()
        words = WORD.findall(text.lower())
        long = of_passages(words)
        if m.words > 1:
            words = [" ".join(words[i:i + m.words]) for i in range(0, len(words), m.words)]
        return [known[w] if w in known else gain(w) for w in words], long
    return gains


def features(gains: tuple[list[int], list[int]], thresholds) -> list[float]:
    """Log counts of the words and passages that reach each threshold, of the passages that fall as far below, and of all passages."""
    short, long = gains
    at_least = [math.log1p(sum(g >= t for g in short)) for t in thresholds]
    beyond = [math.log1p(sum(s * g >= t for g in long)) for s in (1, -1) for t in PASSAGE_GAINS]
    return [*at_least, *beyond, math.log1p(len(long))]


def score(m: ToxicityModel, x: list[float]) -> float:
    z = m.weights[-1] + sum(w * v for w, v in zip(m.weights, x))
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def contexts(sample: list[str]) -> Counter:
    """Number of different words before each word."""
    seen = set()
    for t in sample:
        w = WORD.findall(t.lower())
        seen.update(zip([None, *w], w))
    return Counter(w for _, w in seen)


def typical(sample: list[str], own: Counter, other: Counter, n_own: int, n_other: int, times: float = 20.0) -> list[bytes]:
    """The words of each text that are typical of its class (one context per 60 texts, ``times`` the other's rate)."""
    good = {w for w, k in own.items() if k >= max(2, n_own // 60) and k / n_own >= times * (other[w] + 0.5) / n_other}
    picked = (" ".join(x for x in WORD.findall(t.lower()) if x in good) for t in sample)
    return [f" {p} ".encode("utf-8", "surrogatepass") for p in picked if p]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained dictionary content; too few or too small samples are taken as they are."""
    import zstandard as z
    whole = b"".join(dict.fromkeys(samples))
    if len(whole) > 2 * size:
        try:
            return z.train_dictionary(size, samples).as_bytes()
        except z.ZstdError:
            pass
    return whole[-size:]


def words_in(samples: list[bytes]) -> list[bytes]:
    return sorted({w for p in samples for w in p.split()})


def framed(words) -> bytes:
    return b"".join(OPEN + w + CLOSE for w in words)[-2 * DICTIONARY_BYTES:] + OPEN + CLOSE


def fit_logistic(x, y, steps: int = 200, ridge=0.05):
    """Weights and bias of a logistic regression with a ridge, of one value or one for each weight (Newton's method)."""
    import numpy as np
    a = np.hstack([np.asarray(x, float), np.ones((len(x), 1))])
    y, w = np.asarray(y, float), np.zeros(a.shape[1])
    ridge = np.broadcast_to(ridge, w.shape)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-6), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def calibrate(x, y, n_words: int) -> tuple[float, ...]:
    """Weights and bias; the ridge on the passages' features, of RIDGES, is the one whose fit to one half of the texts
    makes the fewest errors on the other half (the largest of several), so passages count for as much as they have been seen to tell."""
    import numpy as np
    x, y = np.asarray(x, float), np.asarray(y, float)
    half = np.arange(len(y)) % 2 == 0

    def ridge(r: float):
        return np.r_[np.full(n_words, RIDGES[-1]), np.full(x.shape[1] - n_words, r), RIDGES[-1]]

    def errors(r: float) -> int:
        total = 0
        for part in (half, ~half):
            w = np.array(fit_logistic(x[part], y[part], ridge=ridge(r)))
            p = 1 / (1 + np.exp(-np.clip(x[~part] @ w[:-1] + w[-1], -30, 30)))
            total += int(((p >= THRESHOLD) != (y[~part] == 1)).sum())
        return total

    return fit_logistic(x, y, ridge=ridge(min(RIDGES, key=errors) if len(y) > 1 else RIDGES[0]))


def fit(sample: list[tuple[str, int]], words: int = 1) -> ToxicityModel:
    """Train the dictionaries on two thirds of the sample and calibrate on the rest."""
    part = {0: [], 1: []}
    for t, y in sample:
        part[y].append(t)
    train = {y: ts[: -(-2 * len(ts) // 3)] for y, ts in part.items()}
    seen = {y: contexts(ts) for y, ts in train.items()}
    n = {y: max(1, len(ts)) for y, ts in train.items()}
    toxic = typical(train[1], seen[1], seen[0], n[1], n[0])
    common = dictionary([f" {t.lower()} ".encode("utf-8", "surrogatepass") for t in train[0]], DICTIONARY_BYTES)
    ordinary = typical(train[0], seen[0], seen[1], n[0], n[1])
    usual = framed(w.encode("utf-8", "surrogatepass") for w, _ in seen[0].most_common(1000))
    # what is nearest to the window's own bytes is cheapest to refer to, so the classes' words come last
    m = ToxicityModel(common + dictionary(toxic, 4096) + usual + framed(words_in(toxic)),
                      common + dictionary(ordinary, 4096) + usual + framed(words_in(ordinary)), words, (), (),
                      passage_dictionary(train[1], 1), passage_dictionary(train[0], 2))
    rest = [(t, y) for y, ts in part.items() for t in ts[len(train[y]):]] or sample
    gains_of = window_scorer(m)
    got = [(gains_of(t), y) for t, y in rest]
    thresholds = tuple(float(t) for t in range(1, 10, 2))
    weights = calibrate([features(g, thresholds) for g, _ in got], [y for _, y in got], len(thresholds)) if got else (0.0,) * 20 + (-3.0,)
    return replace(m, gains=thresholds, weights=weights)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> list[tuple[str, int]]:
    """A bounded sample of labelled texts that may be learned from: of each class the ids with
    the smallest hash, at most SAMPLE_TOXIC and SAMPLE_ORDINARY, without texts over SAMPLE_CHARS."""
    free = labels.where(F.col(f"`{id_col}`").isNotNull() & ~held_out(f"`{id_col}`")).select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    picked = None
    for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        some = free.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = some if picked is None else picked.union(some)
    rows = texts(docs, id_col, text_col).where(F.length("text") <= SAMPLE_CHARS).join(
        F.broadcast(picked), "doc_id").select("doc_id", "text", "y").collect()  # at most the sample's rows
    rows.sort(key=lambda r: (str(r["doc_id"])[::-1], r["text"]))
    return [(r["text"], r["y"]) for r in rows]


def score_texts(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and max_gain, one row per input row.

    Every window of the whole text is compressed with both dictionaries.  Null and
    empty texts have no window and get the score of a text without any gain.
    """
    src = texts(docs, id_col, text_col)

    def run(batches):
        gains_of = window_scorer(model)
        for b in batches:
            got = [gains_of(t.as_py()) for t in b.column(1)]
            p = [score(model, features(g, model.gains)) for g in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p, pa.float64()), pa.array([int(x >= threshold) for x in p], pa.int32()),
                 pa.array([max(g, default=0) for g, _ in got], pa.int32())], ["doc_id", "score", "predicted", "max_gain"])

    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id {kind}, score double, predicted int, max_gain int")
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted", "max_gain")
