"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions.

The network is trained in numpy from labelled spans: the patterns' own finds in a
bounded sample, and the same finds written in ways that the patterns miss (blanks or commas inside an address, other
separators in numbers), as a network taught by the patterns' finds alone could only repeat them.  Texts are read in overlapping windows; each is decoded by
Viterbi, and the windows are reconciled over the whole text: a character takes
its tag from the window in which it stands farthest from an edge.  All labelled
kinds hold a digit or an @, so windows without either are not run.
Spans of the network that touch no pattern's span are added to the patterns'.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logsift.llm.common import CHUNK_BYTES, byte_groups, texts

KINDS = ["email", "ip", "card", "phone"]
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
WINDOW, STRIDE = 64, 32
HIDDEN = 12
#: Bounds of the training sample.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_WINDOWS = 1500, 20_000, 3000
#: The network's finds: mean confidence over the span, and the fewest digits of a span by kind
#: (an address has at least 4; a span of an email needs an @ instead).
SURE = 0.9
MIN_DIGITS = {"ip": 4, "card": 7, "phone": 7}
CLASSES = "0aA@.-_+%() \n,:/="  # a digit, letters, marks that matter; then other ASCII, other letters, the rest

# The contract's patterns, as equal forms that take linear time: runs are taken whole and only where they begin.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(t: str):
    """From each @: the longest local part before it that no earlier match holds, and the domain after it."""
    end = at = 0
    while (at := t.find("@", at)) >= 0:
        start = at
        while start > end and t[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at += 1


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind's place, start, end), by kind, then start."""
    out = [(0, *x) for x in emails(t)] if "@" in t else []
    for m in IP.finditer(t):
        if all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in m.groups()):
            out.append((1, *m.span()))
    for m in CARD.finditer(t):
        d = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in t:
        for m in PHONE.finditer(t):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def classes(t: str):
    """Class of each character."""
    import numpy as np
    u = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.full(128, len(CLASSES), np.uint8)
    for lo, hi, c in ((48, 57, 0), (97, 122, 1), (65, 90, 2)):
        table[lo:hi + 1] = c
    for i, c in enumerate(CLASSES[3:], 3):
        table[ord(c)] = i
    return np.where(u < 128, table[np.minimum(u, 127)], np.where(u < 0x2000, len(CLASSES) + 1, len(CLASSES) + 2)).astype(np.uint8)


N_CLASSES = len(CLASSES) + 4  # the last one pads


@dataclass(frozen=True)
class PiiModel:
    params: dict  # name -> array


def sigmoid(x):
    import numpy as np
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x, wx, wh, b, keep=None):
    """Hidden states (steps, batch, hidden) of class ids x (steps, batch); ``keep`` collects what training needs."""
    import numpy as np
    n, hid = x.shape[1], wh.shape[0]
    h, c = np.zeros((n, hid), wx.dtype), np.zeros((n, hid), wx.dtype)
    out = np.empty((len(x), n, hid), wx.dtype)
    for s in range(len(x)):
        z = wx[x[s]] + h @ wh + b
        g = sigmoid(z[:, :3 * hid])
        i, f, o, u = g[:, :hid], g[:, hid:2 * hid], g[:, 2 * hid:], np.tanh(z[:, 3 * hid:])
        before, c = c, f * c + i * u
        tc = np.tanh(c)
        if keep is not None:
            keep.append((h, before, i, f, o, u, tc))
        h = o * tc
        out[s] = h
    return out


def lstm_back(x, wh, kept, dout, grads, names):
    import numpy as np
    wx_g, wh_g, b_g = (grads[k] for k in names)
    one = np.eye(N_CLASSES, dtype=wh.dtype)
    dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
    for s in reversed(range(len(x))):
        h, before, i, f, o, u, tc = kept[s]
        dh = dh + dout[s]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.hstack([dc * u * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)])
        wx_g += one[x[s]].T @ dz
        wh_g += h.T @ dz
        b_g += dz.sum(axis=0)
        dh, dc = dz @ wh.T, dc * f


def emissions(p, x, keep=None):
    """Tag scores (steps, batch, tags) of class ids (steps, batch)."""
    import numpy as np
    a = lstm(x, p["fx"], p["fh"], p["fb"], keep[0] if keep else None)
    b = lstm(x[::-1], p["bx"], p["bh"], p["bb"], keep[1] if keep else None)[::-1]
    both = np.concatenate([a, b], axis=2)
    return both @ p["ow"] + p["ob"], both


def logsum(x, axis):
    import numpy as np
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def forward_backward(em, trans):
    """Log weights of all beginnings and of all endings at each step and tag, and of all paths."""
    import numpy as np
    alpha, beta = np.empty_like(em), np.zeros_like(em)
    alpha[0] = em[0]
    for s in range(1, len(em)):
        alpha[s] = em[s] + logsum(alpha[s - 1][:, :, None] + trans, 1)
    for s in range(len(em) - 2, -1, -1):
        beta[s] = logsum(trans + (em[s + 1] + beta[s + 1])[:, None, :], 2)
    return alpha, beta, logsum(alpha[-1], 1)


def crf_gradient(em, trans, y):
    """Mean loss, and its gradients by emissions and transitions (forward-backward)."""
    import numpy as np
    steps, n, _ = em.shape
    alpha, beta, z = forward_backward(em, trans)
    d_em = np.exp(alpha + beta - z[None, :, None])
    d_tr = np.zeros_like(trans)
    rows = np.arange(n)
    gold = em[0][rows, y[0]].copy()
    for s in range(steps):
        d_em[s][rows, y[s]] -= 1
        if s:
            gold += em[s][rows, y[s]] + trans[y[s - 1], y[s]]
            pair = alpha[s - 1][:, :, None] + trans + (em[s] + beta[s])[:, None, :] - z[:, None, None]
            d_tr += np.exp(pair).sum(axis=0)
            np.add.at(d_tr, (y[s - 1], y[s]), -1)
    return (z - gold).mean(), d_em / n, d_tr / n


def rewritten(t: str, spans: list[tuple[int, int, int]], rng) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with each span written in a way that the patterns miss, and the spans' new places."""
    pick = lambda *xs: xs[rng.integers(len(xs))]
    out, places, at = [], [], 0
    for kind, a, b in sorted(spans, key=lambda x: x[1]):
        if a < at:
            continue
        s = t[a:b]
        if KINDS[kind] == "email":
            s = s.replace("@", pick(" @ ", "@ ", " @")).replace(".", pick(".", " . "))
        elif KINDS[kind] == "ip":
            s = s.replace(".", pick(" . ", ",", ", ", "-", ":"))
        elif KINDS[kind] == "card":
            digits = s.replace(" ", "").replace("-", "")
            s = pick(".", "/", "  ", " - ").join(digits[i:i + 4] for i in range(0, len(digits), 4))
        else:
            s = pick("00", "(00) ", "(+", "+ ") + s[1:].replace(" ", pick(" ", "/", " / ", "."), 1 + int(rng.integers(3)))
        out += [t[at:a], s]
        n = sum(map(len, out))
        places.append((kind, n - len(s), n))
        at = b
    return "".join([*out, t[at:]]), places


def examples(sample: list[str], rng):
    """(text, labelled spans): each text with the patterns' finds, and once more with the finds rewritten."""
    for t in sample:
        spans = base_spans(t)
        yield t, spans
        if spans:
            new, places = rewritten(t, spans, rng)
            yield new, places + [x for x in base_spans(new) if not any(x[1] < e and s < x[2] for _, s, e in places)]


def gradients(p, x, y):
    """Loss of a batch (steps, batch), and its gradient by every parameter."""
    import numpy as np
    h, kept = HIDDEN, ([], [])
    em, both = emissions(p, x, kept)
    loss, d_em, d_tr = crf_gradient(em, p["tr"], y)
    g = {k: np.zeros_like(a) for k, a in p.items()}
    g["tr"] = d_tr
    g["ow"], g["ob"] = np.tensordot(both, d_em, ((0, 1), (0, 1))), d_em.sum(axis=(0, 1))
    d = d_em @ p["ow"].T
    lstm_back(x, p["fh"], kept[0], d[:, :, :h], g, ("fx", "fh", "fb"))
    lstm_back(x[::-1], p["bh"], kept[1], d[::-1, :, h:], g, ("bx", "bh", "bb"))
    return loss, g


def fit(sample: list[str], steps: int = 700, batch: int = 48, seed: int = 5) -> PiiModel:
    """Train on windows of the examples: those with spans, and as many others that hold a digit or an @."""
    import numpy as np
    rng = np.random.default_rng(seed)
    data = {True: [], False: []}
    for t, spans in examples(sample, rng):
        x, y = classes(t), np.zeros(len(t), np.int64)
        for kind, a, b in spans:
            y[a], y[a + 1:b] = 1 + 2 * kind, 2 + 2 * kind
        for at in grid(x):
            pad = max(0, at + WINDOW - len(x))
            data[bool(y[at:at + WINDOW].any())].append((np.pad(x[at:at + WINDOW], (0, pad), constant_values=N_CLASSES - 1),
                                                        np.pad(y[at:at + WINDOW], (0, pad))))
    picked = []
    for part in data.values():
        picked += [part[i] for i in rng.permutation(len(part))[:SAMPLE_WINDOWS // 2]]
    h = HIDDEN
    shapes = {"fx": (N_CLASSES, 4 * h), "fh": (h, 4 * h), "fb": (4 * h,), "bx": (N_CLASSES, 4 * h), "bh": (h, 4 * h), "bb": (4 * h,),
              "ow": (2 * h, TAGS), "ob": (TAGS,), "tr": (TAGS, TAGS)}
    p = {k: (rng.normal(0, 0.2, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
    p["ob"][0] = 1.0
    p["fb"][h:2 * h] = p["bb"][h:2 * h] = 1.0  # remember at first
    m, v = ({k: np.zeros(s, np.float32) for k, s in shapes.items()} for _ in range(2))
    for step in range(1, steps + 1 if picked else 1):
        some = [picked[i] for i in rng.integers(0, len(picked), batch)]
        x, y = np.array([a for a, _ in some]).T, np.array([b for _, b in some]).T
        _, g = gradients(p, x, y)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            p[k] -= 0.03 * min(1.0, 2 - 2 * step / (steps + 1)) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return PiiModel({k: a.astype(np.float32) for k, a in p.items()})


def grid(x):
    """Starts of the windows that hold a digit or an @."""
    import numpy as np
    at = np.nonzero((x == 0) | (x == 3))[0]
    starts = np.unique(np.concatenate([at // STRIDE, np.maximum(at // STRIDE - 1, 0)])) * STRIDE
    return starts.tolist()


def viterbi(em, trans):
    """Best tags (steps, batch)."""
    import numpy as np
    back = np.empty(em.shape, np.int8)
    score = em[0]
    for s in range(1, len(em)):
        all_ = score[:, :, None] + trans
        back[s] = all_.argmax(axis=1)
        score = all_.max(axis=1) + em[s]
    tags = np.empty(em.shape[:2], np.int8)
    tags[-1] = score.argmax(axis=1)
    rows = np.arange(em.shape[1])
    for s in range(len(em) - 1, 0, -1):
        tags[s - 1] = back[s][rows, tags[s]]
    return tags


def well_formed(kind: int, inside) -> bool:
    """Whether a span of character classes can be of the kind: an @ in an email; enough digits
    in the others, no space in front and a digit at the end."""
    if KINDS[kind] == "email":
        return bool((inside == 3).any())
    return bool((inside == 0).sum() >= MIN_DIGITS[KINDS[kind]] and inside[0] != 11 and inside[-1] == 0)


def network_spans(whole: list[str], model: PiiModel, at_once: int = 512) -> list[list[tuple[int, int, int]]]:
    """Spans (kind, start, end) of the network in each text, after all its windows are reconciled."""
    import numpy as np
    p = model.params
    out, coded = [[] for _ in whole], []
    places: list[tuple[int, int]] = []
    for n, t in enumerate(whole):
        coded.append(classes(t) if t else np.zeros(0, np.uint8))
        places += [(n, a) for a in grid(coded[-1])]
    tags: dict[int, tuple] = {}
    edge = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    for first in range(0, len(places), at_once):
        some = places[first:first + at_once]
        x = np.full((len(some), WINDOW), N_CLASSES - 1, np.uint8)
        for r, (n, a) in enumerate(some):
            part = coded[n][a:a + WINDOW]
            x[r, :len(part)] = part
        em, _ = emissions(p, x.T)
        best = viterbi(em, p["tr"])
        conf = np.ones(best.shape, np.float32)
        found = np.nonzero(best.any(axis=0))[0]
        if len(found):  # the probability of each tag over all paths
            alpha, beta, z = forward_backward(em[:, found], p["tr"])
            sure = np.exp(alpha + beta - z[None, :, None])
            conf[:, found] = np.take_along_axis(sure, best[:, found][:, :, None].astype(np.int64), 2)[:, :, 0]
        for r, (n, a) in enumerate(some):
            if best[:, r].any() or n in tags:
                if n not in tags:
                    tags[n] = (np.zeros(len(coded[n]) + WINDOW, np.int8), np.full(len(coded[n]) + WINDOW, -1), np.zeros(len(coded[n]) + WINDOW, np.float32))
                tag, margin, c = tags[n]
                mine = edge + WINDOW * ((a == 0) & (np.arange(WINDOW) < WINDOW // 2))
                better = mine > margin[a:a + WINDOW]
                for arr, new in ((tag, best[:, r]), (margin, mine), (c, conf[:, r])):
                    arr[a:a + WINDOW][better] = new[better]
    for n, (tag, _, c) in tags.items():
        tag = tag[:len(coded[n])]
        kind = np.where(tag > 0, (tag.astype(int) - 1) // 2, -1)
        begins = np.nonzero((kind >= 0) & ((np.concatenate([[-1], kind[:-1]]) != kind) | (tag % 2 == 1)))[0]
        for a in begins.tolist():
            b = a + 1
            while b < len(tag) and kind[b] == kind[a] and tag[b] % 2 == 0:
                b += 1
            inside = coded[n][a:b]
            if well_formed(int(kind[a]), inside) and float(c[a:b].mean()) >= SURE:
                out[n].append((int(kind[a]), a, b))
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all, by kind, then start), one row per input row.

    A null text counts as empty.  Whole texts are read; a task holds a bounded
    number of bytes at a time.
    """
    src = texts(docs, id_col, text_col)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def run(batches):
        import pyarrow.compute as pc
        for b in batches:
            rows = []
            for group in byte_groups(iter(enumerate(pc.binary_length(b.column(1)).to_pylist())), lambda x: x[1], CHUNK_BYTES):
                whole = [b.column(1)[i].as_py() for i, _ in group]
                for t, more in zip(whole, network_spans(whole, model)):
                    base = base_spans(t)
                    added = [x for x in more if not any(x[1] < e and s < x[2] for _, s, e in base)] if more else []
                    counts = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
                    rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + added))))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                                              pa.array(cols[5], pa.string())], names)

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """At most SAMPLE_ROWS texts that hold a digit or an @, chosen by id hash, without texts over SAMPLE_CHARS."""
    src = texts(docs, id_col, text_col).where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    # rows whose hash is beyond four times the share needed go first: what tasks send does not grow with their number
    share = min(1.0, 4.0 * SAMPLE_ROWS / max(1, src.count()))
    src = src.select("text", F.xxhash64("doc_id").alias("h")).where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = src.orderBy("h", "text").limit(SAMPLE_ROWS).collect()
    return [r["text"] for r in rows]
