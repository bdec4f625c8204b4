import random
import re
import time

import numpy as np

from logsift.llm.decontam import Items, contaminated, greedy_tiles, keep_clean, tile_document

DOCS = "doc_id long, text string, item_id string, coverage int"


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def naive_tiles(d, t, least):
    """Greedy string tiling by trying every pair of places in every round."""
    fd, ft, total = [True] * len(d), [True] * len(t), []
    while True:
        best, found = least, []
        for i in range(len(d)):
            for j in range(len(t)):
                k = 0
                while i + k < len(d) and j + k < len(t) and fd[i + k] and ft[j + k] and d[i + k] == t[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best:
                    found.append((i, j))
        if not found:
            return total
        for i, j in found:
            if all(fd[i:i + best]) and all(ft[j:j + best]):
                fd[i:i + best] = ft[j:j + best] = [False] * best
                total.append((i, j, best))


def brute(docs, items, least=4, coverage=0.5):
    out = []
    for d, dt in docs:
        for i, it in items:
            w = words(it)
            if w:
                got = sum(k for *_, k in naive_tiles(words(dt), w, min(least, len(w))))
                if got and got >= coverage * len(w):
                    out.append((d, i, got, len(w)))
    return sorted(out, key=str)


def test_greedy_tiles_equals_naive():
    rng = np.random.default_rng(3)
    for _ in range(300):
        d, t = rng.integers(0, 4, rng.integers(0, 40)).tolist(), rng.integers(0, 4, rng.integers(0, 20)).tolist()
        assert greedy_tiles(d, t, 3) == naive_tiles(d, t, 3)


def test_pairs_equal_brute_force_with_reordered_passages(spark):
    rng = random.Random(6)
    vocab = ["the", "of", "and", "Été", "naïve"] + [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(12, 30))) + ".") for i in range(8)]
    items += [(50, None), (51, ""), (52, "..."), (53, "short one"), (54, items[0][1]), (55, "α β γ δ ε ζ")]
    docs = [(0, None), (1, ""), (2, "x"), (3, "A Short, one!"), (4, "alpha α β γ δ ε ζ omega")]
    for n in range(60):
        w = words(rng.choice(items[:8])[1])
        cut = rng.randint(4, len(w) - 4)
        body = rng.choice([w, w[cut:] + ["zz"] + w[:cut], w[:cut], w[::2], w[:5] + ["q"] + w[6:]])
        pad = lambda: [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
        docs.append((10 + n, ", ".join(pad() + body + pad())))
    docs += [docs[6], (900, "word " * 50_000 + items[1][1])]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.matched_words, r.item_words) for r in contaminated(df, bench).collect()), key=str)
    assert got == sorted(brute([d for d in docs if d[0] != 900], items) + [(900, 1, len(words(items[1][1])), len(words(items[1][1])))], key=str)
    clean = keep_clean(df, bench)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs if d not in {g[0] for g in got})


def test_a_seed_shared_by_many_items_costs_little():
    rng = random.Random(9)
    common = ["in", "the", "middle", "of", "the"]
    items = [(i, " ".join([f"a{rng.randrange(5000)}" for _ in range(9)] + common + [f"b{rng.randrange(5000)}" for _ in range(9)])) for i in range(2000)]
    items.append((2000, items[7][1]))
    block = Items(items, 4)
    place = {w: i for i, w in enumerate(block.vocabulary)}
    doc = []
    while len(doc) < 20_000:
        doc += common + [f"x{rng.randrange(50)}" for _ in range(rng.randint(0, 3))]
    doc[9000:9000] = words(items[7][1])
    codes = np.array([place.get(w, -1) for w in doc])
    began = time.time()
    got = sorted(tile_document(codes, block, 0.5))
    assert time.time() - began < 5
    assert [(n, k) for n, k, *_ in got] == [(7, 23), (2000, 23)]
    near = doc[8990:9040]
    for n in rng.sample(range(2000), 40) + [7]:
        want = sum(k for *_, k in naive_tiles(near, words(items[n][1]), 4))
        assert (want >= 0.5 * 23) == (n == 7)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert contaminated(docs, bench).count() == 0
    assert keep_clean(spark.createDataFrame([(1, "a b c d e", "x", 1)], DOCS), bench).count() == 1
