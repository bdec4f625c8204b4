import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from logsift.llm import spelling as sp

SCHEMA = "doc_id long, text string, word string, n int, key int"


def brute_words(rows, every=199, chars=6, count=5):
    c = Counter()
    for i, t, *_ in rows:
        for m in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            w = m.translate(str.maketrans(sp.UPPER, sp.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= chars and n >= count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1:] == s for i in range(len(t)))


def brute(v, ratio=5):
    near = {w: [] for w in v}
    for a, b in combinations(v, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, ns in near.items():
        best = min(ns, key=lambda x: (-v[x], x), default=None)
        form[w] = best if best and v[best] >= ratio * v[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), v[w], len(near[w]), v.get(form[w])) for w in v}


def got(df, **how):
    out = sp.spelling_variants(df, **how).collect()
    assert len({r.word for r in out}) == len(out)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out}


def made(seed=1):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "ababab", "bababa", "abababa", "ÀÉÿ×÷ßa", "straßen"]
    rows = []
    for i in range(400):
        ws = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(stems[: rng.randint(1, len(stems))])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcé") + w[k:], w[:k] + rng.choice("abcé") + w[k + 1:]])
            ws.append(rng.choice([w, w.upper(), w.title()]))
        rows.append((i if i % 50 else None, rng.choice([" ", "-", "1", "\n", "Ā"]).join(ws), "w", 1, 2))
    return rows + [(1, None, "", 0, 0), (2, "", "", 0, 0), (3, "Wörter" * 3 + " " + "langewörter " * 3000, "", 0, 0), rows[7], rows[7]]


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_match_brute_force(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for how in ({}, {"drop_every": 3}):
        v = brute_words(rows, how.get("drop_every", 199))
        want = brute(v)
        assert got(df, **how) == want and any(w[3] for w in want.values()) and any(w[0] for w in want.values())


def test_crowded_keys_are_split_and_nothing_is_lost(spark):
    words = sorted({f"zz{a}{b}{c}{d}" for a in "abcd" for b in "abc" for c in "abc" for d in "abcdef"})
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    want = {(a, b) for a, b in combinations(words, 2) if one_edit(a, b)}
    for bucket in (5, 100_000):
        assert {(r.a, r.b) for r in sp.near_pairs(df, bucket).collect()} == want


def test_pivots_are_the_cheapest_disjoint_grams_of_the_prefix():
    rng = random.Random(3)
    for _ in range(500):
        places = rng.sample(range(9), rng.randint(3, 6))
        prefix = [(rng.randint(1, 9), p, p) for p in places]
        if max(places) - min(places) < 2:
            continue
        best = min(a[0] + b[0] for a, b in combinations(prefix, 2) if abs(a[2] - b[2]) >= 2)
        a, b = sp.pivots_of(prefix)
        assert abs(a[2] - b[2]) >= 2 and a[0] + b[0] == best


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", 5 ** (i + 1), f"w{i + 1}", 5 ** (i + 2)) for i in range(9)], "word string, n long, form string, form_n long")
    assert {r.root for r in sp.roots(forms, 5).collect()} == {"w9"}


def test_empty_and_without_words(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert got(df) == {}
    assert got(spark.createDataFrame([(1, "short ab cd", "", 0, 0), (2, None, "", 0, 0)], SCHEMA)) == {}
    assert sp.spelling_variants(df).columns == ["word", "form", "root", "n", "n_near", "form_n"]
