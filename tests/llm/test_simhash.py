import random
import re
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from logsift.llm.components import connected_components
from logsift.llm.simhash import fingerprint_links, keep_one_per_group, position_sets, simhash_groups

SCHEMA = "doc_id long, text string, fp long, component_id string"


def brute_fp(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_groups(pairs):
    root = {d: d for d, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, fa), (b, fb) in combinations(pairs, 2):
        if bin(fa ^ fb).count("1") <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d, _ in pairs}


def test_position_sets_leave_one_complement_for_any_three_bytes():
    sets = position_sets()
    assert len(sets) == 14
    for bad in combinations(range(8), 3):
        assert sum(not set(bad) & set(s) for s in sets) == 1


def test_documents_match_brute_force(spark):
    rng = random.Random(5)
    vocab = ["Alpha", "beta", "gamma", "DELTA", "eps", "é", " ", "zeta"] + [f"w{i}" for i in range(300)]
    texts = [None, "", " \t", "one", "One two", "a b c", "A B\nC"]
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 400))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            c = list(base)
            c[rng.randrange(len(c))] = "changed"
            texts.append("  ".join(c))
    data = [(i + 10, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in simhash_groups(spark.createDataFrame([(d, t, 1, "x") for d, t in data], SCHEMA)).collect()}
    fps = [(d, brute_fp(t)) for d, t in data]
    assert {d: got[d].fingerprint for d, _ in fps} == {d: f"{f:016x}" for d, f in fps}
    assert {d: got[d].component_id for d in got} == brute_groups(fps)


def test_links_match_brute_force_on_random_bits(spark):
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for k in (1, 2, 3, 4):
            x = f
            for b in rng.sample(range(64), k):
                x ^= 1 << b
            fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.a, r.b) for r in fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert got == {(a, b) for a, b in combinations(sorted(signed), 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}


def test_components_of_a_long_chain(spark):
    e = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(100, 101)], "a long, b long"))
    got = {r.node: r.root for r in connected_components(e).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_empty_and_filter(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash_groups(df).count() == 0
    df = spark.createDataFrame([(3, "a b c d", 1, "x"), (1, "a b c d", 1, "x"), (2, "q r s t u", 1, "x"), (7, None, 1, "x"), (8, "", 1, "x")], SCHEMA)
    out = keep_one_per_group(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 7]
