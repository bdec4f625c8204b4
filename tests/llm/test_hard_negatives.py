import random

import numpy as np
from pyspark.sql import functions as F

from logsift.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, score string, windows int"


def brute(rows, every=10):
    """rows: (id, vector, label); only rows that take part."""
    whole = [(i, [int(np.floor(np.float64(256) * np.float64(np.float32(x)))) for x in v], y) for i, v, y in rows
             if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, v, y) in enumerate(whole):
        if i is None or i % every:
            continue
        others = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, z) for m, (j, w, z) in enumerate(whole) if m != n)
        show = lambda o: h.TOP if o[1] else o[2]
        for p in [o for o in others if o[4] == y][:5]:
            fits = [o for o in others if o[4] != y and 80 * -p[0] <= 100 * -o[0] <= 100 * -p[0]][:5]
            out += [(i, show(p), k + 1, show(o), -p[0], -o[0]) for k, o in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(i, v, y, "r", "s", 0) for i, v, y in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in h.hard_negatives(df, anchor_every=10, **how).collect())


def made(n=400, dim=6, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.3, 0.4) for _ in range(dim)], rng.randrange(4)) for i in range(n)]
    rows += [(1000 + i, [0.5] * dim, rng.randrange(4)) for i in range(60)]  # ties
    return rows


def test_matches_brute_force_with_ties_nulls_repeats_and_clashing_columns(spark):
    rows = made()
    rows += [rows[0], rows[10], (2000, None, 1), (2010, [0.1, None], 1), (2020, [float("nan")] * 6, 1), (2030, [float("inf")] * 6, 1),
             (2040, [0.1] * 6, None), (None, [0.5] * 6, 2), (None, [0.4] * 6, 1), (2050, [0.9, 0.1], 1), (2060, [], 2), (-30, [0.2] * 6, 3), (2070, [-0.5] * 6, 0)]
    assert mined(spark, rows) == brute(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = made(seed=2)
    monkeypatch.setattr(h, "ROWS", 64)
    monkeypatch.setattr(h, "ANCHORS", 16)
    monkeypatch.setattr(h, "STEP", 4)
    assert mined(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.uniform(0, 2**21))) for _ in range(4)], i % 3) for i in range(120)]
    assert mined(spark, rows) == brute(rows)
    rows = [(i, [3e38, 1.0], i % 2) for i in range(12)]  # beyond a long: its end
    assert {(r[4], r[5]) for r in mined(spark, rows)} == {(h.TOP, h.TOP)}


def test_one_label_or_one_vector_for_most_rows(spark):
    rows = [(i, [0.5, 0.25], 1 if i % 3 else 0) for i in range(300)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, [(i, [0.5, 0.25], 1) for i in range(30)]) == []


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert h.hard_negatives(df).count() == 0
    assert h.hard_negatives(spark.createDataFrame([(1, [0.1], 1, "", "", 0)], SCHEMA)).count() == 0


def test_no_pair_of_an_anchor_is_kept_beyond_its_windows(spark):
    src = h.prepared(spark.createDataFrame([(*r, "", "", 0) for r in made(2000)], SCHEMA), "vec_id", "embedding", "label", 256)
    src = src.persist()
    anchors = src.where(F.col("id") % 100 == 0)
    near = h.scored(src, anchors, src.count(), anchors.count(), h.POSITIVE, 5, 80, 100)
    assert near.groupBy("a_rid").count().agg(F.max("count")).first()[0] <= 5
