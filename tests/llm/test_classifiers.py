import random

from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001
from logsift.llm import langid, toxicity
from logsift.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, score string, lang_pred int"
ODD = [(1, None), (2, ""), (3, "123 !?"), (4, "x"), (None, "the of and"), (5, "the and of " * 40_000), (5, "the and of")]


def test_language_id_on_held_out_rows(spark):
    out = QUERIES["op10_language_id"](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").where("held_out").collect()
    assert out.count() == docs.count() and len(rows) > 60
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_odd_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.fit(langid.training_sample(docs), epochs=1)
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in ODD], SCHEMA)
    got = langid.identify(df, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in ODD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"} and all(r.rejected for r in got if r.doc_id in (1, 2, 3))
    kept = langid.keep_known_languages(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {5, None}
    assert langid.identify(df.limit(0), model).count() == 0


def test_languages_of_long_texts_only_are_learned(spark):
    rng = random.Random(2)
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    en, de = ["the", "and", "with", "house", "going", "there", "thought"], ["und", "nicht", "haus", "gehen", "über", "schön", "gedacht"]
    rows = [(i, say(en, 40) if i % 2 else say(de, 1400), "en" if i % 2 else "de") for i in range(200)]
    rows += [(1000 + i, "", "de") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_sample(df)
    assert {y for _, y in sample} == {"de", "en"} and max(len(t) for t, _ in sample) <= langid.SAMPLE_CHARS
    model = langid.fit(sample)
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, model).collect()}
    assert sum(got[i] == y for i, _, y in rows[:200]) >= 198


def test_toxicity_separates_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    out = QUERIES["op4_toxicity"](spark, SF001)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "score", "predicted").collect()
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert wins >= 0.75
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_learns_planted_words(spark):
    rng = random.Random(8)
    vocab = ["the", "of", "and", "in"] + ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    made = []
    for i in range(900):
        w = [rng.choice(vocab) for _ in range(60)]
        bad = i % 3 == 0
        for _ in range(3 * bad):
            w[rng.randrange(60)] = rng.choice(["zgrumpf", "wquackle", "kvorbix"])
        made.append((" ".join(w), int(bad)))
    model = toxicity.fit(made[:600])
    df = spark.createDataFrame([(i, t, "s", 1) for i, (t, _) in enumerate(made[600:])], SCHEMA)
    got = {r.doc_id: r.predicted for r in toxicity.score_texts(df, model).collect()}
    assert sum(got[i] == y for i, (_, y) in enumerate(made[600:])) >= 290
    odd = toxicity.score_texts(spark.createDataFrame([(d, t, "s", 1) for d, t in ODD], SCHEMA), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_texts(df.limit(0), model).count() == 0


def test_pipeline_equals_its_parts_in_brute_force(spark, tmp_path):
    import test_decontam as dc
    import test_dedup as dd
    import test_simhash as sh
    from tokenizers import Tokenizer
    from logsift.llm.queries import tokenizer_file
    src = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 160")
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").limit(6)
    item = bench.first()["text"]
    extra = spark.createDataFrame([(9001, f"lead in words {item} tail", "en", "s", 1), (9002, "", "en", "s", 0), (9003, None, None, None, None)], src.schema)
    docs = src.withColumn("text", F.substring("text", 1, 1500)).union(extra)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    model = langid.fit(langid.training_sample(docs))
    left = {r.doc_id for r in langid.identify(docs, model).where("not rejected").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in left]
    keep = {b[1] for b in dd.brute(rows)}
    rows = [r for r in rows if r[0] in keep]
    comps = sh.brute_groups([(d, sh.brute_fp(t)) for d, t in rows])
    rows = [r for r in rows if comps[r[0]] == r[0]]
    items = [(r.item_id, r.text) for r in bench.collect()]
    seeds = {tuple(dc.words(t)[i:i + 4]) for _, t in items for i in range(len(dc.words(t)) - 3)}
    bad = {b[0] for b in dc.brute([r for r in rows if any(tuple(dc.words(r[1])[i:i + 4]) in seeds for i in range(len(dc.words(r[1]))))], items)}
    tok = Tokenizer.from_str(tokenizer_file("word_bpe_49k.json").decode())
    assert 9001 in bad and 9002 not in left
    assert got == {d: len(tok.encode(t, add_special_tokens=False).ids) for d, t in rows if d not in bad}


def test_toxicity_learns_phrases_of_ordinary_words():
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(3, 8))) for _ in range(64)]
    phrase = " ".join(rng.choice(vocab) for _ in range(3))
    made = []
    for i in range(2600):
        w, bad = [rng.choice(vocab) for _ in range(60)], rng.random() < 1 / 3
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), phrase)
        made.append((" ".join(w), int(bad)))
    model = toxicity.fit(made[:2000])
    gains_of = toxicity.window_scorer(model)
    got = [(toxicity.score(model, toxicity.features(gains_of(t), model.gains)) >= 0.3, y) for t, y in made[2000:]]
    hits = sum(p and y for p, y in got)
    assert hits >= 0.9 * sum(y for _, y in got) and hits >= 0.8 * sum(p for p, _ in got)


def test_a_passage_gain_is_the_difference_of_two_compressed_lengths():
    import zstandard
    model = toxicity.fit([("a bad thing was said " * 9 + str(i), 1) for i in range(40)] + [("the good thing was done " * 9 + str(i), 0) for i in range(40)])
    words = "a bad thing was said a bad thing was said by the good".split()
    assert toxicity.passages(words) == [b" a bad thing was said a bad thing ", b" bad thing was said by the good "] and toxicity.passages([]) == []
    got = toxicity.passage_scorer(model)(words)
    assert len(got) == 2 and got[0] > 0
    assert zstandard.ZstdCompressionDict(model.toxic_passages).as_bytes() == model.toxic_passages


def _documents(spark, path, rows, extra=""):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))


def test_pipeline_judges_rows_that_share_an_id_one_by_one(spark, tmp_path):
    rng = random.Random(7)
    say = lambda: " ".join(rng.choice(["the", "and", "with", "house", "going", "there", "thought", "water", "stone"]) + str(rng.randrange(99)) for _ in range(60))
    rows = [(i, say(), "en", "s", 1) for i in range(100, 160)]
    good, leak = say(), f"see one two three four five six seven eight nine ten {say()}"
    near = good.upper()  # another text with the same fingerprint
    rows += [(7, good, "en", "s", 1), (7, "12 ?! 34", "en", "s", 1), (7, leak, "en", "s", 1), (8, good, "en", "s", 1), (8, good, "en", "s", 1), (None, say(), None, None, None),
             (9, near, "en", "s", 1), (7, None, "en", "s", 1), (11, "", "en", "s", 1)]
    _documents(spark, tmp_path, [(*r, "clash", 1) for r in rows], ", _row string, _at int")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = sorted((str(r.doc_id) for r in out))
    assert ids.count("7") == 1 and ids.count("8") == 0 and ids.count("9") == 0 and ids.count("None") == 1 and ids.count("11") == 0
    assert len(out) == 62 and {r.n_tokens > 60 for r in out} == {True}


def test_pipeline_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    _documents(spark, tmp_path, [])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_scores_equal_a_plain_computation(spark):
    import math
    import numpy as np
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(40)
    model = langid.fit(langid.training_sample(spark.read.parquet(f"{SF001}/documents.parquet")), epochs=1)
    table = np.frombuffer(model.table, np.float32).reshape(langid.BUCKETS, -1)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    for r in docs.collect():
        if not r.text or not any(c.isalpha() for c in r.text):
            continue
        grams = langid.gram_hashes(r.text).tolist()
        z = [sum(float(table[g][k]) for g in grams) / len(grams) + model.bias[k] for k in range(len(model.langs))]
        p = [math.exp(x - max(z)) for x in z]
        assert got[r.doc_id][0] == model.langs[z.index(max(z))] and abs(got[r.doc_id][1] - max(p) / sum(p)) < 1e-4
