"""Secret scans: fixed patterns, and character Markov models (DataFrame functions only).

Two first-order character models are trained from labelled strings: random ones
(values of secrets) and ordinary identifiers (words of the texts).  A run of
token characters is a secret if the log-likelihood ratio of the two models over
its whole length is large enough.  The models are one table of at most
alphabet x alphabet ratios, which travels as a literal.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from logsift.llm.common import texts

# The patterns of the contract.  Matches that are too short are dropped, not tried again.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so the bound can stand in the pattern
ASSIGN_VALUE, ACCESS_CHARS = 6, 20

#: A candidate of the models: a run of token characters, from the length that training labels as secret.
MIN_RUN = 16
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
#: Evidence asked for, in nats over the whole run, if there are fewer than LEAST held-out strings of a class to calibrate it.
MIN_RATIO = 10.0
LEAST = 20
#: About so many documents give the ordinary and random strings for training.
SAMPLE_ROWS = 5000
#: Matches of a text whose places are counted together.
CHUNK = 256
KINDS = ["assign", "access", "hex", "markov"]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(array: Column) -> Column:
    """An array in parts of CHUNK elements."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(array), F.lit(1)), F.lit(CHUNK)), lambda i: F.slice(array, i, F.lit(CHUNK)))


def matches(text: Column, pattern: str, kind: str, value_group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, rank, end, kind, value), in code points.

    The text between matches and the matches themselves give the offsets, in two levels: places within
    parts of CHUNK matches, then the parts' own places, so that no array grows with the text match by match.
    """
    span = "struct<start:int,rank:int,end:int,kind:string,value:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        one = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"),
                       F.lit(kind).alias("kind"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def places(parts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(parts, begin, lambda acc, p: F.struct((acc["at"] + p["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                           lambda acc: acc["out"])

    def moved(part: Column, by: Column) -> Column:
        return F.transform(part["out"], lambda x: F.struct((x["start"] + by).alias("start"), x["rank"], (x["end"] + by).alias("end"), x["kind"], x["value"]))

    raw = F.struct(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                   F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"))
    zipped = lambda r: F.arrays_zip(F.slice(r["gap"], 1, F.size(r["hit"])).alias("gap"), r["hit"].alias("hit"), r["value"].alias("value"))
    parts = let(let(raw, zipped), lambda z: F.transform(pieces(z), lambda p: F.aggregate(p, start, step)))
    found = let(parts, lambda ps: F.flatten(F.zip_with(ps, places(ps), moved)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{span}>"))


def untouched(spans: Column, others: Column) -> Column:
    """``spans`` without those that overlap one of ``others`` (sorted by start); parts of these are looked into only where they reach."""
    part = lambda p: F.struct(p.alias("own"), F.get(p, F.lit(0))["start"].alias("lo"), F.array_max(F.transform(p, lambda b: b["end"])).alias("hi"))
    meets = lambda c, b: (b["start"] < c["end"]) & (c["start"] < b["end"])
    near = lambda c, p: (p["lo"] < c["end"]) & (c["start"] < p["hi"]) & F.exists(p["own"], lambda b: meets(c, b))
    return let(F.transform(pieces(others), part), lambda ps: F.filter(spans, lambda c: ~F.exists(ps, lambda p: F.coalesce(near(c, p), F.lit(False)))))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start and then kind."""
    assign = F.filter(matches(text, ASSIGN, "assign", 2), lambda x: F.length(x["value"]) >= ASSIGN_VALUE)
    access = F.filter(matches(text, ACCESS, "access"), lambda x: x["end"] - x["start"] >= ACCESS_CHARS)
    return F.sort_array(F.concat(assign, access, matches(text, HEX, "hex")))


def training_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled strings (``s``, ``random``) from about ``rows`` documents, chosen by the ids' hash.

    Random: values that the fixed patterns find, of MIN_RUN characters or more.
    Ordinary: words of 4 letters, digits or marks or more in the texts around them.
    """
    src = texts(docs, id_col, text_col)
    step = max(1, src.count() // rows)
    src = src.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    found = src.select(F.explode(base_spans(F.col("text"))).alias("x")).select(F.col("x.value").alias("s"), F.lit(True).alias("random"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = src.select(F.explode(F.regexp_extract_all(rest, F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("s"), F.lit(False).alias("random"))
    return found.where(F.length("s") >= MIN_RUN).union(words)


def ratio_table(strings: DataFrame) -> list[float]:
    """Log-likelihood ratios of each pair of successive alphabet characters, random against
    ordinary, with one count added to every pair.  Strings: ``s``, ``random`` (null: left out)."""
    n = len(ALPHABET)
    s = strings.where(F.col("random").isNotNull() & (F.length("s") >= 2)).groupBy("s", "random").agg(F.count(F.lit(1)).alias("times"))
    pairs = s.select("random", "times", "s", F.explode(F.sequence(F.lit(1), F.length("s") - 1)).alias("i")).select(
        "random", "times", F.substring("s", F.col("i"), F.lit(1)).alias("a"), F.substring("s", F.col("i") + 1, F.lit(1)).alias("b"))
    where = lambda c: F.instr(F.lit(ALPHABET), F.col(c)) - 1
    counts = (pairs.select("random", "times", where("a").alias("a"), where("b").alias("b")).where("a >= 0 and b >= 0")
              .groupBy("a", "b").agg(F.sum(F.when(F.col("random"), F.col("times")).otherwise(0)).alias("r"),
                                     F.sum(F.when(~F.col("random"), F.col("times")).otherwise(0)).alias("o")))
    spark = strings.sparkSession
    grid = spark.range(n * n).select(F.floor(F.col("id") / n).cast("int").alias("a"), (F.col("id") % n).cast("int").alias("b"))
    sums = counts.groupBy("a").agg(F.sum("r").alias("rs"), F.sum("o").alias("os"))
    full = grid.join(counts, ["a", "b"], "left").join(sums, "a", "left").na.fill(0)
    score = F.log((F.col("r") + 1) / (F.col("rs") + n)) - F.log((F.col("o") + 1) / (F.col("os") + n))
    rows = full.select("a", "b", score.alias("v")).orderBy("a", "b").collect()  # alphabet x alphabet rows
    return [r["v"] for r in rows]


def likelihood_ratio(s: Column, ratios: Column) -> Column:
    """Sum of the ratios over the successive characters of ``s`` (all in the alphabet)."""
    places = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc, x):
        # get(): null outside the table
        more = F.when((acc["last"] >= 0) & (x >= 0), F.get(ratios, acc["last"] * len(ALPHABET) + x)).otherwise(F.lit(0.0))
        return F.struct(x.alias("last"), (acc["sum"] + F.coalesce(more, F.lit(0.0))).alias("sum"))

    return F.aggregate(places, start, step, lambda acc: acc["sum"])


def secret_spans(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text",
                 min_ratio: float = MIN_RATIO) -> DataFrame:
    """doc_id, base and added: arrays of spans (start, rank, end, kind, value).

    ``base`` are the fixed patterns' spans; ``added`` the runs that the models
    take for random and that no base span touches.  A null text counts as empty.
    """
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    src = texts(docs, id_col, text_col).withColumn("base", base_spans(F.col("text")))
    src = src.withColumn("runs", matches(F.col("text"), RUN, "markov"))
    random = F.filter("runs", lambda c: likelihood_ratio(c["value"], table) >= min_ratio)
    added = F.when(F.size("base") > 0, untouched(random, F.col("base"))).otherwise(random)
    return src.select("doc_id", "base", F.when(F.size("runs") > 0, added).otherwise(F.col("runs")).alias("added"))


def calibrated_ratio(strings: DataFrame, ratios: list[float]) -> float:
    """The evidence, in tenths of nats, that best parts random from ordinary strings of MIN_RUN characters or more:
    the greatest share of random ones at or above it less the share of ordinary ones; of several, the middle one."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    long = strings.where(F.col("random").isNotNull() & (F.length("s") >= MIN_RUN)).dropDuplicates(["s", "random"])
    tenths = F.greatest(F.lit(-1000), F.least(F.lit(1000), F.floor(likelihood_ratio(F.col("s"), table) * 10))).cast("int")
    counts = {(r["v"], r["random"]): r["n"] for r in long.groupBy(tenths.alias("v"), "random").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 2 x 2,001
    total = {y: sum(n for (_, r), n in counts.items() if r == y) for y in (True, False)}
    if min(total.values()) < LEAST:
        return MIN_RATIO
    gap, best, at = 0.0, 0.0, []
    for v in range(1000, -1001, -1):
        gap += counts.get((v, True), 0) / total[True] - counts.get((v, False), 0) / total[False]
        if gap > best + 1e-12:
            best, at = gap, [v]
        elif at and gap > best - 1e-12:
            at.append(v)
    return at[len(at) // 2] / 10 if at else MIN_RATIO


def fit(strings: DataFrame) -> tuple[list[float], float]:
    """Ratio table of all strings, and the evidence asked for, from one half of them (by hash) under the other half's table."""
    strings = strings.persist()  # a bounded sample, read several times
    held = F.pmod(F.xxhash64("s"), F.lit(2)) == 0
    least = calibrated_ratio(strings.where(held), ratio_table(strings.where(~held)))
    ratios = ratio_table(strings)
    strings.unpersist()
    return ratios, least


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_scan(docs: DataFrame, ratios: list[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (all of them, by start, then kind), one row per input row."""
    min_ratio = MIN_RATIO
    if ratios is None:
        ratios, min_ratio = fit(training_strings(docs, id_col, text_col))
    found = secret_spans(docs, ratios, id_col, text_col, min_ratio)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.sort_array(F.concat("base", "added"))).alias("spans"))
