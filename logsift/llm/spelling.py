"""Spelling variant grouping by pivotal grams.

Two words are near if one code point inserted, deleted or replaced turns one into the other.
A word's bigrams are ordered from the rarest one on; its gram prefix is the first three (with every
further occurrence of the third), and its pivots are the two disjoint
bigrams of the prefix that the fewest words hold, chosen by dynamic programming.  One edit
destroys at most one of two disjoint bigrams, so the word whose prefix ends first in the
order keeps a pivot in the other's prefix.  The pivots are looked up in an index of the
prefixes with these limits of position: the edit lies wholly before or wholly after the
pivot that is kept, so on the other side of it both words are the same, and the lengths
differ by one at most.  Candidates are verified by their edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logsift.llm.common import checkpoint, texts

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Q, PIVOTS = 2, 2
PREFIX = Q * (PIVOTS - 1) + 1
#: Prefixes under one key that one task compares with a pivot's words; a longer list is dealt over salted keys.
BUCKET = 2000
POST = "word string, n long, last int, kind string, gram int, place int"


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 199, min_chars: int = 6,
             min_count: int = 5) -> DataFrame:
    """(word, n): lower-cased runs of letters of ``min_chars`` code points or more that occur ``min_count`` times or more.

    Where ``drop_every`` divides the checksum of ``<doc_id>:<run>``, the run's code point at checksum modulo length is left out.
    """
    src = texts(docs, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    runs = src.select("id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= min_chars)
    runs = runs.select(F.translate("run", UPPER, LOWER).alias("run"), F.length("run").alias("size"), "id")
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run"))
    return (runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """(place in the order, words that hold it) of every bigram; at most the square of the alphabet (90 letters)."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(Q))))
    rows = words.where(F.length("word") >= Q).select(F.explode(grams).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["g"]: (i, r["n"]) for i, r in enumerate(sorted(rows, key=lambda r: (r["n"], r["g"])))}


def pivots_of(prefix: list[tuple[int, int, int]], k: int = PIVOTS, q: int = Q) -> list[tuple[int, int, int]]:
    """The ``k`` disjoint grams (cost, gram, place) of the prefix with the least total cost, by dynamic
    programming over the places: the best choice of j grams among the first i."""
    items = sorted(prefix, key=lambda x: x[2])
    none = (float("inf"), ())
    best = [[(0, ())] + [none] * k]
    for i, x in enumerate(items):
        before = next((m for m in range(i, 0, -1) if items[m - 1][2] + q <= x[2]), 0)
        row = [(0, ())]
        for j in range(1, k + 1):
            cost, chosen = best[before][j - 1]
            row.append(min(best[i][j], (cost + x[0], (*chosen, i))))
        best.append(row)
    return [items[i] for i in best[-1][k][1]]


def gram_prefix(word: str, order: dict[str, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(cost, gram, place) of the word's first grams in the order, with every occurrence of the last one."""
    grams = sorted((*order[word[i:i + Q]], i) for i in range(len(word) - Q + 1))
    grams = [(n, g, i) for g, n, i in grams]
    last = grams[min(PREFIX, len(grams)) - 1][1]
    return [x for x in grams if x[1] <= last]


def postings(words: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """POST: each word's prefix (kind ``pre``) and pivots (``piv``); ``last``: the gram that its prefix ends with."""
    shared = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for b in batches:
            out = []
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                prefix = gram_prefix(w, order)
                last = max(g for _, g, _ in prefix)
                out += [(w, n, last, "pre", g, i) for _, g, i in prefix]
                out += [(w, n, last, "piv", g, i) for _, g, i in pivots_of(prefix)]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
            cols = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["word", "n", "last", "kind", "gram", "place"])

    return words.select("word", "n").mapInArrow(run, POST)


def keyed(posts: DataFrame, shifts: list[int]) -> DataFrame:
    """Postings by key: the gram, the side of it that is the same, a hash of that side, and the length of the word looked for."""
    before = F.substring("word", F.lit(1), F.col("place"))
    after = F.substring("word", F.col("place") + Q + 1, F.length("word"))
    side = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.xxhash64(t).alias("part")) for s, t in (("before", before), ("after", after))]))
    sized = posts.select("word", "n", "last", "gram", side.alias("k"), F.explode(F.array(*[F.length("word") + F.lit(d) for d in shifts])).alias("size"))
    return sized.select("word", "n", "last", F.xxhash64("gram", "k.side", "k.part", "size").alias("key"))


def near_pairs(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, na, b, nb), a < b: all pairs of near words (``words``: distinct word of two letters or more, n)."""
    posts = checkpoint(postings(words, gram_order(words)))
    pre = keyed(posts.where("kind = 'pre'"), [0])
    piv = keyed(posts.where("kind = 'piv'"), [-1, 0, 1])
    # a key with many prefixes is dealt over as many salts as it fills buckets; its pivots meet them all
    crowded = checkpoint(pre.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > bucket)
                         .select("key", F.ceil(F.col("held") / bucket).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    a = pre.join(crowded, "key", "left").select("key", F.pmod(F.xxhash64("word"), salts).cast("int").alias("salt"),
                                                F.col("word").alias("s"), F.col("n").alias("ns"), F.col("last").alias("ls"))
    b = piv.join(crowded, "key", "left").select("key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
                                                F.col("word").alias("r"), F.col("n").alias("nr"), F.col("last").alias("lr"))
    met = b.join(a, ["key", "salt"]).where((F.col("lr") <= F.col("ls")) & (F.col("r") != F.col("s"))
                                           & (F.levenshtein("r", "s", 1) == 1))
    first = F.col("r") < F.col("s")
    return met.select(F.when(first, F.col("r")).otherwise(F.col("s")).alias("a"), F.when(first, F.col("nr")).otherwise(F.col("ns")).alias("na"),
                      F.when(first, F.col("s")).otherwise(F.col("r")).alias("b"), F.when(first, F.col("ns")).otherwise(F.col("nr")).alias("nb")).distinct()


def roots(forms: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of (word, n, form, form_n) by pointer doubling.

    Along a chain n grows at least ``ratio`` times a step, so its length is at most the logarithm of the largest n.
    """
    up = checkpoint(forms.select("word", F.col("form").alias("root")))
    most, least = forms.agg(F.max("form_n"), F.min("n")).first()
    steps = 1
    while least and least * ratio ** steps <= most:
        steps *= 2
        over = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = checkpoint(up.join(over, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return up


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 199, min_chars: int = 6,
                      min_count: int = 5, ratio: int = 5, bucket: int = BUCKET) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each word.

    Words: see ``words_of``.  ``n_near`` counts a word's near words; ``form`` is the one that occurs most (ties: the first in
    code-point order), where it occurs at least ``ratio`` times as often, with its count ``form_n``, else both are null; ``root`` follows the
    forms to the last one, and is the word itself where it has none.

    A null text has no words, a null id counts as empty in the checksum.  Repeated rows count each time; an empty
    table, or one without such words, gives an empty result.  Other columns are not looked at.
    """
    if min_chars < Q + 2:
        raise ValueError("a word needs three bigrams, as its prefix has three")
    words = checkpoint(words_of(docs, id_col, text_col, drop_every, min_chars, min_count))
    pairs = checkpoint(near_pairs(words, bucket))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).union(pairs.select("b", "a", "na"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("neg"), "other")).alias("top"))
    known = checkpoint(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                              F.when(-F.col("top.neg") >= ratio * F.col("n"), F.col("top.other")).alias("form"),
                                                              F.when(-F.col("top.neg") >= ratio * F.col("n"), -F.col("top.neg")).alias("form_n")))
    up = roots(known.where("form is not null"), ratio)
    return known.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

