"""URL filters: pattern rules indexed by their rarest literal token (DataFrame functions only).

A rule is a regular expression over a url's host and path together.  Its literal
tokens are the runs of letters and digits that every matching url must hold as a
whole token; the rule is filed under the one that the fewest urls hold.  A url's
tokens fetch the rules filed under them, and only those run their expressions.  Rules
without any literal token are filed under the empty token, which every url fetches.

Two tables of rules: (host, path) rules, which decide first, and patterns, which decide
where no such rule fits; in both the longest fitting rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logsift.llm.common import RUNS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_TOKEN = "[^A-Za-z0-9]+"
#: A literal token of a rule's text: closed on both sides by a literal sign, never by a wildcard.
LITERAL = r"(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])"
#: Up to so many rules (of at most so many characters in all) are broadcast; more meet the tokens in a salted join.
BROADCAST_RULES, BROADCAST_CHARS = 100_000, 16 << 20

#: Patterns for urls that no (host, path) rule covers.  ``^`` is a sign that is no letter or digit, or an end; ``*`` anything.
PATTERNS = (
    ("block", "^casino^"), ("block", "^poker^"), ("block", "^bets^"), ("block", "^free-spins^"),
    ("block", "^pills^"), ("block", "^viagra^"), ("block", "^adult^"), ("block", "^porn^"), ("block", "^xxx^"),
    ("block", "^spam^"), ("block", "^ads^*track"), ("block", "^adserver^"), ("block", "^doubleclick^"), ("block", "^tracker^"),
    ("allow", "^adult-education^"), ("allow", "^anti-spam^"), ("allow", "^casino-royale^"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def quoted(text: Column) -> Column:
    """A regular expression that matches just ``text``."""
    return F.regexp_replace(text, "([^A-Za-z0-9])", r"\\$1")


def host_rules(rules: DataFrame) -> DataFrame:
    """Rules from (host, path, verdict): the host and all its subdomains, where the path starts with the rule's."""
    host, path = F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))
    closed = F.when(path == "", "(?=/|$)").otherwise("")
    return rules.where("host is not null and verdict is not null").select(
        F.lit(0).alias("tier"), F.concat(host, path).alias("rule"), "verdict", F.length(host).alias("head"),
        F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted(F.concat(host, path)), closed).alias("regex"),
        # the host follows a dot or the start; without a path it ends at a slash or the end
        F.concat(F.lit("."), host, F.when(path == "", "/").otherwise(path)).alias("literals"))


def pattern_rules(patterns: DataFrame) -> DataFrame:
    """Rules from (pattern, verdict), see PATTERNS; a pattern may match anywhere in host and path."""
    p = F.col("pattern")
    regex = F.regexp_replace(quoted(p), r"\\\*", ".*")
    regex = F.regexp_replace(regex, r"\\\^", "(?:^|[^A-Za-z0-9]|\\$)")
    return patterns.where("pattern is not null and verdict is not null").select(
        F.lit(1).alias("tier"), p.alias("rule"), "verdict", F.lit(0).alias("head"), F.concat(F.lit("(?s)"), regex).alias("regex"), p.alias("literals"))


def tokens(target: Column) -> Column:
    return F.array_distinct(F.filter(F.split(target, NOT_TOKEN), lambda t: t != ""))


def rule_index(rules: DataFrame, targets: DataFrame) -> DataFrame:
    """``rules`` with the token each is filed under: of its literal tokens the one in the fewest ``targets``
    (ties: the first in order), the empty one if it has none."""
    lit = rules.withColumn("token", F.explode_outer(F.array_distinct(F.regexp_extract_all("literals", F.lit(LITERAL), F.lit(0)))))
    lit = lit.withColumn("token", F.coalesce("token", F.lit("")))
    asked = lit.select("token").distinct()
    held = targets.select(F.explode(tokens(F.col("target"))).alias("token"))
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("held")).join(asked, "token", "left_semi")
    return (lit.join(counts, "token", "left").groupBy("tier", "rule", "verdict", "head", "regex")
            .agg(F.min(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "token")).alias("least"))
            .select("tier", "rule", "verdict", "head", "regex", F.col("least.token").alias("token")))


def small(rules: DataFrame) -> bool:
    n, chars = rules.agg(F.count(F.lit(1)), F.sum(F.length("regex") + F.length("rule"))).first()
    return n <= BROADCAST_RULES and (chars or 0) <= BROADCAST_CHARS


def candidates(urls: DataFrame, index: DataFrame, broadcast: bool) -> DataFrame:
    """Each row of ``urls`` with each rule filed under one of its tokens, and once without a rule (regex null)
    where a token has none.  Beyond a broadcast, tokens are salted: a token of all urls meets its rules in RUNS tasks."""
    asked = urls.withColumn("token", F.explode(F.concat(F.array(F.lit("")), tokens(F.col("target")))))
    if broadcast:
        return asked.join(F.broadcast(index), "token", "left")
    salted = asked.withColumn("salt", F.pmod("rid", F.lit(RUNS)))
    spread = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(RUNS - 1).cast("long"))))
    return salted.join(spread, ["token", "salt"], "left")


def judge_urls(pages: DataFrame, rules: DataFrame, patterns: DataFrame, id_col: str = "page_id", url_col: str = "url",
               broadcast: bool | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern: one row per input row.

    ``rules``: (host, path, verdict); ``patterns``: (pattern, verdict); verdict is ``allow`` or
    ``block``.  ``rule`` is the longest (host, path) rule that fits (ties: the longer host; block
    before allow) and decides; where none fits, ``pattern`` is the longest pattern that matches
    and decides likewise; where none matches the verdict is ``allow``.  A null url, or one without ``://``, has
    an empty host and path.  Repeated rows give repeated results, an empty table an empty one;
    null ids stay; other columns are not looked at; rules with nulls are left out (a null path: empty).
    ``broadcast``: by default, decided by the rules' size.
    """
    host, path = url_parts(F.col(f"`{url_col}`").cast("string"))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("rid"))
    urls = urls.withColumn("target", F.concat("host", "path"))
    table = host_rules(rules).unionByName(pattern_rules(patterns)).distinct()
    index = rule_index(table, urls)
    met = candidates(urls, index, small(table) if broadcast is None else broadcast)
    met = met.where((F.col("token") == "") | F.rlike(F.col("target"), F.col("regex")))
    fits = F.rlike(F.col("target"), F.col("regex"))  # null without a rule
    rank = F.struct(F.length("rule").alias("size"), "head", "verdict", "rule")  # "block" > "allow"
    best = met.groupBy("rid").agg(
        *[F.first(c).alias(c) for c in ("page_id", "host", "path")],
        F.max(F.when(fits & (F.col("tier") == 0), rank)).alias("r"), F.max(F.when(fits & (F.col("tier") == 1), rank)).alias("p"))
    pattern = F.when(F.col("r").isNull(), F.col("p.rule"))
    return best.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                       F.coalesce("r.verdict", "p.verdict", F.lit("allow")).alias("verdict"), pattern.alias("pattern"))

