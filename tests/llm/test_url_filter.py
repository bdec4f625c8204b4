import random
import re

from logsift.llm.queries import URL_RULES
from logsift.llm.url_filter import PATTERNS, judge_urls

SCHEMA = "page_id long, url string, host string, token int, rule string"


def brute(url, rules, patterns):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and (path.startswith(p) if p else path == "" or path.startswith("/"))]
    if fit:
        _, _, v, r = max(fit)
        return host, path, r, v, None
    edge = {"^": "(?:^|[^A-Za-z0-9]|$)", "*": "(?s:.*)"}
    hits = [(len(p), 0, v, p) for v, p in patterns if re.search("".join(edge.get(c, re.escape(c)) for c in p), host + path)]
    return (host, path, None, max(hits)[2], max(hits)[3]) if hits else (host, path, None, "allow", None)


def frames(spark, rules, patterns):
    return (spark.createDataFrame(rules, "host string, path string, verdict string"),
            spark.createDataFrame(patterns, "verdict string, pattern string"))


def check(spark, urls, rules, patterns, **how):
    rows = [(i if i % 5 else None, u, "h", 1, "r") for i, u in enumerate(urls)]
    out = judge_urls(spark.createDataFrame(rows, SCHEMA).repartition(3), *frames(spark, rules, patterns), **how).collect()
    want = [(i, *brute(u, rules, patterns)) for i, u, *_ in rows]
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, want))


def odd_urls():
    return [None, "", "no scheme", "://", "http://", "http://ORG", "http://org/", "http://a.ORG/x", "http://xorg/", "http://Example.org/es/1",
            "http://example.org/es", "http://m.example.org/en/12", "http://example.org/en/21", "http://example.org?x=/es/", "http://example.com/de/1#x",
            "http://example.com/fr/://a.org/", "http://u@casino-win.example.net:80/en", "http://casino-royale.net/casino", "x://ads.track/é\n/ads-x/track",
            "http://ads-track.example.net/", "http://example.net/anti-spam", "http://anti.spam.net/", "http://a.b/" + "z" * 100_000 + "/xxx/"]


def test_contract_rules_match_brute_force(spark):
    rng = random.Random(3)
    hosts = ["org", "example.org", "m.example.org", "example.com", "com", "Example.NET", "casino-win.net", "adult-education.net", "é.org", "xcom"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12/", "/en/2", "/fr/", "/de/x", "/poker/", "/a//spam", "?q=1", "#top"]
    urls = odd_urls() + [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/es/', '#x'])}" for _ in range(300)]
    check(spark, urls, URL_RULES, list(PATTERNS))
    check(spark, urls, URL_RULES, list(PATTERNS), broadcast=False)


def test_random_rules_match_brute_force_and_both_joins_agree(spark):
    rng = random.Random(4)
    part = lambda: rng.choice(["a", "b", "ab", "c1", "é", "x-y", "org"])
    rules = [(".".join(part() for _ in range(rng.randint(1, 3))), rng.choice(["", "/", "/a", "/b/", "/a.b/c"]), rng.choice(["allow", "block"])) for _ in range(40)]
    rules = list({r[:2]: r for r in rules}.values())
    patterns = [(rng.choice(["allow", "block"]), "".join(rng.choice(["^", "*", "a", "b", "ab", ".", "-", "c1"]) for _ in range(rng.randint(1, 6)))) for _ in range(30)]
    patterns += [("block", "*"), ("allow", "^")]  # without any literal token
    urls = ["h://" + ".".join(part() for _ in range(rng.randint(1, 4))) + rng.choice(["", "/", "/a", "/ab/", "/b/c", "/a.b/c1"]) for _ in range(400)]
    check(spark, urls, rules, patterns)
    check(spark, urls, rules, patterns, broadcast=False)


def test_empty_tables_and_null_rules(spark):
    rules, patterns = frames(spark, URL_RULES, list(PATTERNS))
    pages = spark.createDataFrame([], SCHEMA)
    assert judge_urls(pages, rules, patterns).count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/", "", 0, ""), (1, "http://a.org/", "", 0, "")], SCHEMA)
    out = judge_urls(pages, rules.limit(0), patterns.limit(0)).collect()
    assert [(r.rule, r.verdict) for r in out] == [(None, "allow")] * 2
    nulls = spark.createDataFrame([(None, "/", "block"), ("org", None, "block"), ("org", "/", None)], rules.schema)
    assert [r.rule for r in judge_urls(pages, nulls, patterns).collect()] == ["org"] * 2
