import re

from hourstar.llm.queries import RULES
from hourstar.llm.url_filter import index_rules, judge

URLS = [
    None, "", "example.com/en/1", "https://example.com/en/1", "https://EXAMPLE.com/en/1?x=/fr/", "https://a.www.example.com/en/",
    "http://www.example.com/en/", "http://www.example.com", "http://x.net/es/a", "http://x.net/es", "http://net/fr/", "http://xnet/fr/",
    "http://a.com#/en/", "http://a.com/", "ftp://b.org/net/es/", "://example.com/en/", "http://example.com:80/en/", "http://example.com/EN/",
    "http://münchen.com/en/", "http://example.com/en/" + "a/" * 20_000, "http://a\nb.com/en/",
]


def expected(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"(/[^?#]*)?", rest[len(host):]).group() or ""
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = []
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((-len(rule), verdict != "block", rule, verdict))
    best = min(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_against_brute_force(spark):
    more = RULES + [("a.com/", "block"), ("münchen.com/", "block"), ("com/e", "block"), ("com/e", "allow"), ("b.com/en/", "block")]
    df = spark.createDataFrame([(i % 5, u, "h", 3) for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, row int")
    for rules in (RULES, more):
        rows = judge(df, spark.createDataFrame(rules, "rule string, verdict string"), keep=["page_id", "url"]).collect()
        assert len(rows) == len(URLS) * 2
        for r in rows:
            assert (r.host, r.path, r.rule, r.verdict) == expected(r.url, rules), r.url


def test_empty_tables(spark):
    none = spark.createDataFrame([], "rule string, verdict string")
    urls = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in judge(urls, none).collect()] == ["allow"]
    assert judge(urls.limit(0), none).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    index = {r.rule: r.token for r in index_rules(spark.createDataFrame(RULES, "rule string, verdict string")).collect()}
    assert index["www.example.com/en/"] == "www" and index["net/es/"] == "es" and index["com/"] == "com"
    assert {r.token for r in index_rules(spark.createDataFrame([("", "block"), (None, "block")], "rule string, verdict string")).collect()} == {""}
