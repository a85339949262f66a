import os
import re
import sys

from weirframe.llm import url_rules as U
from weirframe.llm.queries import SQL, op9_url_filter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import compare  # noqa: E402


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        r for r in U.SITE_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    if rule:
        return host, path, rule.name, rule.verdict
    bad = bool(url) and "://" in url and any(re.search(r.pattern, url.lower(), re.DOTALL) for r in U.PATTERN_RULES)
    return host, path, None, U.BLOCK if bad else U.ALLOW


def test_given_pages_equal_sql(spark):
    assert compare(spark, "/root/testdata/sf0.1", op9_url_filter, SQL["op9_url_filter"]) > 0


def test_index_finds_what_all_rules_find(spark):
    urls = [
        None, "", "no scheme.org/en/1", "http://", "://", "http://EXAMPLE.org/en/12?x#y", "https://a.example.org/es/#z",
        "http://b.org", "http://b.org/", "http://x.com/de/1", "http://com/fr/", "http://xcom/fr/a", "http://x.com?/de/", "a://b://c.com/de/",
        "https://blog.cheap-pills.example.net/en/1", "https://pills-cheap.example.net/", "http://ads-track.net/x", "http://adstrack.net",
        "http://free-bets.io:80/", "http://user@spam-farm.net/x", "http://x.net/spam.html", "http://casino.net", "http://myCASINO-win.net/",
        "http://win-CASINO.net/", "http://x.net/?aff_id=1&subid=2", "http://x.net/wp-content/a/b.EXE?x", "http://x.net/wp-content/a.txt",
        "http://é.net/\n/wp-content/\n.apk", "http://" + "a" * 200_000 + ".net/",
    ]
    pages = spark.createDataFrame([(k, u, 1) for k, u in enumerate(urls)] + [(None, None, 1), (4, "://", 1)], "page_id long, url string, rule int")
    found = U.judge(pages).collect()
    assert len(found) == len(urls) + 2
    for r in found:
        if r["page_id"] is not None:
            assert tuple(r)[1:] == plain(urls[r["page_id"]]), urls[r["page_id"]]
        else:
            assert tuple(r)[1:] == plain(None)
    assert U.judge(pages.limit(0)).count() == 0


def test_rules_lie_under_their_rarest_token():
    rules = (U.PatternRule("a-b", ("a", "b")), U.PatternRule("b", ("b",)), U.SiteRule("x.b", "/a/c", U.BLOCK), U.PatternRule(".", ()))
    assert U.index_of(rules, {"a": 3, "b": 5, "x": 9}) == {"a": [rules[0], rules[2]], "b": [rules[1]], None: [rules[3]]}
    assert U.index_of(rules, {"a": 9, "b": 5, "x": 2})["x"] == [rules[2]]


def test_tokens_of_site_rules_stand_whole():
    assert U.SiteRule("example.org", "/en/1", U.BLOCK).tokens == ("example", "org", "en")
    assert U.SiteRule("com", "/fr/", U.ALLOW).tokens == ("com", "fr")


def test_rule_lists_are_parameters(spark):
    rules = (U.SiteRule("b.net", "/", U.BLOCK), U.SiteRule("a.b.net", "/x", U.ALLOW), U.SiteRule("-", "/", U.BLOCK))
    urls = ["http://b.net/", "http://a.b.net/xy", "http://a.b.net/y", "http://ab.net/", "http://A.b.NET/X", "http://-/", "http://b.net", "http://c.net/spam"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in U.judge(pages, rules, ()).collect()}
    assert [found[k] for k in range(len(urls))] == [
        ("b.net/", "block"), ("a.b.net/x", "allow"), ("b.net/", "block"), (None, "allow"), ("b.net/", "block"), ("-/", "block"),
        (None, "allow"), (None, "allow"),
    ]
