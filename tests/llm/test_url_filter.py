import random
import re

import pytest

from emporium.llm.url_filter import UrlRule, judge

RULES = [
    UrlRule("allow", "com"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr"), UrlRule("allow", "net", "/fr/a/"), UrlRule("block", "com", "/"),
]


def brute_force(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.host), len(r.path), r.verdict), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


@pytest.mark.parametrize("limit", [500_000, 0])
def test_longest_rule_wins(spark, limit):
    rnd = random.Random(6)
    hosts = ["com", "example.com", "WWW.Example.com", "a.b.example.com", "notexample.com", "net", "x.net", ".net", "net.", "org", "", "É.com", "example.com:80"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/1?q=/fr/", "/fr", "/france", "/fr/a/b", "/fr/a", "//fr/", "#/es/", "/es", "?/es/"]
    urls = [f"{rnd.choice(['http', 'ftp', ''])}://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(600)]
    urls += [None, "", "no scheme", "://", "a://b://net/es/", urls[0], urls[0], "http://x.net/es/" + "y" * 50_000, "http://" + "a." * 2000 + "com/"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(None, "http://net/es/", "r")], "page_id long, url string, rule string").repartition(3)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(pages, RULES, broadcast_rules=limit).collect()}
    for i, u in enumerate(urls):
        assert got[i] == brute_force(u), u
    assert got[None] == ("net", "/es/", "net/es/", "block")


def test_default_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert judge(pages, [], default="block").first().verdict == "block"
    assert judge(pages.limit(0), RULES).count() == 0
