import math
import random

import pytest

from snapline.llm import urls as U
from snapline.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:] if rest[cut : cut + 1] == "/" else ""
    for c in "?#":
        path = path.split(c, 1)[0]
    return host, path


def fitting(host, path):
    best = None
    for verdict, rule in URL_RULES:
        domain, _, prefix = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best


URLS = [
    "http://a.example.org/en/12?x=1", "https://EXAMPLE.org/es/", "http://example.org/es", "http://b.org", "http://b.org/", "http://x.com/de/1#t",
    "HTTP://X.COM/fr/?a=b&c=d", "http://notexample.org/en/1", "http://myorg/fr/1", "no scheme/de/", None, "", "://", "http://?q=/fr/", "http://com/de/",
    "ftp://u@h.com:80/de/a//b", "http://h.com?x=http://y.org/", "http://É.com/fr/é\nz", "http://a.com/fr/x", "x://y://z.org/a",
]


@pytest.fixture(scope="module")
def pages(llm):
    return llm.createDataFrame([(i, u, "html") for i, u in enumerate([*URLS, *URLS[:3]])], "page_id long, url string, host string")


def test_hosts_paths_and_rules(pages):
    got = {r.page_id: r for r in U.filter_urls(pages, URL_RULES).collect()}
    assert len(got) == pages.count()
    for i, url in enumerate([*URLS, *URLS[:3]]):
        host, path = split(url)
        rule = fitting(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule[1] if rule else None), url
        assert got[i].verdict == rule[0] if rule else got[i].verdict in ("allow", "block")


def test_features(llm):
    df = llm.createDataFrame([("http://a-b.c9.example.org/x/y?p=1&q=2",)], "url string")
    host, path = U.host_and_path("url")
    row = U.lexical(df.withColumns({"host": host, "path": path}), "url", "host", "path").first()
    url = "http://a-b.c9.example.org/x/y?p=1&q=2"
    share = [url.count(c) / len(url) for c in set(url)]
    assert (row.suffix, row.depth, row.parameters, row.hyphens, row.labels) == ("example.org", 2, 3, 1, 4)
    assert abs(row.entropy + sum(p * math.log2(p) for p in share)) < 1e-9 and abs(row.digits - 3 / len(url)) < 1e-9


def test_trees_learn_from_labels(llm):
    drawn = random.Random(1)
    spam = lambda i: f"http://w{i}.cheap-{drawn.randrange(10**6)}-pills.net/{drawn.randrange(10**9)}?a=1&b=2&c={i}"
    good = lambda i: f"http://site.example.net/en/page{i % 10}"
    labelled = llm.createDataFrame([(spam(i) if i % 2 else good(i), i % 2) for i in range(200)], "url string, blocked int")
    pages = llm.createDataFrame([(i, spam(i) if i % 3 else good(i)) for i in range(60)], "page_id long, url string")
    got = U.filter_urls(pages, (), labelled).collect()
    assert sum((r.verdict == "block") == bool(r.page_id % 3) for r in got) >= 57


def test_plan_stays_in_the_jvm(pages):
    plan = U.filter_urls(pages, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_and_one_sided(llm, pages):
    assert U.filter_urls(pages.where("false"), URL_RULES).count() == 0
    assert {r.verdict for r in U.filter_urls(pages, ()).collect()} == {"allow"}
    assert {r.verdict for r in U.filter_urls(pages, [("block", "org/")]).collect()} == {"block"}
