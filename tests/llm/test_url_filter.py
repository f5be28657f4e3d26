import re

from evalspark.llm import url_filter


def brute(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[0]), default=None)
    return host, path, best and best[0], best and best[3]


URLS = [
    "http://A.Example.NET/en/1", "http://example.net/de/", "http://notexample.net/en/", "https://x.example.com/de/2?q#f",
    "http://example.com/fr/3", "http://org/fr/", "http://a.org/fr/x", "http://borg/fr/x", "http://net", "http://net/",
    "http://x.net?a/b", "http://x.net#/en/", "ftp://u://v.org/fr/", "no scheme", "", None, "://", "http:///en/",
    "http://ÜMLAUT.org/fr/É", "http://a.b/" + "x" * 50_000, "http://a.org/fr\n/x", "http://a\n.net/",
]


def pages(spark, urls):
    rows = [(i, u, "<p>", "h", 1.0, "v") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, _features double, verdict string")


def test_rules_match_brute_force(spark):
    found = {r.page_id: r for r in url_filter.judge_urls(pages(spark, URLS)).collect()}
    assert len(found) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute(u)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), u
        assert found[i].verdict == verdict if rule else found[i].verdict in ("allow", "block")


def test_trees_learn_a_lexical_pattern(spark):
    # Ruled: .org/fr/ with short ids is allowed, .net/ with long ids and parameters is blocked.
    urls = [f"http://s{i}.org/fr/{i}" for i in range(80)]
    urls += [f"http://s{i}.net/{i:012d}?a=1&b=2&c=3" for i in range(80)]
    urls += [f"http://s{i}.edu/{i}" for i in range(20)] + [f"http://s{i}.edu/{i:012d}?a=1&b=2&c=3" for i in range(20)]
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(pages(spark, urls)).collect()}
    assert [found[i] for i in range(160, 180)].count("allow") >= 18
    assert [found[i] for i in range(180, 200)].count("block") >= 18


def test_without_labels_and_empty(spark):
    only = url_filter.judge_urls(pages(spark, ["http://a.edu/x", None])).collect()
    assert {r.verdict for r in only} == {"allow"}
    assert {r.verdict for r in url_filter.judge_urls(pages(spark, ["http://a.net/x", "http://b.edu/"])).collect()} == {"block"}
    assert url_filter.judge_urls(pages(spark, ["x"]).limit(0)).collect() == []


def test_entropy_covers_the_whole_host(spark):
    import collections
    import math

    hosts = ["", "a", "aab.org", "a" * 253 + "bcdefg" * 50, "ab" * 500 + "é😀", "x" * 20_000]
    rows = url_filter.with_host_path(spark.createDataFrame([(f"http://{h}/p",) for h in hosts], "url string"))
    found = {r.host: r.e for r in rows.select("host", url_filter.features(rows.url)["_entropy"].alias("e")).collect()}
    for h in hosts:
        want = -sum(n / len(h) * math.log2(n / len(h)) for n in collections.Counter(h).values())
        assert abs(found[h] - want) < 1e-9, h[:20]
