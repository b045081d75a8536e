import re

import numpy as np

from citeweave.llm import urls

RULES = urls.RULES


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


URLS = [
    "http://a.example.net/en/x", "HTTP://Example.NET/en/", "http://example.net/fr/", "http://notexample.net", "http://net/", "http://net", "https://x.org/fr/1",
    "https://x.org/en/1", "http://m.example.com/de/?a=1", "http://example.com/de", "ftp://É.org/fr/", None, "", "no scheme", "http://", "x://y://z/fr/", "http://h.org?q=/fr/", "http://h.org#a/b", "http://h.com/a\nb?c\nd",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").repartition(3)
    got = {r.page_id: r for r in urls.judge(pages, pages.where("page_id < 0")).collect()}
    for i, u in enumerate(URLS):
        host, path = brute_host_path(u)
        fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u


def test_list_blocks_exactly_its_canonical_urls(spark):
    rows = [(i, f"http://{'www.' if i % 2 else ''}s{i % 50}.com/p{i % 7}{'/' if i % 3 else ''}{'?utm_source=x' if i % 5 == 0 else ''}#t") for i in range(700)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    listed = spark.createDataFrame([(f"https://S{k}.com:443/p{k % 7}",) for k in range(0, 50, 3)] + [(None,)], "url string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, listed).collect()}
    for i, _ in rows:
        assert got[i] == ("block" if i % 50 % 3 == 0 and i % 7 == (i % 50) % 7 else "allow")


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    bloom = urls.BlockedBloom(spark.range(20_000).withColumnRenamed("id", "key").selectExpr("xxhash64(key) AS key"), "key")
    keys = np.array([r.k for r in spark.range(40_000).selectExpr("xxhash64(id) AS k").collect()])
    hit = bloom.may_hold(keys)
    assert hit[:20_000].all() and hit[20_000:].mean() < 0.03
    full = urls.BlockedBloom(spark.range(5_000).selectExpr("xxhash64(id) AS key"), "key", most_bytes=64)
    assert full.blocks == 1 and full.may_hold(keys[:5_000]).all()


def test_odd_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none, none).count() == 0
    same = spark.createDataFrame([(1, "http://a.com/x")] * 50 + [(None, None)], "page_id long, url string").selectExpr("*", "1 AS host", "2 AS path", "'x' AS name", "3 AS possible")
    assert [r["count"] for r in urls.judge(same, same).groupBy("verdict").count().orderBy("count").collect()] == [1, 50]
