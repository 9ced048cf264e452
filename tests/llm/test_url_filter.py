import random

from reviewgrain.llm import url_filter


def plain(url, rules):
    host, path = url_filter.parts(url)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fits)[2], max(fits)[3]) if fits and host else (None, "allow")


def test_cascade_is_exact(spark):
    rng = random.Random(3)
    universe = [f"key{i}" for i in range(3000)]
    listed = set(rng.sample(universe, 300))
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    levels = url_filter.build(frame(sorted(listed)), frame(universe), first_rate=0.3)
    assert len(levels) > 2 and all(url_filter.listed_in(levels, k) == (k in listed) for k in universe)
    assert url_filter.build(frame([]), frame(universe)) == [] and not url_filter.listed_in([], "key1")


def test_rules_against_plain_matching(spark):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "b.net", "")]
    rng = random.Random(4)
    hosts = ["example.com", "www.example.com", "a.www.Example.com", "xample.com", "b.net", "c.b.net", "a..net", "", "org", "com", "notcom"]
    paths = ["", "/", "/en/", "/en", "/es/x", "/en/y/z?q=/es/", "#/en/", "?x", "/EN/"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(150)] + [None, "", "nothing", "://", "a://b://c/es/", "http://x.net/es/\nmore"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    found = {r.page_id: r for r in url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()}
    for i, url in enumerate(urls):
        assert (found[i].host, found[i].path) == url_filter.parts(url), url
        assert (found[i].rule, found[i].verdict) == plain(url, rules), url


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/")], "page_id long, url string")
    none = url_filter.rule_table(spark, [])
    assert [(r.rule, r.verdict) for r in url_filter.judge(pages, none).collect()] == [(None, "allow")] * 2
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark, [("block", "com", "/")])).count() == 0
