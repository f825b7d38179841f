import random

from lagscope.llm import url_filter
from lagscope.llm.base import table
from lagscope.llm.oracle import URL_FILTER

from .cases import in_duckdb, plain, rows_of

COLUMNS = ["page_id", "host", "path", "rule", "verdict"]


def pages(spark, urls):
    rows = [(i, u, "<p>", "clash", "clash") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, key string")


def parsed(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    at = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:]
    end = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return host, path[:end]


def judged(url, rules, default="allow"):
    host, path = parsed(url)
    fits = [
        (len(h) + len(p), h + p, v)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    size, rule, verdict = max(fits, default=(0, None, default))
    return host, path, rule, verdict


def check(spark, urls, rules):
    got = url_filter.judge(pages(spark, urls), url_filter.rule_table(spark, rules)).collect()
    expected = sorted(((i, *judged(u, rules)) for i, u in enumerate(urls)), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == expected


ODD = [
    None,
    "",
    "no scheme",
    "http://",
    "http://NET",
    "http://net/",
    "http://a.net?x=/",
    "http://internet/",
    "https://x.example.net/en/1?q#f",
    "https://example.net/EN/",
    "http://Example.COM/de/a/b",
    "http://com.example/de/",
    "http://a.org/fr/" + "long/" * 20_000,
    "http://" + "a." * 3000 + "net/",
    "x://ünïcode.net/en/",
    "http://user@example.net:80/en/",
    "http://a..net//en/",
    "http://b.net/#",
]


def test_odd_urls(spark):
    check(spark, ODD * 2, url_filter.RULES)


def test_nested_rules(spark):
    rng = random.Random(2)
    label = lambda: rng.choice("abc")
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda n: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, n)))
    rules = {(host(3), path(4)): rng.choice(["allow", "block"]) for _ in range(60)}
    check(spark, [f"http://{host(4)}{path(7)}" for _ in range(400)], [(*k, v) for k, v in rules.items()])


def test_whole_table_like_sql(spark):
    docs = table(spark, "/root/testdata/sf0.001", "pages")
    found = plain(url_filter.judge(docs, url_filter.rule_table(spark)))
    frame = docs.toPandas()
    assert rows_of(found, COLUMNS) == rows_of(in_duckdb(URL_FILTER, pages=frame), COLUMNS)


def test_blocking_wins_and_broken_rules_fit_nothing(spark):
    rules = [("a.b", "/", "allow"), ("a.b", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("b", None, "block")]
    got = url_filter.judge(pages(spark, ["http://a.b/", "http://b/"]), url_filter.rule_table(spark, rules))
    assert sorted((r.page_id, r.rule, r.verdict) for r in got.collect()) == [(0, "a.b/", "block"), (1, None, "allow")]


def test_nothing(spark):
    rules = url_filter.rule_table(spark)
    assert url_filter.judge(pages(spark, []), rules).count() == 0
    none = url_filter.judge(pages(spark, ["http://a.net/"]), rules.limit(0)).collect()
    assert [r.verdict for r in none] == ["allow"]


def test_rules_for_all_paths_of_a_host(spark):
    rules = [("net", "", "block"), ("example.net", "", "allow"), ("example.net", "/x", "block"), ("net", "/a", "allow")]
    urls = ["http://net", "http://net/x", "http://network/x", "http://a.net?q", "http://example.net", "http://example.net/xy"]
    urls += ["http://net.work/", "http://an.example.net/a", "http://example.network/x", "http://net/a/b", "http://x.net/a"]
    check(spark, urls, rules)
