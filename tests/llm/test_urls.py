import pytest
from isoloir.llm import url_filter

URLS = [
    (1, "http://A.Example.NET/en/x?q#f"),
    (2, "https://example.net/EN/x"),
    (3, "http://net/"),
    (4, "http://net"),
    (5, "http://xnet/"),
    (6, "ftp://u:p@sub.example.com:80/de/1"),
    (7, "http://example.com/de"),
    (8, "http://x.example.com/de/y://z.net/"),
    (9, "http://lemonde.org/fr/"),
    (10, "http://lemonde.org?/fr/"),
    (11, "no scheme.net/"),
    (12, None),
    (13, ""),
    (14, "://"),
    (15, "a\nb://C.NET/\n?x"),
    (16, "http://é.Ö.net/é"),
    (17, "http://x.com/" + "long/" * 20_000),
    (17, "http://x.com/" + "long/" * 20_000),
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    found = None
    for name in url_filter.RULES:
        h, _, p = name.partition("/")
        fits = (host == h or host.endswith("." + h)) and path.startswith("/" + p)
        if fits and (found is None or len(name) > len(found)):
            found = name
    return found


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*u, "x", 1, 2) for u in URLS]
    return spark.createDataFrame(rows, "page_id long, url string, host string, slots int, rule int")


def test_rules_match_brute_force(pages):
    judged = url_filter.judge(pages, url_filter.UrlModel()).collect()
    want = []
    for i, url in URLS:
        host, path = parts(url)
        want.append((i, host, path, rule(host, path)))
    got = [(r.page_id, r.host, r.path, r.rule) for r in judged]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in judged:
        assert r.verdict == (url_filter.RULES[r.rule] if r.rule else "block" if r.score >= 0.5 else "allow")
        assert (r.slots,) == (1,)


def test_scores_match_brute_force(spark):
    urls = [(k, f"http://h{k % 7}.{'bad' if k % 2 else 'good'}.example/p{k}") for k in range(200)]
    labelled = spark.createDataFrame(
        [(u, "block" if "bad" in u else "allow") for _, u in urls[:120]], "url string, verdict string"
    )
    model = url_filter.train(labelled)
    judged = url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), model, rules={})
    rows = judged.collect()
    assert all((r.verdict == "block") == ("bad" in r.url) for r in rows)
    slots = url_filter.with_slots(judged, "host", "path", "s").select("score", "s").collect()
    from math import exp, sqrt

    for r in slots:
        z = sum(model.weights[k] for k in r.s) / sqrt(len(r.s)) + model.bias
        assert abs(r.score - 1 / (1 + exp(-z))) < 1e-9


def test_grams_are_those_of_the_parts(spark):
    df = spark.createDataFrame([("ab", "/c"), ("", "")], "host string, path string")
    sizes = [len(r.s) for r in url_filter.with_slots(df, "host", "path", "s").collect()]
    # Four characters with the end marks: three pairs, two triples, one of four; and so for the path.
    assert sizes == [12, 2]


def test_no_pages_and_no_labels(pages):
    none = pages.where("false")
    model = url_filter.train(url_filter.labelled_urls(none, url_filter.RULES))
    assert model == url_filter.UrlModel()
    assert url_filter.judge(none, model).collect() == []


def test_no_python_in_the_plan(pages):
    plan = url_filter.judge(pages, url_filter.UrlModel())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_labelled_table_is_bounded(spark):
    pages = spark.range(5000).selectExpr("concat('http://h', id, '.net/') AS url")
    same = pages.selectExpr("'http://one.net/' AS url")
    labelled = url_filter.labelled_urls(pages.union(same), url_filter.RULES)
    assert labelled.count() == url_filter.PER_VERDICT == labelled.distinct().count()
