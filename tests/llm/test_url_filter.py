import pytest

from tidemark.llm import url_filter

PAGES, LABELS = "page_id long, url string, html string", "doc_id long, quality int, toxic int"


def judged(spark, urls, labels=(), **kw):
    pages = spark.createDataFrame([(i, u, "") for i, u in urls], PAGES).repartition(3).selectExpr("*", "'x' AS host", "1 AS n")
    rows = url_filter.judge(pages, spark.createDataFrame(list(labels), LABELS), **kw).collect()
    return {r.page_id: r for r in rows}


def test_hosts_paths_and_rules(spark):
    cases = {
        1: ("HTTP://WWW.A.Org/x?y=http://b.com/", "www.a.org", "/x", "org/", "allow"),
        2: ("https://example.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        3: ("https://m.example.org/en/17#t", "m.example.org", "/en/17", "example.org/en/1", "block"),
        4: ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        5: ("http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
        6: ("http://a.com/de/9", "a.com", "/de/9", "com/de/", "block"),
        7: ("http://com/de/9", "com", "/de/9", "com/de/", "block"),
        8: ("http://a.org?q=/", "a.org", "", None, "allow"),
        9: ("http://a.com#/fr/", "a.com", "", None, "allow"),
        10: (None, "", "", None, "allow"), 11: ("", "", "", None, "allow"), 12: ("a.org/x", "", "", None, "allow"),
        13: ("://", "", "", None, "allow"), 14: ("x://é.ÀB.com/de/", "é.Àb.com", "/de/", "com/de/", "block"),
        15: ("http://a.net/" + "p" * 100_000, "a.net", "/" + "p" * 100_000, None, "allow"),
        16: ("a\nb://h\nk.net/x\ny", "h\nk.net", "/x\ny", None, "allow"), None: ("http://a.org/", "a.org", "/", "org/", "allow")}
    got = judged(spark, [(i, c[0]) for i, c in cases.items()] + [(1, cases[1][0])])
    assert {i: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()} == {i: c[1:] for i, c in cases.items()}


def test_registered_domains(spark):
    df = spark.createDataFrame([("a.b.example.com",), ("x.y.co.uk",), ("co.uk",), ("localhost",), ("",)], "h string")
    rows = df.select(url_filter.domain_of(df.h), url_filter.suffix_of(df.h)).collect()
    assert [tuple(r) for r in rows] == [("example.com", "com"), ("y.co.uk", "co.uk"), ("co.uk", "uk"), ("localhost", "localhost"), ("", "")]


def test_reputation_shrinks_small_hosts_and_blocks_bad_ones(spark):
    urls, labels, k = [], [], 0
    for host, n, bad in (("bad.site.net", 60, 55), ("good.site.net", 60, 2), ("few.fine.net", 2, 2), *((f"h{i}.ok.net", 40, 1) for i in range(9))):
        for i in range(n):
            urls.append((k, f"http://{host}/{k}"))
            labels.append((k, 0 if i < bad else 1, None))
            k += 1
    urls += [(9001, "http://new.ok.net/"), (9002, "http://never.seen/"), (9003, "http://bad.site.net/unlabelled")]
    got = judged(spark, urls, labels)
    assert got[9003].verdict == "block" and got[0].verdict == "block" and got[60].verdict == "allow"
    assert got[9001].level == "domain" and got[9001].verdict == "allow" and got[9002].level == "all"
    # two bad pages of two are no proof, if more certainty is asked for
    assert got[120].level == "host" and got[120].bad_rate < 0.9 and got[120].bound < got[0].bound
    strict = judged(spark, urls, labels, sds=2.0)
    assert strict[120].verdict == "allow" and strict[0].verdict == "block"


@pytest.mark.parametrize("urls", [[], [(1, "http://a.net/")]])
def test_no_outcomes(spark, urls):
    assert [r.verdict for r in judged(spark, urls).values()] == ["allow"] * len(urls)
