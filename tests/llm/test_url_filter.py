from tillroll.llm.queries import URL_RULES
from tillroll.llm.url_filter import judge


def verdicts(spark, rows, rules=URL_RULES, redirects=None):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, node string")
    return {r.page_id: tuple(r)[1:] for r in judge(df, rules, redirects).collect()}


def test_rules_and_parsing(spark):
    got = verdicts(spark, [(1, "http://A.Example.ORG/es/1?q#f", None), (2, "https://example.org/en/12", ""), (3, "x://net", "a"), (4, "no scheme", "b"), (5, None, None),
                           (6, "http://shop.com/de/x", None), (7, "http://com/fr/", None), (8, "http://notexample.org?/es/", None), (9, "http://notexample.org/es/", None), (6, "http://shop.com/de/x", None)])
    assert got == {1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"),
                   3: ("net", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("shop.com", "/de/x", "com/de/", "block"),
                   7: ("com", "/fr/", "com/fr/", "allow"), 8: ("notexample.org", "", None, "allow"), 9: ("notexample.org", "/es/", "org/", "allow")}


def test_decisions_reach_aliases(spark):
    link = '<html><LINK href="%s" rel="canonical"></html>'
    rows = [(1, "http://a.net/1", link % "http://b.net/x"), (2, "http://b.net/x/", link % "//spam.com/de/1"), (3, "http://a.net/1.html?utm_source=f", None),
            (4, "http://c.net/p/q", '<meta http-equiv="refresh" content="0; url=r">'), (5, "https://www.c.net/p/r#top", link % "http://d.com/de/"), (6, "http://c.net/p/s", link % "/p/q"),
            (7, "http://e.net/", link % "http://ok.org/"), (8, "http://f.net/", None), (9, "http://e.net", link % "http://d2.com/de/z"), (10, "http://d2.com/de/z", "")]
    got = {k: v[-1] for k, v in verdicts(spark, rows, redirects=spark.createDataFrame([("http://f.net/", "http://c.net/p/q"), (None, "http://f.net")], "url string, target string")).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 8: "block",  # chains of links
                   7: "allow", 9: "allow", 10: "block"}  # an explicit allow goes before; an own rule before all


def test_empty(spark):
    assert verdicts(spark, []) == {}
