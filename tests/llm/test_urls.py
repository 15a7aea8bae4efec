from paperloom.llm.queries import URL_RULES
from paperloom.llm.urls import judge_urls, page_edges

PAGE = '<html><head><link rel="stylesheet" href="x.css"><link href="{}" rel="canonical"><title>t</title></head></html>'


def judged(spark, pages, more=()):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    edges = page_edges(df)
    if more:
        edges = edges.unionByName(spark.createDataFrame(more, "source string, target string"))
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, URL_RULES, edges).collect()}


def test_rules(spark):
    urls = [
        "http://Example.COM/en/1?x=/es/",
        "https://www.example.com/en/",
        "http://a.www.example.com/en/x#y",
        "http://notexample.com/en/1",
        "http://x.net/es/",
        "http://x.net/es",
        "http://com",
        "http://x.net:80/es/",
        "nonsense",
        None,
        "http://a/b://c",
    ]
    got = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert got == {
        0: ("example.com", "/en/1", "example.com/en/", "block"),
        1: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        2: ("a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        3: ("notexample.com", "/en/1", "com/", "allow"),
        4: ("x.net", "/es/", "net/es/", "block"),
        5: ("x.net", "/es", None, "allow"),
        6: ("com", "", None, "allow"),
        7: ("x.net:80", "/es/", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("a", "/b://c", None, "allow"),
    }


def test_blocks_pass_on_to_aliases(spark):
    pages = [
        (1, "http://one.org/a", PAGE.format("http://bad.net/es/1")),  # canonical is blocked
        (2, "http://two.org/a", PAGE.format("http://one.org/a")),  # an alias of an alias
        (3, "http://three.org/a#part", '<meta http-equiv="refresh" content="0; url=http://bad.net/fr/2">'),
        (4, "http://four.org/a", None),  # redirects, see below
        (5, "http://five.com/", PAGE.format("http://bad.net/fr/2")),  # its own rule comes first, and its word counts
        (6, "http://six.org/", PAGE.format("/other")),
        (7, "http://bad.net/es/1", ""),
        (8, "http://three.org/a", None),  # the same page without its fragment
    ]
    got = {k: v[3] for k, v in judged(spark, pages, [("http://four.org/a", "http://two.org/a"), (None, "http://x.org/"), ("no url", "http://x.org")]).items()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "allow"}
    without = {k: v[3] for k, v in judged(spark, [p for p in pages if p[0] != 5]).items()}
    assert without[3] == without[8] == "block" and without[4] == "allow"


def test_a_long_chain(spark):
    more = [(f"http://h{i}.org/", f"http://h{i + 1}.org/") for i in range(60)] + [("http://h60.org/", "http://x.net/es/")]
    got = judged(spark, [(0, "http://h0.org/", None), (1, "http://H30.org", None), (2, "http://other.org/", None)], more)
    assert [got[i][3] for i in range(3)] == ["block", "block", "allow"]


def test_links_are_found_in_their_forms(spark):
    forms = {
        "<LINK REL='canonical' HREF='http://b.org/x&amp;y'>": "http://b.org/x&y",
        "<link rel=canonical href=//b.org/x>": "http://b.org/x",
        '<link rel="canonical" href="sub/x">': "http://a.org/p/sub/x",
        '<link rel="canonical" href="?q=1">': "http://a.org/p/q?q=1",
        '<meta content="5;URL=/z" http-equiv=refresh >': "http://a.org/z",
        '<link rel="alternate" href="http://b.org/canonical">': None,
        '<link rel="canonical">': None,
    }
    df = spark.createDataFrame([("http://a.org/p/q", h) for h in forms], "url string, html string")
    got = sorted(r["target"] for r in page_edges(df).collect())
    assert got == sorted(t for t in forms.values() if t)


def test_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.net/es/", None, "mine", "theirs")] * 2, "page_id bigint, url string, html string, HOST string, name string")
    out = judge_urls(pages, URL_RULES, page_edges(pages))
    assert out.columns == ["page_id", "url", "html", "name", "host", "path", "rule", "verdict"]
    assert [r["verdict"] for r in out.collect()] == ["block", "block"]
    assert judge_urls(pages.filter("1 = 0"), URL_RULES, page_edges(pages.filter("1 = 0"))).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, [], page_edges(pages)).collect()} == {"allow"}


def test_every_name_a_page_gives_counts(spark):
    blocked = '<link rel="canonical" href="http://bad.net/es/1">'
    pages = [
        (1, "http://one.org/", f'<!-- <link rel="canonical" href=""> -->{blocked}'),
        (2, "http://two.org/", f'<link rel="canonical" href="http://two.org/own">{blocked}'),
        (3, "http://three.org/", blocked.replace("canonical", "alternate canonical")),
        (4, "http://four.org/", f"<!-- {blocked} --><script>document.write('{blocked}')</script><STYLE>{blocked}</STYLE>"),
        (5, "http://five.org/", blocked.replace("canonical", "canonicals") + blocked.replace("rel=", "data-rel=")),
        (6, "http://six.org/", '<meta http-equiv=refresh content="9; url=/x"><meta content=\'0;URL="http://bad.net/fr/\' http-equiv="Refresh">'),
        (7, "http://seven.org/", "<link rel=canonical>" + "<!-- canonical " + blocked),
        (8, None, blocked),
    ]
    got = {k: v[3] for k, v in judged(spark, pages).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "allow", 8: "allow"}
