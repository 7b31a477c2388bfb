from gleanframe.llm import url_filter as u
from gleanframe.llm.components import components
from gleanframe.llm.queries import RULES

PAGES = "page_id bigint, url string, html string, host string, a string"


def judged(table, rows, links=None):
    pages = table([(n, url, html, "x", "y") for n, url, html in rows], PAGES)
    out = u.judge(pages, RULES, links if links is not None else u.alias_links(pages))
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}


def test_rules_hosts_paths_and_nulls(table):
    got = judged(table, [
        (1, "http://WWW.Example.com/en/1?q", None), (2, "https://m.example.com/en/x", ""),
        (3, "http://badexample.com/en/", None), (4, "http://a.net/es/1#f", None), (5, None, None),
        (6, "no scheme", None), (7, "http://a.com", None), (8, "http://net/fr/", None),
        (9, "http://a.net/de/", None)])
    assert got == {
        1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        2: ("m.example.com", "/en/x", "example.com/en/", "block"),
        3: ("badexample.com", "/en/", "com/", "allow"), 4: ("a.net", "/es/1", "net/es/", "block"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("a.com", "", None, "allow"),
        8: ("net", "/fr/", "net/fr/", "block"), 9: ("a.net", "/de/", None, "allow")}


def test_decisions_reach_aliases(table):
    canonical = "<LINK href='{}' rel=canonical>"
    refresh = '<meta http-equiv="refresh" content="0; URL={}">'
    got = judged(table, [
        (1, "http://a.org/1", canonical.format("http://b.net/es/1#top")),  # alias of a blocked URL
        (2, "http://a.org/2", refresh.format("/1")),  # two steps away
        (3, "http://c.org/1", canonical.format("http://x.net/fr/1")),  # one alias blocked,
        (4, "http://c.org/2", canonical.format("http://c.org/1")),
        (5, "http://c.org/2", refresh.format("http://y.com/")),  # one allowed
        (6, "http://x.net/fr/1", None),  # its own rule stands
        (7, "http://d.org/", '<link rel="stylesheet" href="http://b.net/es/1">canonical')])
    assert {n: v[3] for n, v in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "allow"}


def test_no_rows(table):
    assert judged(table, []) == {}


def test_components_of_chains_stars_and_loops(spark):
    chain = [(n, n + 1) for n in range(100, 164)]
    star = [(7, n) for n in range(200, 240)] + [(240, 200), (240, 240), (7, 200)]
    odd = [(None, 1), (1, None), (5, 5)]
    links = spark.createDataFrame(chain + star + odd, "a bigint, b bigint")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{n: 100 for n in range(100, 165)}, 7: 7, **{n: 7 for n in range(200, 241)}}


def test_native_plan(table):
    pages = table([(1, "http://a.com/", "x", "", "")], PAGES)
    plan = u.judge(pages, RULES, u.alias_links(pages))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_long_and_repeated_urls(table):
    long = "http://a.net/es/" + "x" * 200_000
    got = judged(table, [(1, long, None), (1, long, None), (None, "http://b.com/", "<link rel=canonical href=" + long)])
    assert got[1][2:] == ("net/es/", "block") and got[None][2:] == ("com/", "allow")


def test_names_of_aliases(spark):
    names = {"HTTP://Other.ORG/Path?Q#f": "http://other.org/Path?Q", "http://a.org:80": "http://a.org/",
             "https://a.org:443/x": "https://a.org/x", "https://a.org:80/x": "https://a.org:80/x",
             "http://a.org?q": "http://a.org/?q", "/relative#f": "/relative", "": "", None: None}
    rows = spark.createDataFrame([(n,) for n in names], "url string").select("url", u.name_of(u.F.col("url")).alias("name"))
    assert {r.url: r.name for r in rows.collect()} == names


def test_one_alias_however_it_is_written(table):
    canonical = '<link rel="canonical" href="{}">'
    got = judged(table, [
        (1, "HTTP://OTHER.org/p", None),  # named by 2, which names a blocked one, too
        (2, "http://x.org/1", canonical.format("http://other.org/p")),
        (3, "http://x.org/1", canonical.format("http://b.net/es/")),
        (4, "http://y.org/", canonical.format("http://b.net/&#102;&#x72;&#x2F;?a=1&amp;b=2")),
        (5, "http://c.org", canonical.format("http://d.org:80")),
        (6, "http://d.org/#top", canonical.format("http://b.net/fr/")),
        (7, "http://free.org/", "<!-- " + canonical.format("http://b.net/fr/") + " -->"),
        (8, "http://also.org/", "<script>var x = '" + canonical.format("http://b.net/fr/") + "';</script>")])
    assert {n: v[3] for n, v in got.items()} == {
        1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow"}
