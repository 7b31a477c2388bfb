"""URL expressions against the standard library."""

from urllib.parse import parse_qs, urlencode, urljoin, urlparse

from pyspark.sql import functions as F

from gleanframe.functions import text, urls
from gleanframe.operators import frontier


def test_resolve_equals_the_standard_library(spark):
    bases = ["http://h.example/a/b/c?q=1#f", "https://h.example", "https://h.example:81/x/", "http://h.example/?p=2"]
    hrefs = ["", "/x", "x", "./x", "../x", "../../../x", "x/../y/./z", "/a/../b", "?n=3", "#top", "//o.example/p",
             "https://o.example/q", "mailto:a@b.c", "x?y=../z", "..", ".", "a/..", "/x/.", "é x/ü", "x#a?b"]
    pairs = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(pairs, "base string, href string")
    got = df.select("*", urls.resolve(F.col("base"), F.col("href")).alias("r")).collect()
    assert [(g.base, g.href, g.r) for g in got] == [(b, h, urljoin(b, h)) for b, h in pairs]


def test_page_parameter_equals_the_standard_library(spark):
    cases = ["http://h/x", "http://h/x?page=3", "http://h/x?a=1&page=4&page=5", "http://h/x?page=&page=6",
             "http://h/x#?page=7", "http://h/x?mypage=8", "http://h/x?page=9#page=1", "http://h/a b?page=2"]
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    got = [r.n for r in df.select(urls.page_parameter(F.col("u")).alias("n")).collect()]
    assert got == [int(parse_qs(urlparse(c).query).get("page", [1])[0]) for c in cases]
    bad = spark.createDataFrame([("http://h/x?page=two",)], "u string")
    assert bad.select(urls.page_parameter(F.col("u"))).first()[0] is None


def test_encoding_equals_the_standard_library(spark):
    value = "a b&c=d/é~*'()_.-+%"
    df = spark.createDataFrame([(value,)], "v string")
    url = df.select(urls.with_parameters("http://h/x", {"k": F.col("v"), "n": F.lit("1")})).first()[0]
    assert url == "http://h/x?" + urlencode({"k": value, "n": "1"})


def test_number_after_equals(spark):
    cases = {"http://h/?page=12": 12, "http://h/?page=12&x=3": None, "http://h/": None, "http://h/?a=1=2": 1}
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    got = {r.u: r.n for r in df.select("u", urls.number_after_equals(F.col("u")).alias("n")).collect()}
    assert got == cases


def test_strip_equals_the_standard_library(spark):
    cases = ["  x ", "\t\n x\xa0y  \x85", "\x1c\x1f", "", "x", "　z "]
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    assert [r[0] for r in df.select(text.strip(F.col("v"))).collect()] == [c.strip() for c in cases]


def test_host_and_domains(spark):
    cases = {"http://a.b.example/x": True, "https://B.Example:8080/": True, "http://xb.example/": False,
             "http://b.example.org/": False, "http://user@b.example?x": True, "/relative": False, "": False}
    df = spark.createDataFrame([(c,) for c in cases] + [(None,)], "url string")
    allowed = {c for c, ok in cases.items() if ok}
    assert {r.url for r in frontier.domain_filter(df, ["b.example"]).collect()} == allowed
    table = spark.createDataFrame([("b.example",), ("B.EXAMPLE",), ("a.b.example",)], "domain string")
    got = [r.url for r in frontier.domain_filter_table(df, table).collect()]
    assert set(got) == allowed and len(got) == len(allowed)


def test_stripped_and_plain_prefix(spark):
    df = spark.createDataFrame([("//a/b",), ("c",), (None,)], "h string")
    got = df.select(urls.strip_then_prefix("S", F.col("h")), urls.prefix("S", F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("S/a/b", "S//a/b"), ("S/c", "Sc"), (None, None)]


def test_canonical(spark):
    cases = {"http://h/x": "http://h/x", "http://h/x#top": "http://h/x", "http://h/x?b=2&a=1#f": "http://h/x?a=1&b=2",
             "http://h/x?a&b=": "http://h/x?a=&b=", "http://h/x?": "http://h/x", "http://h/?b=1&b=0&": "http://h/?b=0&b=1"}
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    assert {r.u: r.c for r in df.select("u", urls.canonical(F.col("u")).alias("c")).collect()} == cases
