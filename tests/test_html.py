"""The page walk, and that it agrees with the native forms on the raw pages."""

import time

import pytest
from pyspark.sql import functions as F

from gleanframe.functions.html import Field, PageWalk, Step
from gleanframe.operators import pages

SF = "/root/testdata/sf0.01"


def texts(page, *chain):
    return PageWalk([Field("x", "texts", (chain,))])(page)["x"]


def test_direct_text_only_and_in_document_order():
    page = "<div class=a>one<b>inner</b>two</div><p>x</p><div class='b a'>three</div>"
    assert texts(page, Step("div", "a")) == ["one", "two", "three"]


def test_class_is_a_token_and_part_is_a_substring():
    page = '<div class="ab">1</div><div class="x  a\ty">2</div><div class="A">3</div>'
    assert texts(page, Step("div", "a")) == ["2"]
    assert texts(page, Step("div", cls_part="a")) == ["1", "2"]


def test_descendants():
    page = "<div class=a><p><span>1</span></p></div><span>2</span><div class='a b'><i class=b>3</i></div>"
    assert texts(page, Step("div", "a"), Step("span")) == ["1"]
    # an element does not count as its own descendant
    assert texts(page, Step(None, "a"), Step(None, "b")) == ["3"]


def test_nth_child_counts_all_elements():
    page = "<ul><li>1<li>2<!-- <li> --></li><script><li></script><li>3</ul><ul><b></b><li>4</li></ul>"
    assert texts(page, Step("ul"), Step("li", nth=2)) == ["2", "4"]
    assert texts(page, Step("ul"), Step("li", nth=4)) == ["3"]


def test_hidden_markup_is_no_markup():
    page = ("<script>var t='<div class=a>s</div>'</script><!-- <div class=a>c</div> -->"
            "<style>div.a{}</style><div class=a>real</div>")
    assert texts(page, Step("div", "a")) == ["real"]


def test_entities_and_text_split_by_comment():
    assert texts("<div class=a>a &amp; b &#39;c&apos; &amp</div>", Step("div", "a")) == ["a & b 'c' &"]
    assert texts("<div class=a>x<!-- -->y</div>", Step("div", "a")) == ["x", "y"]


def test_unclosed_and_stray_tags():
    page = "<div class=a>1<br>2<p>x<div class=c>3</div><p>y</i></div>4<div class=a>5"
    assert texts(page, Step("div", "a")) == ["1", "2", "5"]
    assert texts(page, Step("p")) == ["x", "y"]
    # the end of an inline element does not close the block around it
    assert texts("<b><div class=a>1</b>2</div>", Step("div", "a")) == ["12"]


def test_attributes():
    page = """<a class="l" href="/x?a=1&amp;b=2">t</a><a href='/y' class=l>u</a><a class=l>v</a><a href=/z>w</a>"""
    walk = PageWalk([Field("h", "attr", ((Step("a", "l"),),), "href")])
    assert walk(page)["h"] == ["/x?a=1&b=2", "/y"]
    # a quoted '>' does not end the tag
    assert walk('<a title="a>b" class="l" href="/q">t</a>')["h"] == ["/q"]


def test_pairs_take_first_texts_and_keep_empty_tiles():
    tile = Field("t", "pairs", ((Step("div", "box"), Step(None, "tile")),),
                 (Step("div", "k"), Step("div", "v")))
    page = ("<div class=box><div class=tile><div class=v>1</div><div class=k>A</div><div class=k>B</div></div>"
            "<p class=tile><span>none</span></p><div class=tile><div class=k>C</div><div class=v></div></div></div>"
            "<div class=tile><div class=k>outside</div></div>")
    assert PageWalk([tile])(page)["t"] == [
        {"key": "A", "value": "1"}, {"key": None, "value": None}, {"key": "C", "value": None}]


def test_elements_keep_whole_text():
    field = Field("e", "elements", ((Step("div", "s"),),))
    page = "<div class=s><b>3</b> years<div class=s>x</div></div>"
    assert PageWalk([field])(page)["e"] == [
        {"nodes": [" years"], "full": "3 yearsx"}, {"nodes": ["x"], "full": "x"}]


def test_one_element_reached_twice_counts_once():
    field = Field("x", "texts", ((Step("div", "a"),), (Step("div", "b"),)))
    assert PageWalk([field])("<div class='a b'>1</div><div class=b>2</div>")["x"] == ["1", "2"]


def test_empty_and_missing_pages():
    walk = PageWalk([Field("x", "texts", ((Step("p"),),))])
    assert walk(None)["x"] == [] and walk("")["x"] == [] and walk("<")["x"] == []


def test_many_different_start_tags_stay_bounded():
    walk = PageWalk([Field("x", "attr", ((Step("a", "l"),),), "href")])
    page = "".join(f'<a class=l href="/{n}">' for n in range(10_000))
    assert len(walk(page)["x"]) == 10_000
    assert len(walk.tokens) <= walk.REMEMBERED


def test_native_forms_agree_with_the_walk(spark):
    raw = spark.read.parquet(f"{SF}/pages.parquet")
    native = pages.extract_first_text(
        raw, {"title": ("title", None), "ad": ("div", "ad"), "h1": ("h1", None)})
    fields = [Field("title", "texts", ((Step("title"),),)), Field("ad", "texts", ((Step("div", "ad"),),)),
              Field("h1", "texts", ((Step("h1"),),))]
    walked = pages.walk_pages(raw, fields, ("page_id",)).select(
        "page_id", *[F.trim(F.get(f.name, F.lit(0))).alias(f.name) for f in fields])
    assert native.exceptAll(walked).count() == 0
    links = pages.extract_links(raw, ("page_id",))
    walked_links = pages.extract_links_selected(raw, (Step("a"),), ("page_id",))
    assert links.count() > 1000
    assert links.exceptAll(walked_links).count() == 0 == walked_links.exceptAll(links).count()


def test_pages_without_the_class_are_not_walked(spark):
    rows = [(1, '<div class="a"><i class="b">x</i></div>'), (2, '<div class="a">x</div>'), (3, None), (4, "b"),
            (5, '<div class="&#97;"><i class=&#98;>y</i></div>')]
    df = spark.createDataFrame(rows, "url int, html string")
    field = Field("x", "texts", ((Step("div", "a"), Step("i", "b")),))
    got = {r.url: r.x for r in pages.walk_pages(df, [field]).collect()}
    assert got == {1: ["x"], 2: [], 3: [], 4: [], 5: ["y"]}
    plan = pages.walk_pages(df, [field])._jdf.queryExecution().executedPlan().toString()
    assert "Contains(html" in plan


@pytest.mark.parametrize("page", [
    "<div>" * 100_000, "<p><table>" + "<div>" * 100_000, "<b>" * 100_000 + "</i>" * 100_000,
    "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "<div>" * 100_000 + "</section>" * 100_000,
    "<section>" + "<div>" * 50_000 + "</p>" * 50_000, "<a \"" * 200_000, "<a '\"" * 200_000, "<!" * 300_000,
    "<!--" * 300_000, "<script" * 100_000, "<script>" * 100_000, "<" * 500_000, "<a " + "x" * 500_000 + ">",
    "<a " + "x " * 300_000 + ">", "<a " + "x=" * 300_000 + ">", "<div class=\"" * 50_000, "<p>" * 200_000,
    "<li>" * 100_000, "&" * 300_000,
], ids=range(20))
def test_broken_pages_take_linear_time(page):
    fields = [Field("x", "texts", ((Step("div", "a"), Step("span")), (Step("p"),), (Step("a"),))),
              Field("h", "attr", ((Step("a"),),), "href")]
    start = time.process_time()
    PageWalk(fields)(page)
    assert time.process_time() - start < 5


def test_native_patterns_take_linear_time(spark):
    bad = ["<!--" * 200_000, "<script>" * 100_000, "<script" * 100_000, "<div " * 100_000, "<a href=" * 100_000,
           "<div class=\"" * 50_000, "<a \"" * 100_000, "<title" * 100_000]
    df = spark.createDataFrame(list(enumerate(bad)), "page_id int, html string")
    start = time.time()
    pages.extract_first_text(df, {"t": ("title", None), "d": ("div", "ad")}).collect()
    pages.extract_links(df, ("page_id",)).collect()
    assert time.time() - start < 30


def test_implied_ends_stay_in_scope():
    page = "<p>1<button>x<p>2</button>3<table><tr><td>4<p>5<td>6</table>7<p>8"
    assert texts(page, Step("p")) == ["1", "2", "3", "5", "8"]
    assert texts(page, Step("td")) == ["4", "6"]
    assert texts("<ul><li>1<ul><li>2</ul>3<li>4</ul>", Step("li")) == ["1", "2", "3", "4"]
