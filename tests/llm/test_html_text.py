import re
import time
from html import unescape

import pytest

from gleanframe.llm import html_text as h
from gleanframe.llm.queries import op7_html_text

PAGES = "page_id bigint, url string, html string, text string, id string"
ARTICLE = "<h1>A title</h1><p>First &amp; best paragraph, long enough to count.<p>Short."
TEXT = "A title\nFirst & best paragraph, long enough to count.\nShort."


@pytest.mark.parametrize("page", [
    f"<nav><ul><li><a href=/>Menu</a></ul></nav><article>{ARTICLE}</article><footer>&copy; us</footer>",
    f"<body><header><h2>Site of ours</h2></header><main>{ARTICLE}</main><aside>See also this</aside>",
    f"<article><header><h1>A title</h1></header>{ARTICLE[16:]}<div class='ad-box'>Buy!</div></article>",
    f"<div id=sidebarLeft><p>Side text that is long enough for a window</div><div>{ARTICLE}</div>",
    f"<div class='cookie-notice'><p>We use cookies to make this long.</p></div><div>{ARTICLE}</div>",
    f"<article>{ARTICLE}<form><label>Name</label><input><button>Send now</button></form></article>",
    f"<article>{ARTICLE}</article><section id=comments><article>Nice piece, I liked it very much</article></section>",
    f"<article>{ARTICLE}<section class=comments><article class=comment><p>Nice</p></article></section></article>",
    f"<script>var t='<p>no</p>';</script><style>p{{}}</style><!-- <p>no --><div>{ARTICLE}</div><script>x",
    f"<nav><ul><li>never closed<article>{ARTICLE}</article>",
    f"<title>T</title><ul><li><a href=1>One of many links</a><li><a href=2>Other link</a></ul>{ARTICLE}",
    f"<article>{ARTICLE}</article></foot",
    f"<ul id=mainMenu><li>Home of the very long menu</ul><div>{ARTICLE}</div><ol class=commentlist><li>I liked it, I did</ol>",
    f"<div class='layout with-sidebar'>{ARTICLE}</div><p hidden>Unseen text that is long enough to count",
    f"<article><div class=article-header><h1>A title</h1></div>{ARTICLE[16:]}</article><div role=contentinfo>(c)</div>",
    f"<head><title>T</title><body class=home><div>{ARTICLE}</div>",
    f"<div style='display:none'>Not to be seen, though it is a long text</div><main>{ARTICLE}</main>",
])
def test_main_text(page):
    assert h.main_text(page) == TEXT


def test_white_space_references_and_odd_markup():
    assert h.main_text("<p>a\n b&nbsp;\tc<br>d</p> &amp;lt; 1 < 2 <b title='>'>x</b>y") == "a b c d\n&lt; 1 < 2 xy"
    assert h.main_text("plain") == "plain" and h.main_text(None) == "" and h.main_text("<p> <br></p>") == ""
    assert h.main_text('<p title="open>text</p>more') == "text\nmore"


def test_rows(table):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "", ""), (2, None, None, "", ""), (None, "v", "é", "", ""),
            (1, "u", f"<article>{ARTICLE}</article>", "", "")]
    got = [tuple(r) for r in h.extract(table(rows, PAGES)).collect()]
    want = [(1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "v", "é", 1)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert h.extract(table([], PAGES)).collect() == []


def test_marked_containers_and_pages_without_text():
    text = "\n".join(f"Paragraph {n} of a page that is all in one container." for n in range(12))
    page = "<div class=sidebar>" + "".join(f"<p>{t}" for t in text.split("\n")) + "</div>"
    assert h.main_text(page) == text
    assert h.main_text("<nav><a href=/>Menu</a></nav><article></article><footer>Foot</footer>") == ""
    assert h.main_text("<div class=cookie-bar>We use cookies</div>") == ""


def test_long_page():
    page = "<article>" + "<p>word &amp; more" * 50_000 + "</article>"
    assert h.main_text(page) == "\n".join(["word & more"] * 50_000)


def test_time_is_linear_on_broken_pages():
    for bad in ("<a \"", "<p", "<!--", "<div class=ad>", "<script>", "&amp", "<a href='"):
        start = time.perf_counter()
        h.main_text(bad * 40_000)
        assert time.perf_counter() - start < 5


def test_the_given_pages(spark):
    """Their article element, cut out by a pattern, is the whole of the text."""
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op7_html_text(spark, sf).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>|<br>", " ", article))
        want = [" ".join(unescape(b).split()) for b in blocks]
        assert r.text == "\n".join(w for w in want if w) and r.n_chars == len(r.text)


def test_a_teaser_is_not_the_text():
    body = "".join(f"<p>Paragraph {n} of the text that stands in a plain element.</p>" for n in range(5))
    want = "\n".join(f"Paragraph {n} of the text that stands in a plain element." for n in range(5))
    assert want in h.main_text(f"<div>{body}</div><article class=card><p>Read this one next</p></article>")
    assert want in h.main_text(f"<article class=teaser><h2>Other story</h2></article><div>{body}</div>")
    assert h.main_text(f"<p>Some words beside the article element<article>{body}</article>") == want


@pytest.mark.parametrize("page, want", [
    ("<article><h1>T</h1><p class=notice>Ad<p>Body</p><p>More</p></article>", "T\nBody\nMore"),
    ("<article><div><span class=hidden hidden>Ad</div><p>Body</p></article><p>No", "Body"),
    ("<article><ul><li class=share>Share<li>One<li>Two</ul><p>More</article>", "One\nTwo\nMore"),
    ("<article><table><tr><td class=ad>Ad<td>One<tr><td>Two</table>More</article>", "One\nTwo\nMore"),
    ("<article><label>Name<p>Body</article>", "Body"),
    ("<main><article class=comment>Nice</article><p>Body<div class=ads><p>Ad<table><td>x</div>Ad</table></div>More</main>", "Body\nMore"),
    ("<article><h1><a href=/>Title</a></h1><p>Body<ul><li><a href=1>First reference</a></ul></article>",
     "Title\nBody\nFirst reference"),
    ("<article><h2 id=comments>On comments</h2><section id=related><p>Body</section>"
     "<section class=related-work><p>More</section><div class=social-history>Past</div>"
     "<ol class=commentlist><li>Nice</ol><div class=ad>Ad</div></article>", "On comments\nBody\nMore\nPast"),
])
def test_article_text_is_kept(page, want):
    assert h.main_text(page) == want
    assert h.main_text(f"<nav>Menu</nav>{page}<footer>Foot</footer>") == want


def test_time_is_linear_with_many_open_elements():
    for bad in ("<div class=ad><p></x>", "<li><td></div>", "<table><tr><td class=ad>", "<p><b></i>", "<article></div>"):
        start = time.perf_counter()
        h.main_text(bad * 20_000)
        assert time.perf_counter() - start < 5


BODY = "<p>First paragraph, long enough to count as text.</p><p>Second one, as long as the first of them.</p>"
PLAIN = "First paragraph, long enough to count as text.\nSecond one, as long as the first of them."


@pytest.mark.parametrize("page, want", [
    # reader comments within an article
    (f"<article>{BODY}<section id=comments><p>I liked this very much, thank you.</section></article>", PLAIN),
    (f"<main>{BODY}<div class='user-comments'><p>I liked this very much, thank you.</div></main>", PLAIN),
    (f"<main>{BODY}<div class='reader comment-thread user-comment'><p>I liked this.</div></main>", PLAIN),
    # elements that hold text
    (f"<article>{BODY}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</article>", PLAIN + "\nLet x=2 hold."),
    (f"<article>{BODY}<object data=x>No picture here</object></article>", PLAIN + "\nNo picture here"),
    # pages without article and main
    (f"<ul><li><a href=1>Home</a></ul><h1><a href=2>A linked title</a></h1>{BODY}", "A linked title\n" + PLAIN),
    (f"<div>{BODY}<p><a href=3>A paragraph that is a link, all of it</a></p>{BODY}</div>",
     PLAIN + "\nA paragraph that is a link, all of it\n" + PLAIN),
    (f"<div class=social-history>{BODY}</div>", PLAIN), (f"<div class=share-prices>{BODY}</div>", PLAIN),
    (f"<div id=comment-period>{BODY}</div>", PLAIN),
    (f"<div class=site-header>Name of the site, and what it is</div>{BODY}<div id=siteFooter>All rights are ours</div>", PLAIN),
    (f"<div class='primary-sidebar widget-area'><p>Much text at the side of it</div>{BODY}<ul class=related-articles><li>Other</ul>", PLAIN),
    # references end with their text
    ("<article>AT&<b>amp;</b>T and R&amp;D &lt;x&gt; &am<i>p;</i></article>", "AT&amp;T and R&D <x> &amp;"),
])
def test_comments_go_and_the_text_stays(page, want):
    assert h.main_text(page) == want


def test_windows_decide_where_no_element_does():
    """Short lines far from the text are left out, those near it are kept; sums equal plain loops."""
    short = "".join(f"<div>no {k}</div>" for k in range(6))
    page = f"{short}{BODY}<div>end</div>{short}"
    found = h.lines(page)
    counts = [len(line.text) for line in found]
    full = [n for n in range(len(counts)) if sum(counts[n:n + h.WINDOW]) >= h.ENOUGH]
    want = "\n".join(line.text for line in found[full[0]:full[-1] + h.WINDOW])
    assert h.main_text(page) == want
    assert want == "no 4\nno 5\n" + PLAIN + "\nend\nno 0"
