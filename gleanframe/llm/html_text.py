"""Main text of HTML pages by the distribution of text over lines.

1. Markup is stripped: scripts, styles, comments, head and forms go whole; so do elements that their
   name or their class, id or role marks as menu, header, footer, sidebar, notice, advert or reader
   comments. Each block that is left is one line.
2. The text of a line counts unless most of it is link text. Where article and main elements hold at
   least half of what counts on the page, only text within them counts, linked or not; a teaser beside
   the text does not.
3. Over windows of ``WINDOW`` lines the counts are summed. The text surges where a window first holds
   ``ENOUGH`` characters (one, if only such elements count), and dives behind the last window
   that does. All lines between that count are the text, and where no article or main element decides, linked
   paragraphs and headings among them and a linked first heading before them; where no window holds enough, all
   that count.

A name marks if it is made of marks and words of layout altogether, as "ad-box" is and "related-work" or
"social-history" is not; "with-sidebar" marks nothing, nor does a header named after its article, nor the
id of a heading. Within an article or main element headings and parts of sentences are
not marked, sections only by an id that says reader comments, and paragraphs, items and cells not by an id. Where nothing is left of a page, but marked elements hold ``MISTAKEN`` characters or more, they
were containers, and only element names count.

Character references are decoded once. White space within a line, no-break spaces and line breaks
included, becomes one space; lines are joined by a newline. Null, empty and text-free pages give an
empty text. An element ends with its end tag or that of one around it, and a paragraph, item, cell, row or
label where HTML lets the next element end it. What is not closed even so ends with the page, except
that a dropped one ends where the first article or main element opens. Rows that repeat get the same text; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.tables import id_column, shown_id
from gleanframe.llm.texts import groups
from gleanframe.session import reach_workers

WINDOW = 3
ENOUGH = 30
# A page without any text gets what marked elements hold, if that is so much.
MISTAKEN = 500

# Fixed lists: elements of HTML and usual names of page parts.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre raw- search section summary table tbody td tfoot th thead title tr ul"
    .split())  # raw- stands for a script and the like
VOID = frozenset("area base br col embed hr img input link meta param raw- source track wbr".split())
# their content is no markup
RAW = "script|style|textarea|title|template|iframe|noscript|noembed|noframes|svg|canvas"
DROPPED = frozenset("nav footer aside form fieldset button select dialog menu head search label datalist "
                    "audio video applet".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar "
    "header masthead topbar footer footnav colophon sidebar sidebars side rail widget widgets aside "
    "cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay newsletter subscribe "
    "subscription signup login search comment comments disqus reply replies respond discussion feedback "
    "share sharing social related recommended recommendations skip copyright legal complementary "
    "contentinfo navigation banner form hidden".split())
# the same within longer words
STEMS = re.compile(
    r"^(?:advert|breadcrumb|comment|consent|cookie|disqus|footer|navbar|navigation|newsletter|popup|promo|sidebar|"
    r"social|sponsor|subscri)|(?:banner|comments|footer|menu|navbar|sidebar)$")
# words that turn a mark into a word about a neighbour, and what may be a title's own header
LAYOUT = frozenset(
    "area bar block box btn button buttons container content form group holder inner item items link links "
    "list panel row section slot unit wrap wrapper left right top bottom main article post page "
    "user users reader readers visitor visitors thread threads".split())
# with these a name outside of an article may be made of marks, too
SITE = LAYOUT | frozenset(
    "site global primary secondary tertiary sub mini mobile desktop sticky fixed inline inside outer module component "
    "region zone col column columns grid card cards wide narrow large small big full first last text icon icons icontext "
    "image images logo title titles text posts articles stories story news more also read view click here go to the and "
    "for of your our us my on in by with a content div element object hook area start end before after middle center "
    "body head foot level one two three settings policy text message messages info hint tip tips form field fields input "
    "count counter toggle trigger open close closed active js css wp ui uk tw md sm lg xl new old".split())
# what an id may say of a section within an article
READERS = frozenset("comment comments disqus replies respond".split())
# lines of these are text even where they are links, if they stand among the text
PROSE = frozenset("p blockquote pre figcaption h1 h2 h3 h4 h5 h6".split())
BESIDE = frozenset("has have with without no not show hide enable enabled".split())
HEADERS = frozenset("header masthead topbar".split())
OWN = frozenset("article post entry story content title page main".split())
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_ROOTS = ("article", "main")
_HEADS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# within an article: never marked, and not by their id
_SENTENCE = _HEADS | frozenset("a abbr b cite code em i mark q s small span strong sub sup time u".split())
_BY_CLASS = _HEADS | frozenset("section p li dt dd td th tr blockquote pre figure figcaption".split())
# open elements that an opening one ends, unless one of the others was opened behind them
_SCOPE = frozenset("applet button caption html marquee object table td th".split())
_TABLE = frozenset(["table"])
_LISTS = _SCOPE | frozenset("ul ol menu dir dl section article main aside nav blockquote".split())
_ENDS: dict[str, list[tuple[frozenset[str], frozenset[str]]]] = defaultdict(list)
for _names in (
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 header hgroup hr li dt dd main menu nav ol p pre search section summary table ul").split():
    _ENDS[_names].append((frozenset(["p"]), _SCOPE))
for _names in "p li dt dd td th tr h1 h2 h3 h4 h5 h6".split():
    _ENDS[_names].append((frozenset(["label"]), _SCOPE - {"td", "th"}))
for _names, _ended, _within in (
        ("li", "li", _LISTS), ("dt dd", "dt dd", _LISTS), ("td th", "td th", _TABLE), ("tr", "tr", _TABLE),
        ("tbody thead tfoot", "tr", _TABLE), ("tbody thead tfoot", "tbody thead tfoot", _TABLE),
        ("option optgroup", "option", _LISTS), ("optgroup", "optgroup", _LISTS)):
    for _name in _names.split():
        _ENDS[_name].append((frozenset(_ended.split()), _within))
_PARTS = frozenset("caption tbody thead tfoot tr td th".split())
_RAW = re.compile(rf"<({RAW})\b[^>]*>.*?(?:</\1\s*[^>]*>|\Z)", re.I | re.S)
_COMMENT = re.compile(r"<!--.*?(?:--!?>|\Z)", re.S)
_TAG = re.compile(
    r"""<(?:(/?)([a-zA-Z][^\s/>]*)((?:"[^"<]*"|'[^'<]*'|[^"'>])*+)(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""")
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")
_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Line(NamedTuple):
    text: str
    linked: int  # characters of it in links
    inside: bool  # within an article or main element
    block: str  # the element that it began in


def _whole(words: list[str], layout: frozenset[str] = LAYOUT, stems: bool = False) -> bool:
    """Are all of these words marks or words of layout, some of them marks? ``stems`` counts words that hold a
    mark as such."""
    joined = [any(w.endswith(x) and w[:-len(x)] in MARKS for x in LAYOUT)
              or stems and w not in OWN and bool(STEMS.search(w)) for w in words]
    return any(j or w in MARKS for w, j in zip(words, joined)) and all(
        j or w in MARKS or w in layout for w, j in zip(words, joined))


def _marked(element: str, attributes: str, rooted: bool) -> bool:
    """Do class, id or role name a part that is no text? Each name counts for itself."""
    if rooted and element in _SENTENCE:
        return False
    for found in _MARK.finditer(attributes):
        by_id = found[0][:2].lower() == "id"
        if by_id and element in (_BY_CLASS if rooted else _HEADS) and element != "section":
            continue
        for name in (found[1] or found[2] or found[3] or "").split():
            listed = _NAME.findall(_CASE.sub("-", name).lower())
            words = set(listed)
            if words & BESIDE:
                continue
            if words & HEADERS and (rooted or words & OWN):
                words -= HEADERS
            listed = [w for w in listed if w in words]
            if not rooted:
                if _whole(listed, SITE, stems=True):
                    return True
            elif _whole(listed) and (not by_id or element != "section" or words & READERS):
                return True
    return False


def _dropped(name: str, attributes: str, rooted: bool, marks: bool) -> bool:
    if name in DROPPED:
        return True
    if name == "header":
        return not rooted  # an article's own header holds its title
    if not marks or not attributes or name in ("html", "body"):
        return False
    return bool(_HIDDEN.search(attributes)) or _marked(name, attributes, rooted)


class _Open:
    """The open elements, and which of them is dropped with all that it holds."""

    def __init__(self):
        self.names: list[str] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.roots: list[int] = []  # article and main elements that are not dropped
        self.cut = -1

    def last(self, names: frozenset[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, name: str, cut: bool = False) -> None:
        if cut:
            self.cut = len(self.names)
        elif self.cut < 0 and name in _ROOTS:
            self.roots.append(len(self.names))
        self.places[name].append(len(self.names))
        self.names.append(name)

    def shut(self, at: int) -> None:
        """End that element and all within it."""
        while len(self.names) > at:
            self.places[self.names.pop()].pop()
        while self.roots and self.roots[-1] >= at:
            self.roots.pop()
        if self.cut >= at:
            self.cut = -1

    def opens(self, name: str) -> None:
        """End what the tag of a new element ends."""
        for ended, within in _ENDS.get(name, ()):
            if (at := self.last(ended)) > self.last(within - ended):
                self.shut(at)
        if name in _HEADS and self.names and self.names[-1] in _HEADS and name != "hgroup" != self.names[-1]:
            self.shut(len(self.names) - 1)

    def closes(self, name: str) -> bool:
        """End what an end tag ends; was that the dropped element itself?"""
        if name in ("body", "html"):
            return False
        cut, at = self.cut, self.last(frozenset([name]))
        if name in _ROOTS:
            within = -1
        else:
            within = max(self.last(_TABLE if name in _PARTS else frozenset() if name == "table" else _SCOPE),
                         self.roots[-1] if self.roots else -1)
        if at >= 0 and at >= within:
            self.shut(at)
            return at == cut
        return False


def lines(page: str, marks: bool = True) -> list[Line]:
    """The blocks of a page that are left without markup and dropped elements; without ``marks``,
    elements are dropped by their name alone."""
    page = _RAW.sub("<raw->", _COMMENT.sub("", page)) if "<" in page else page
    out: list[Line] = []
    parts: list[str] = []
    linked = 0
    inside = False  # an article or main element, when the line began
    block = ""  # the element in which the line began
    open_ = _Open()
    seen = False  # any article or main element
    in_link = False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Line(text, linked, inside, block))
            parts.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text and open_.cut < 0:
            text = html.unescape(text)  # a reference does not reach over a tag
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    at = 0
    for tag in _TAG.finditer(page):
        take(page[at:tag.start()])
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = bool(tag[1] or tag[4])
        attributes = tag[3] or tag[6] or ""
        if closing:
            if name in BLOCKS and open_.cut < 0:
                flush()
            if open_.closes(name) or open_.cut >= 0:
                continue
        else:
            if name in BLOCKS and open_.cut < 0:
                flush()
            open_.opens(name)
            if open_.cut >= 0 and (
                    name == "body" and open_.names[open_.cut] == "head"
                    or name in _ROOTS and not seen and not _dropped(name, attributes, True, marks)):
                open_.shut(open_.cut)
            if open_.cut >= 0:
                if name not in VOID:
                    open_.push(name)
                continue
        if name in BLOCKS:
            flush()
            block = "" if closing else name
        elif name == "br":
            parts.append(" ")
        if closing:
            in_link = in_link and name != "a"
        elif name not in VOID:
            cut = _dropped(name, attributes, bool(open_.roots), marks)
            if cut:
                flush()
            open_.push(name, cut)
            seen = seen or name in _ROOTS and not cut
            in_link = in_link or name == "a" and not cut
        inside = bool(open_.roots)
    take(page[at:])
    flush()
    return out


def main_text(page: str | None) -> str:
    found = lines(page or "")
    if not found:
        unmarked = lines(page or "", marks=False)
        if sum(len(line.text) for line in unmarked) >= MISTAKEN:
            found = unmarked
    counts = [0 if 2 * line.linked > len(line.text) else len(line.text) for line in found]
    inside = sum(n for line, n in zip(found, counts) if line.inside)
    rooted = any(line.inside for line in found) and 2 * inside >= sum(counts)
    if rooted:
        counts = [len(line.text) if line.inside else 0 for line in found]
    sums = [0]
    for n in counts:
        sums.append(sums[-1] + n)
    last = len(counts)
    enough = 1 if rooted else ENOUGH  # such an element has no short lines around its text
    full = [n for n in range(last) if sums[min(n + WINDOW, last)] - sums[n] >= enough]
    surge, dive = (full[0], min(full[-1] + WINDOW, last)) if full else (0, last)
    counted = [n for n in range(surge, dive) if counts[n]]
    if not rooted and counted:
        # a linked title before the text, and linked lines of prose within it, are of the text
        counts = [n or (line.block == "h1" and k < counted[0] or line.block in PROSE and counted[0] < k < counted[-1])
                  for k, (line, n) in enumerate(zip(found, counts))]
    return "\n".join(line.text for line, n in zip(found[surge:dive], counts[surge:dive]) if n)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Per row: id, url, ``text`` and its length ``n_chars``."""
    rows = pages.select(id_column(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            texts = [main_text(page.as_py()) for page in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    reach_workers(pages.sparkSession)
    found = rows.mapInArrow(run, "id bigint, url string, text string, n_chars bigint")
    return found.select(shown_id("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
