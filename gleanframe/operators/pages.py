"""Stored pages -> rows. A page table has the columns url and html.

``walk_pages`` is the exact form of extraction: one Arrow-batched pass that collects all wanted fields
of a page at once. Native forms (patterns, JVM only) are exact for elements without children, with
attribute values in double quotes and usual entities. Operators that use them test each page for
that and send the others to the walk.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanframe.functions import html as H
from gleanframe.functions import text as t
from gleanframe.functions import urls
from gleanframe.operators.columns import with_once

# the walk travels to the executors with the job, so that nothing has to be installed there
cloudpickle.register_pickle_by_value(H)

_STRINGS = T.ArrayType(T.StringType())
_ARROW_STRINGS = pa.list_(pa.string())
_KINDS = {
    "texts": (_STRINGS, _ARROW_STRINGS),
    "attr": (_STRINGS, _ARROW_STRINGS),
    "elements": (
        T.ArrayType(T.StructType([T.StructField("nodes", _STRINGS),
                                  T.StructField("full", T.StringType())])),
        pa.list_(pa.struct([("nodes", _ARROW_STRINGS), ("full", pa.string())])),
    ),
    "pairs": (
        T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                  T.StructField("value", T.StringType())])),
        pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())])),
    ),
}


def _may_match(html: Column, fields: list[H.Field]) -> Column | None:
    """False for pages in which no chain can match, because a class name it asks for does not
    occur; None when a chain asks for no class. A class written with entities is let through."""
    chains = []
    for chain in {chain for f in fields for chain in f.chains}:
        names = {name for step in chain for name in (step.cls, step.cls_part) if name}
        if not names:
            return None
        chains.append(reduce(lambda a, b: a & b, [F.contains(html, F.lit(n)) for n in sorted(names)]))
    encoded = html.rlike(r"""(?i)class\s*=\s*["']?[^"'>]*&""")
    return reduce(lambda a, b: a | b, [*chains, encoded])


def _walked_page(walk: H.PageWalk, page: str | None) -> tuple[dict, str | None]:
    """What a page holds, and why it could not be read, if so."""
    try:
        return walk(page), None
    except Exception as error:  # a page that breaks the walk is reported, and the others go on
        return walk(None), f"{type(error).__name__}: {error}"


def walk_pages(pages: DataFrame, fields: Iterable[H.Field], keep: Iterable[str] = ("url",),
               html: str = "html", slice_rows: int = 64, error: str | None = None) -> DataFrame:
    """Collect the fields of every page. No shuffle; the page text does not leave the pass. Pages
    that cannot hold any of the fields are not sent to it; they give empty lists. ``error`` names a column
    for the message of a page that could not be read, whose lists are empty; without it such a page ends
    the job."""
    fields, keep = list(fields), list(keep)
    may_match = _may_match(F.col(html), fields)
    text = F.col(html) if may_match is None else F.when(may_match, F.col(html))
    source = pages.select(*keep, text.alias(html))
    schema = T.StructType(
        [source.schema[c] for c in keep]
        + [T.StructField(f.name, _KINDS[f.kind][0]) for f in fields]
        + ([T.StructField(error, T.StringType())] if error else []))
    arrow = {f.name: _KINDS[f.kind][1] for f in fields}
    walk = H.PageWalk(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                piece = batch.slice(start, slice_rows)
                texts = piece.column(html).to_pylist()
                found = [_walked_page(walk, page) if error else (walk(page), None) for page in texts]
                columns = [piece.column(c) for c in keep]
                columns += [pa.array([row[n] for row, _ in found], type=kind)
                            for n, kind in arrow.items()]
                names = [*keep, *arrow]
                if error:
                    columns.append(pa.array([why for _, why in found], type=pa.string()))
                    names.append(error)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema)


# ---- native forms ---------------------------------------------------------------------------

# Comments and script/style bodies hold text that only looks like elements. One that is never
# closed takes all the rest, so that broken pages are read in linear time too.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^<>]*>.*?(?:</\1\s*>|\z)"


def visible_markup(html: Column) -> Column:
    return F.regexp_replace(html, _HIDDEN, "")


# attributes with their values in double quotes, or without values
_ATTRIBUTES = r"""(?:\s+[a-zA-Z_:][-\w:.]*(?:="[^"<>]*")?)*+\s*"""


def _start_tag(tag: str, cls: str | None) -> str:
    if cls is None:
        return rf"<{tag}(?:\s[^<>]*)?>"
    return rf'<{tag}\s(?:[^<>]*?\s)?class="(?:[^"]*\s)?{re.escape(cls)}(?:\s[^"]*)?"[^<>]*>'


def _other_entities(text: Column) -> Column:
    """Does the text hold a character reference that the native forms leave as it is?"""
    known = "|".join(re.escape(entity[1:]) for entity, _ in t.ENTITIES)
    return text.rlike(rf"&(?!amp;|{known}|[^\w#]|\z)")


def _plain_elements(text: Column, tag: str) -> Column:
    """Are all elements of a name written as the native forms read them: attributes in double quotes,
    and nothing but text up to their end tag?"""
    starts = F.regexp_count(text, F.lit(rf"(?i)<{tag}(?=[\s/>])"))
    return starts == F.regexp_count(text, F.lit(rf"(?i)<{tag}{_ATTRIBUTES}>[^<]*</{tag}\s*>"))


def _visible(pages: DataFrame, keep: list[str], html: str) -> DataFrame:
    """The kept columns, the page as ``_page`` and its visible markup, which is made once, as ``_text``."""
    return with_once(pages.select(*keep, F.col(html).alias("_page")), "_text", visible_markup(F.col("_page")))


def _or_walked(visible: DataFrame, plain: Column, native: dict[str, Column], walked: dict[str, tuple[H.Field, Column]],
               keep: list[str]) -> DataFrame:
    """The native columns where a page is plain, else those made from the walk."""
    names = {name: f"_native_{name}" for name in native}
    tested = with_once(visible, "_plain", F.coalesce(plain, F.lit(False)))  # no page, no plain page
    rows = tested.select(
        *keep, "_plain", F.when(~F.col("_plain"), F.col("_page")).alias("_page"),
        *[F.when(F.col("_plain"), column).alias(names[name]) for name, column in native.items()])
    found = walk_pages(rows, [field for field, _ in walked.values()], (*keep, "_plain", *names.values()), "_page")
    return found.select(*keep, *[
        F.when(F.col("_plain"), F.col(names[name])).otherwise(column).alias(name)
        for name, (_, column) in walked.items()])


def first_text(html: Column, tag: str, cls: str | None = None) -> Column:
    """Text right after the first such start tag, decoded and stripped; null when there is
    none."""
    found = F.regexp_extract(html, f"(?i){_start_tag(tag, cls)}([^<]+)", 1)
    return t.strip(t.unescape(t.blank_to_null(found)))


def all_texts(html: Column, tag: str, cls: str | None = None) -> Column:
    """Texts right after all such start tags, decoded and stripped, blank ones left out."""
    found = F.regexp_extract_all(html, F.lit(f"(?i){_start_tag(tag, cls)}([^<]+)"), F.lit(1))
    return F.filter(F.transform(found, lambda x: t.strip(t.unescape(x))), lambda x: x != "")


def extract_first_text(pages: DataFrame, columns: dict[str, tuple[str, str | None]],
                       keep: Iterable[str] = ("page_id",), html: str = "html") -> DataFrame:
    """One column per (tag, class): the first direct text of the first such element that has any, stripped;
    null without one or where it is blank."""
    text, keep = F.col("_text"), list(keep)
    plain = reduce(lambda a, b: a & b, [_plain_elements(text, tag) for tag in {tag for tag, _ in columns.values()}])
    walked = {
        name: (H.Field(f"_walked_{name}", "texts", ((H.Step(tag, cls),),)),
               t.strip(t.first(F.col(f"_walked_{name}"))))
        for name, (tag, cls) in columns.items()}
    native = {name: first_text(text, tag, cls) for name, (tag, cls) in columns.items()}
    return _or_walked(_visible(pages, keep, html), plain & ~_other_entities(text), native, walked, keep)


def extract_all_texts(pages: DataFrame, tag: str, cls: str | None = None,
                      keep: Iterable[str] = ("page_id",), html: str = "html") -> DataFrame:
    """All direct texts of such elements, stripped, blank ones left out."""
    text, keep = F.col("_text"), list(keep)
    field = H.Field("_walked", "texts", ((H.Step(tag, cls),),))
    return _or_walked(
        _visible(pages, keep, html), _plain_elements(text, tag) & ~_other_entities(text),
        {"texts": all_texts(text, tag, cls)}, {"texts": (field, t.strip_all(F.col("_walked")))}, keep)


def extract_links(pages: DataFrame, keep: Iterable[str] = ("page_id", "url"),
                  html: str = "html") -> DataFrame:
    """One row per anchor with a link, in document order."""
    keep, text = list(keep), F.col("_text")
    found = F.regexp_extract_all(text, F.lit(r'(?i)<a\s(?:[^<>]*?\s)?href="([^"]*)"'), F.lit(1))
    # each anchor has a link, and all its values are in double quotes
    anchors = F.regexp_count(text, F.lit(r"(?i)<a(?=[\s/>])"))
    plain = (anchors == F.regexp_count(text, F.lit(rf'(?i)<a(?=\s[^<>]*?\bhref="){_ATTRIBUTES}>'))) & (
        anchors == F.size(found)) & ~_other_entities(text)
    rows = _or_walked(
        _visible(pages, keep, html), plain, {"_hrefs": F.transform(found, t.unescape)},
        {"_hrefs": (H.Field("_walked", "attr", ((H.Step("a"),),), "href"), F.col("_walked"))}, keep)
    return rows.select(*keep, F.posexplode("_hrefs").alias("pos", "href"))


def extract_links_selected(pages: DataFrame, chain: tuple[H.Step, ...],
                           keep: Iterable[str] = ("url",), html: str = "html") -> DataFrame:
    """One row per anchor reached by the chain of steps, in document order."""
    walked = walk_pages(pages, [H.Field("hrefs", "attr", (chain,), "href")], keep, html)
    return walked.select(*keep, F.posexplode("hrefs").alias("pos", "href"))


def absolutize_urls(links: DataFrame, site: str) -> DataFrame:
    """The three ways links are made absolute: after dropping leading slashes, by plain prefix,
    and resolved against the page."""
    href = F.col("href")
    return links.withColumns({
        "stripped_url": urls.strip_then_prefix(site, href),
        "prefixed_url": urls.prefix(site, href),
        "resolved_url": urls.resolve(F.col("url"), href),
    })


# Phrases that announce a block (fixed values).
BLOCK_PHRASES = ["blocked", "rate limit", "too many requests"]


def block_detect(texts: DataFrame, phrases: list[str] = BLOCK_PHRASES,
                 column: str = "text") -> DataFrame:
    """Flag rows whose lower-cased text holds one of the phrases."""
    return texts.withColumn(
        "blocked", F.coalesce(t.contains_any(F.lower(F.col(column)), phrases), F.lit(False)))
