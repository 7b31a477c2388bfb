"""Column expressions on strings and arrays. All of them run inside the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python calls white space; Spark's plain trim only knows the blank.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Named entities decoded by the native extraction (fixed values); "&amp;" comes last, and its
# closing semicolon may be cut off.
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"),
]


def strip(c: Column) -> Column:
    """Strip all white space at both ends; null stays null."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def truthy(c: Column) -> Column:
    """Neither null nor empty; never null itself."""
    return F.coalesce(c != "", F.lit(False))


def first_truthy(*cols: Column) -> Column:
    """First source that is neither null nor empty, else null."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def part(c: Column, sep: str, n: int, limit: int = -1) -> Column:
    """n-th piece (from 0) of a split at a literal separator; null when there are fewer."""
    return F.get(F.split(c, re.escape(sep), limit), F.lit(n))


def before_last(c: Column, sep: str) -> Column:
    """Text before the last separator; the whole text when there is none."""
    s = re.escape(sep)
    return F.regexp_replace(c, f"{s}[^{s}]*$", "")


def contains_any(c: Column, phrases: list[str]) -> Column:
    """Does the text hold one of the phrases? Plain substring search, no pattern."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p)) for p in phrases])


def first(arr: Column) -> Column:
    return F.get(arr, F.lit(0))


def last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


def strip_all(arr: Column) -> Column:
    """Strip each element and leave out those that end up empty."""
    return F.filter(F.transform(arr, strip), lambda x: x != "")


def unescape(c: Column) -> Column:
    """Decode the entities of ENTITIES. Exact only for text that uses no others; the page walk
    of functions.html decodes all."""
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.regexp_replace(c, "&amp;?", "&")


def attr_first(attrs: Column, name: str, field: str) -> Column:
    """Field of the first attribute with that name."""
    return first(F.filter(attrs, lambda a: a["name"] == name))[field]


def attr_last(attrs: Column, name: str, field: str) -> Column:
    """Field of the last attribute with that name, as when pairs are put into a map in order."""
    return last(F.filter(attrs, lambda a: a["name"] == name))[field]
