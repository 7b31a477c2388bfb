"""Column expressions on URLs. Patterns are used instead of the URL parser where a link may hold
blanks, for which the parser gives null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanframe.functions.text import blank_to_null, part


def origin(url: Column) -> Column:
    """Scheme and authority."""
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def host(url: Column) -> Column:
    """Lower-cased host without user and port; null when there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(blank_to_null(found))


def host_pattern(domains: list[str]) -> str:
    """Pattern of URLs whose host is one of the domains or below one."""
    names = "|".join(re.escape(d) for d in domains)
    return rf"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:[^/?#:@]*\.)?(?:{names})(?:[:/?#]|\z)"


def host_suffixes(h: Column) -> Column:
    """The host and every parent domain: a.b.c gives [a.b.c, b.c, c]."""
    labels = F.split(h, r"\.")
    return F.transform(
        labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")
    )


def prefix(site: str, path: Column) -> Column:
    """Plain prefix. A missing path gives null instead of the text 'None'."""
    return F.concat(F.lit(site), path)


def strip_then_prefix(site: str, href: Column) -> Column:
    """Drop all leading slashes, then put the site and one slash in front."""
    return F.concat(F.lit(site + "/"), F.ltrim(href, F.lit("/")))


def _without_dots(path: Column) -> Column:
    """Resolve '.' and '..' segments of an absolute path."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..",
            F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc),
        ).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    # a trailing dot segment stands for the folder itself
    tail = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.array_join(kept, "/"), tail)
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.regexp_replace(joined, "^(?!/)", "/")).otherwise(path)


def resolve(page_url: Column, href: Column) -> Column:
    """Resolve a link against the URL of its page (http and https pages)."""
    base = origin(page_url)
    no_fragment = F.regexp_extract(page_url, r"^([^#]*)", 1)
    no_query = F.regexp_extract(page_url, r"^([^?#]*)", 1)
    folder = F.regexp_replace(F.substr(no_query, F.length(base) + 1), "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    # split the link into path and the rest
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substr(href, F.length(path) + 1)
    return (
        F.when(href == "", page_url)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"),
              F.concat(F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href.startswith("/"), F.concat(base, _without_dots(path), rest))
        .otherwise(F.concat(base, _without_dots(F.concat(folder, path)), rest))
    )


def canonical(url: Column) -> Column:
    """The form in which two URLs are the same request: without fragment, parameters sorted."""
    bare = F.regexp_extract(url, r"^([^#]*)", 1)
    path = F.regexp_extract(bare, r"^([^?]*)", 1)
    query = F.substr(bare, F.length(path) + 2)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    named = F.transform(pairs, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    return F.when(~url.rlike("[?#]"), url).when(query == "", path).otherwise(
        F.concat(path, F.lit("?"), F.array_join(F.array_sort(named), "&")))


def page_parameter(url: Column, name: str = "page") -> Column:
    """Integer value of a query parameter, 1 when it is absent or empty; null when it is no
    integer."""
    found = F.regexp_extract(url, rf"^[^?#]*\?(?:[^#]*?&)?{name}=([^&#]+)", 1)
    return F.coalesce(blank_to_null(found), F.lit("1")).try_cast("bigint")


def number_after_equals(url: Column) -> Column:
    """Integer between the first and the second '='; null when there is none."""
    return part(url, "=", 1).try_cast("bigint")


def form_encode(c: Column) -> Column:
    """Form encoding that keeps '~' and encodes '*'."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def with_parameters(base: str, parameters: dict[str, Column]) -> Column:
    """Base URL plus encoded parameters, in the order given."""
    pairs = [F.concat(F.lit(f"{k}="), form_encode(v)) for k, v in parameters.items()]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *pairs))
