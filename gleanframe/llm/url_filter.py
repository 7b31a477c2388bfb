"""Allow and block rules on URLs, carried over to aliases. DataFrame functions only.

URLs that redirect to each other, or name each other as canonical, are aliases: connected components
of those links. The longest rule that fits a URL decides on it. A URL without a rule takes what is
decided on its aliases: allowed if a rule allows one of them, else blocked if a rule blocks one,
else allowed.

Aliases are told apart by their names: scheme and host in lower case, without the scheme's own port and
without fragment, an empty path as /. Links in comments, scripts and styles are none.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.functions import text as t
from gleanframe.functions import urls
from gleanframe.llm.components import components
from gleanframe.llm.tables import stored
from gleanframe.operators.columns import with_once
from gleanframe.operators.pages import visible_markup

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical\b)[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*?\bcontent\s*=\s*(?:"[^">]*?\burl\s*=\s*'?([^"'>]*)|'[^'>]*?\burl\s*=\s*([^'>]*))"""


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str  # the host itself and all below it
    path: str  # beginning of the path

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next of / ? #, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without a host."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, the one of the longer host among
    equals; null without one. The rules are one chain of conditions inside the plan."""
    longest_first = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict))
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
               F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in longest_first]
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, nothing)


def _with_numbers(text: Column, pattern: str, digits: str, base: int) -> Column:
    """The references of a pattern as the characters of their numbers."""
    def put(url: Column, found: Column) -> Column:
        number = F.conv(F.regexp_extract(found, digits, 1), base, 10).cast("int")
        return F.when(number < 128, F.replace(url, found, F.char(number))).otherwise(url)

    return F.aggregate(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), text, put)


def _decoded(text: Column) -> Column:
    """Character references as characters: those of functions.text, and all numbers below 128, which are
    what a URL can hold."""
    text = _with_numbers(text, r"&#[0-9]{1,3};", r"([0-9]+)", 10)
    return t.unescape(_with_numbers(text, r"(?i)&#x[0-9a-f]{1,2};", r"(?i)x([0-9a-f]+)", 16))


def _target(html: Column, pattern: str, groups: int) -> Column:
    found = F.concat(*[F.regexp_extract(html, pattern, n + 1) for n in range(groups)])
    found = F.trim(_decoded(found))
    return F.when(found != "", found)


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a, b``: a page and the URL that it names as canonical or moves its readers to, as names. Only pages that
    mention such a link are searched for it."""
    html = F.col("html")
    rows = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).filter(
        F.lower(html).rlike("canonical|refresh") & F.col("url").isNotNull())
    rows = with_once(rows, "html", visible_markup(html))
    found = rows.select("url", F.explode(F.array(
        _target(html, _CANONICAL, 3), _target(html, _REFRESH, 2))).alias("to")).dropna()
    return found.select(name_of(F.col("url")).alias("a"),
                        name_of(urls.resolve(F.col("url"), F.col("to"))).alias("b"))


_WHOLE = r"(?s)^([A-Za-z][-A-Za-z0-9+.]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def name_of(url: Column) -> Column:
    """The name of a URL among its aliases; what is no whole URL only loses its fragment."""
    scheme, host, path, query = (F.regexp_extract(url, _WHOLE, n) for n in (1, 2, 3, 4))
    scheme, host = (F.translate(x, CAPITALS, SMALL) for x in (scheme, host))
    own = F.when(scheme == "http", F.regexp_replace(host, ":(?:80)?$", "")).when(
        scheme == "https", F.regexp_replace(host, ":(?:443)?$", "")).otherwise(host)
    whole = F.concat(scheme, F.lit("://"), own, F.when(path == "", "/").otherwise(path), query)
    return F.when(scheme != "", whole).otherwise(F.regexp_extract(url, r"(?s)^([^#]*)", 1))


def judge(pages: DataFrame, rules: list[Rule], links: DataFrame, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule and verdict. ``links`` holds the ends ``a, b`` of alias links
    of any source. A null url has an empty host and path and no aliases; rows that repeat are
    judged alike; no links leave each URL alone. Other columns are not read."""
    aliases = components(links.select(name_of(F.col("a")).alias("a"), name_of(F.col("b")).alias("b")))
    ruled = aliases.select("component", rule_of(
        host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"].alias("said"))
    decided = ruled.dropna().groupBy("component").agg(F.min("said").alias("said"))  # allow < block
    said = stored(aliases.join(decided, "component").select("node", "said"), "aliases")

    rows = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    rows = rows.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    rows = rows.withColumn("_own", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("_node", name_of(F.col("_url"))).join(
        said, F.col("_node") == F.col("node"), "left")
    return rows.select(id_col, "host", "path", F.col("_own.rule").alias("rule"),
                       F.coalesce("_own.verdict", "said", F.lit("allow")).alias("verdict"))
