"""What to fetch next: allowed hosts, unseen links, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.functions import urls


def domain_filter(links: DataFrame, domains: list[str], url: str = "url") -> DataFrame:
    """Keep links whose host is one of the domains or below one. A crawler lists its domains in
    its settings, so they are one pattern here, and nothing is joined or shuffled."""
    return links.filter(F.col(url).rlike(urls.host_pattern(domains)))


def domain_filter_table(links: DataFrame, domains: DataFrame, url: str = "url",
                        domain: str = "domain") -> DataFrame:
    """The same with the domains in a table of any size.

    Only the distinct hosts meet the domains, by equality on their parent domains, and only on those
    with as many labels as some domain has: top-level domains, which very many hosts share, come up
    only if one is allowed. The links then meet the allowed hosts. No theta join, links are not
    multiplied, and they are read twice.
    """
    names = domains.select(F.lower(domain).alias("_suffix")).distinct()
    labels = names.agg(F.collect_set(F.size(F.split("_suffix", r"\.")))).scalar()
    hosts = links.select(urls.host(F.col(url)).alias("_host")).distinct()
    suffixes = F.filter(urls.host_suffixes(F.col("_host")),
                        lambda s: F.array_contains("_labels", F.size(F.split(s, r"\."))))
    allowed = (
        hosts.withColumn("_labels", labels).select("_host", F.explode(suffixes).alias("_suffix"))
        .join(names, "_suffix", "left_semi")
        .select("_host").distinct()
    )
    return links.withColumn("_host", urls.host(F.col(url))).join(allowed, "_host", "left_semi").drop("_host")


def frontier_unseen(links: DataFrame, seen: DataFrame, key: str = "url",
                    source: str = "page_id") -> DataFrame:
    """Links not yet requested, each once, with the first page that shows it.

    Links are aggregated first (a link that stands on every page shrinks to one row per task
    before the shuffle), and so is the seen side, which may hold copies too.
    """
    found = links.groupBy(key).agg(
        F.min(source).alias("first_page"), F.count("*").alias("n_links"))
    return found.join(seen.select(key).distinct(), key, "left_anti")


def frontier_unseen_marked(links: DataFrame, seen: Column, key: str = "url", source: str = "page_id") -> DataFrame:
    """The same where a link tells itself whether its URL counts as seen: one aggregate, one pass."""
    found = links.groupBy(key).agg(
        F.min(source).alias("first_page"), F.count("*").alias("n_links"), F.bool_or(seen).alias("_seen"))
    return found.filter(~F.coalesce("_seen", F.lit(False))).drop("_seen")


def frontier_ordered(frontier: DataFrame, k: int, priority: str = "priority",
                     discovery: tuple[str, ...] = ("first_page", "pos")) -> DataFrame:
    """The next k requests: highest priority first, then in order of discovery. Each task keeps
    its own k rows; nothing is sorted as a whole."""
    return frontier.orderBy(F.desc(priority), *discovery).limit(k)


def unseen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys do not occur in ``seen``."""
    return df.join(seen.select(*keys).distinct(), keys, "left_anti")


def has_page_parameter(url: Column) -> Column:
    return url.rlike(r"[?&]page=")
