"""The whole flows, from stored responses and pages to the written table. Each is one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.functions import urls
from gleanframe.functions.html import Step
from gleanframe.functions.text import part
from gleanframe.operators import details, frontier, listing, pages, records
from gleanframe.operators.columns import with_once
from gleanframe.plans.counters import RunCounters


def rent_listing_flow(payloads: DataFrame, detail_pages: DataFrame, site: str, stat_phrase: str,
                      counters: RunCounters | None = None) -> DataFrame:
    """JSON listing and its detail pages -> enriched records, one per URL (22 columns). ``counters`` are told
    what passes while the flow runs."""
    parsed = listing.parse_listing(payloads)
    found = listing.listing_record_14(listing.listing_explode(counters.responses(parsed) if counters else parsed))
    first = records.first_listed(counters.items(found) if counters else found, site)
    return records.with_detail(
        counters.kept(first) if counters else first,
        details.detail_fields_8(detail_pages, stat_phrase,
                                keep=("fetched",) if "fetched" in detail_pages.columns else ()))


def sale_listing_flow(payloads: DataFrame, snapshots: DataFrame, site: str, n: int = 3) -> DataFrame:
    """Browsed listing and up to n snapshots per detail page -> one feed of the canonical 16
    columns. ``snapshots`` has url, attempt, html; a read that failed has no html: it counts as an
    attempt but yields nothing. With a column ``failed_at``, reads that broke off between two fields count
    for the fields before (best_of_n_partial)."""
    adverts = listing.listing_explode(listing.parse_listing(payloads))
    if "failed_at" in snapshots.columns:
        best = partial_reads(snapshots, n).drop("attempt", "complete")
        return records.union_records(listing.listing_record_16(adverts, site), best)
    # filtered here as well, since Spark cannot move a filter below the page walk
    usable = snapshots.filter((F.col("attempt") <= n) & F.col("html").isNotNull())
    best = records.best_of_n_complete(
        details.detail_record_16(usable, keep=("attempt",)), ["property_url"],
        records.critical_fields_present(), n)
    return records.union_records(listing.listing_record_16(adverts, site), best)


def _tried_reads(snapshots: DataFrame, n: int) -> DataFrame:
    tried = snapshots.filter(F.col("attempt") <= n).withColumn(
        "failed_at", F.when(F.col("html").isNull(), 0).otherwise(F.col("failed_at")))
    return details.detail_record_16(tried, keep=("attempt", "failed_at"))


def partial_reads(snapshots: DataFrame, n: int = 3) -> DataFrame:
    """Reads of detail pages (url, attempt, html, failed_at) -> one record per page, from all reads that got
    anywhere. A read without html got nowhere."""
    return records.best_of_n_partial(
        _tried_reads(snapshots, n), ["property_url"], records.critical_fields_present(), records.READ_ORDER, n)


def partial_read_rejects(snapshots: DataFrame, n: int = 3) -> DataFrame:
    """The pages that no read got through, with the first field that none reached."""
    return records.partial_rejects(
        _tried_reads(snapshots, n), ["property_url"], records.critical_fields_present(), records.READ_ORDER, n)


def link_flow(listing_pages: DataFrame, seen: DataFrame, chain: tuple[Step, ...],
              domains: list[str]) -> DataFrame:
    """Listing pages (page_id, url, html) -> the links to request next: those the chain of steps
    reaches, made absolute, on allowed hosts, not in ``seen`` (url), each once. URLs that differ
    in fragment or order of parameters only are one request and come in one form."""
    links = pages.extract_links_selected(listing_pages, chain, keep=("page_id", "url"))
    absolute = with_once(links, "link", urls.resolve(F.col("url"), F.col("href")))
    absolute = with_once(absolute.select("page_id", "link"), "url", urls.canonical(F.col("link")))
    return frontier.frontier_unseen(
        frontier.domain_filter(absolute, domains),
        with_once(seen.select("url"), "url", urls.canonical(F.col("url"))))


def account_requests(listing_pages: DataFrame, chain: tuple[Step, ...]) -> tuple[DataFrame, DataFrame]:
    """Listing pages (page_id, url, html) -> the detail pages to request (url, first_page, n_links), each
    once, and the next pages (page_id, url), only of pages that have links. The pages are walked once
    for each of the two."""
    links = pages.extract_links_selected(listing_pages, chain, keep=("page_id", "url"))
    absolute = with_once(links, "link", urls.resolve(F.col("url"), F.col("href"))).select(
        "page_id", F.col("link").alias("url"))
    requests = absolute.groupBy("url").agg(F.min("page_id").alias("first_page"), F.count("*").alias("n_links"))
    counted = F.concat(part(F.col("url"), "=", 0), F.lit("="),
                       (urls.number_after_equals(F.col("url")) + 1).cast("string"))
    following = links.filter("pos = 0").select("page_id", counted.alias("url"))
    return requests, following


def account_flow(listing_pages: DataFrame, detail_pages: DataFrame, chain: tuple[Step, ...]) -> DataFrame:
    """Listing pages and the account pages that arrived -> one row per request: ``kind`` is next_page,
    record, reject (with ``failed_field``) or missing for a detail page that did not arrive. A detail page
    is walked once, and only if it was asked for."""
    requests, following = account_requests(listing_pages, chain)
    arrived = details.account_audit(detail_pages.join(requests.select("url"), "url", "left_semi"))
    rows = requests.join(arrived.withColumn("_arrived", F.lit(True)), "url", "left")
    kind = F.when(F.col("_arrived").isNull(), "missing").when(
        F.col("failed_field").isNull(), "record").otherwise("reject")
    return rows.withColumn("kind", kind).drop("_arrived", "n_links").unionByName(
        following.select("url", F.col("page_id").alias("first_page"), F.lit("next_page").alias("kind")),
        allowMissingColumns=True)
