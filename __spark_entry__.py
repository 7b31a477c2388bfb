"""Registered queries: each binds one operator to the test tables, or to responses and pages that
Spark renders from them (fixtures/render.py)."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fixtures import render as r  # noqa: E402
from fixtures.oracles import ORACLES  # noqa: E402
from gleanframe.functions import urls  # noqa: E402
from gleanframe.functions.html import Step  # noqa: E402
from gleanframe.operators import details as d  # noqa: E402
from gleanframe.operators import fetchlog, frontier, listing, pages, paging, phrases, records, strict  # noqa: E402
from gleanframe.operators.columns import with_once  # noqa: E402
from gleanframe.operators.seen import SeenStore  # noqa: E402
from gleanframe.plans import flows  # noqa: E402
from gleanframe.plans.counters import RunCounters  # noqa: E402
from gleanframe.schemas import DETAIL_16, DETAIL_8, LISTING_14  # noqa: E402
from gleanframe.session import Stored, scratch_path  # noqa: E402
from gleanframe.sources import csv_table, payloads  # noqa: E402
from gleanframe.streaming import jobs  # noqa: E402


class Inputs:
    """The inputs of the queries. The bench replaces the rendered ones by stored copies."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return r.table(self.spark, self.sf_dir, name)

    def payloads(self) -> DataFrame:
        return r.listing_payloads(self.spark, self.sf_dir)

    def details(self) -> DataFrame:
        return r.detail_pages(self.spark, self.sf_dir)

    def detail_reads(self) -> DataFrame:
        return r.detail_reads(self.spark, self.sf_dir)

    def arrived(self) -> DataFrame:
        return r.arrived_pages(self.spark, self.sf_dir)

    def account_listing(self) -> DataFrame:
        return r.account_listing(self.spark, self.sf_dir)

    def accounts(self) -> DataFrame:
        return r.account_pages(self.spark, self.sf_dir)

    def pages(self) -> DataFrame:
        return payloads.src_pages(self.spark, f"{self.sf_dir}/pages.parquet")

    def log(self) -> DataFrame:
        return r.fetch_log(self.spark, self.sf_dir)

    def strict_payloads(self) -> DataFrame:
        return r.strict_payloads(self.spark, self.sf_dir)

    def broken_pages(self) -> DataFrame:
        return r.broken_pages(self.spark, self.sf_dir)

    def broken_reads(self) -> DataFrame:
        return r.broken_reads(self.spark, self.sf_dir)

    # ---- shared steps

    def parsed(self) -> DataFrame:
        return listing.parse_listing(payloads.src_listing_payloads(self.payloads()))

    def adverts(self) -> DataFrame:
        return listing.listing_explode(self.parsed())

    def record_14(self) -> DataFrame:
        return listing.listing_record_14(self.adverts())

    def record_16(self) -> DataFrame:
        return listing.listing_record_16(self.adverts(), r.SITE)

    def links(self) -> DataFrame:
        return pages.extract_links(self.pages())

    def failures(self) -> DataFrame:
        """Each request has a priority of its own."""
        return self.log().filter(F.col("status") == "error").withColumns({
            "kind": F.col("k") % 4, "p0": F.col("url") % 7})

    def union(self) -> DataFrame:
        return records.union_records(self.record_16(), d.detail_record_16(self.details()))

    def stream(self, name: str) -> DataFrame:
        # as a pattern the path may name one file as well as a folder of files
        path = f"{self.sf_dir}/{name}.parque[t]"
        return jobs.read_parquet_stream(self.spark, path, self.table(name).schema)

    def log_stream(self) -> DataFrame:
        return self.stream("events").select(
            F.col("user_id").alias("url"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
            F.col("event_type").alias("status"))


# ---- sources and sinks

CSV_SCHEMA = ", ".join(f"{c} string" for c in DETAIL_16)


def _csv_path(i: Inputs) -> str:
    path = scratch_path(i.spark, "csv")
    csv_table.sink_csv_overwrite(i.union(), path)
    return path


def src_listing_payloads(i: Inputs) -> DataFrame:
    return payloads.src_listing_payloads(i.payloads())


def src_listing_files(i: Inputs) -> DataFrame:
    """The responses as files, one folder each."""
    path = scratch_path(i.spark, "responses")
    rows = i.payloads().withColumn("page", F.col("page_num"))
    rows.select("page", "body").write.partitionBy("page").text(path)
    return payloads.src_listing_files(i.spark, path, r"page=(\d+)/[^/]*$")


def src_pages(i: Inputs) -> DataFrame:
    return i.pages()


def src_csv_head(i: Inputs) -> DataFrame:
    return csv_table.src_csv_head(i.spark, _csv_path(i), DETAIL_16, schema=CSV_SCHEMA)


def sink_csv_overwrite(i: Inputs) -> DataFrame:
    return csv_table.read_csv_table(i.spark, _csv_path(i), CSV_SCHEMA)


# ---- listing responses

def json_unwrap(i: Inputs) -> DataFrame:
    return listing.json_unwrap(i.payloads())


def json_rejects(i: Inputs) -> DataFrame:
    return listing.json_rejects(i.payloads())


def json_defaults(i: Inputs) -> DataFrame:
    return i.parsed().select(
        "page_num", F.size("adverts").cast("bigint").alias("n_adverts"), "total_pages", "next_url")


def non_empty_listing(i: Inputs) -> DataFrame:
    return listing.non_empty_listing(i.parsed()).select("page_num", "next_url")


def listing_explode(i: Inputs) -> DataFrame:
    return i.adverts().select(
        "page_num", _long("pos"), "advert.title", F.col("advert.url").alias("property_url"))


def attrs_last_wins(i: Inputs) -> DataFrame:
    return listing.attrs_last_wins(i.adverts(), listing.ATTRS_14).select(
        "page_num", _long("pos"), *listing.ATTRS_14)


def attrs_first_match(i: Inputs) -> DataFrame:
    return listing.attrs_first_match(i.adverts(), listing.ATTRS_16).select(
        "page_num", _long("pos"), *listing.ATTRS_16)


def listing_record_14(i: Inputs) -> DataFrame:
    return i.record_14().withColumn("pos", _long("pos"))


def listing_record_16(i: Inputs) -> DataFrame:
    return i.record_16().withColumn("pos", _long("pos"))


# ---- filters

def domain_filter(i: Inputs) -> DataFrame:
    return frontier.domain_filter(i.pages(), ["example.net"]).select("page_id", "url")


def domain_filter_table(i: Inputs) -> DataFrame:
    """Allowed are the sites of which a numbered listing page is stored."""
    stored = i.pages().select("page_id", "url")
    domains = stored.filter(frontier.has_page_parameter(F.col("url"))).select(
        F.regexp_replace(urls.host(F.col("url")), r"^(www|blog|m)\.", "").alias("domain"))
    return frontier.domain_filter_table(stored, domains)


def block_detect(i: Inputs) -> DataFrame:
    return pages.block_detect(i.table("documents"), ["license", "all rights"]).select(
        "doc_id", "blocked")


def phrase_hits(i: Inputs) -> DataFrame:
    """Pairs of neighbouring words of the benchmark, in all documents."""
    words = F.filter(F.split(F.lower("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.array_join(F.slice("words", k, 2), " "))
    table = i.table("benchmark").select(words.alias("words")).filter("size(words) > 1").select(
        F.explode(pairs).alias("phrase"))
    return phrases.phrase_hits(i.table("documents"), table)


def retryable_filter(i: Inputs) -> DataFrame:
    return fetchlog.retryable_filter(i.log(), status="http_status").select(
        "event_id", "url", "http_status")


# ---- pages

TEXTS = {"title": ("title", None), "ad": ("div", "ad"), "h1": ("h1", None)}


def extract_links(i: Inputs) -> DataFrame:
    return i.links().select("page_id", _long("pos"), "href")


def extract_links_selected(i: Inputs) -> DataFrame:
    return pages.extract_links_selected(i.details(), d.LISTING_ANCHOR).withColumn("pos", _long("pos"))


def absolutize_urls(i: Inputs) -> DataFrame:
    return pages.absolutize_urls(i.links(), r.SITE).select(
        "page_id", _long("pos"), "stripped_url", "prefixed_url", "resolved_url")


def extract_first_text(i: Inputs) -> DataFrame:
    return pages.extract_first_text(i.pages(), TEXTS)


def extract_all_texts(i: Inputs) -> DataFrame:
    return pages.extract_all_texts(i.pages(), "a").select(
        "page_id", F.size("texts").cast("bigint").alias("n_texts"),
        F.array_join("texts", "|").alias("texts"))


def kv_table_explode(i: Inputs) -> DataFrame:
    return d.kv_table_explode(i.details()).withColumn("pos", _long("pos"))


def kv_pick_exact(i: Inputs) -> DataFrame:
    return d.kv_pick_exact(i.details(), "estate name", "estate_name")


def kv_pick_any_keyword(i: Inputs) -> DataFrame:
    return d.kv_pick_any_keyword(i.details(), d.CONDITION_WORDS, "condition")


def kv_pick_last_chain(i: Inputs) -> DataFrame:
    return d.kv_pick_last_chain(i.details())


def icon_classify(i: Inputs) -> DataFrame:
    return d.icon_classify(i.details())


def detail_record_16(i: Inputs) -> DataFrame:
    return d.detail_record_16(i.details())


def detail_fields_8(i: Inputs) -> DataFrame:
    return d.detail_fields_8(i.details(), r.STAT_PHRASE)


def account_record_7(i: Inputs) -> DataFrame:
    return d.account_record_7(i.accounts())


def account_rejects(i: Inputs) -> DataFrame:
    return d.account_rejects(i.accounts())


# ---- joins and records

def enrich_listing_with_detail(i: Inputs) -> DataFrame:
    detail = d.detail_fields_8(i.arrived(), r.STAT_PHRASE, keep=("fetched",))
    return records.enrich_listing_with_detail(i.record_14(), detail, r.SITE)


def listing_without_detail(i: Inputs) -> DataFrame:
    return records.listing_without_detail(i.record_14(), i.details(), r.SITE).withColumn(
        "pos", _long("pos"))


def frontier_unseen(i: Inputs) -> DataFrame:
    """Seen are the links of the numbered listing pages."""
    links = i.links().withColumn("on_listing", frontier.has_page_parameter(F.col("url")))
    links = with_once(links, "url", urls.resolve(F.col("url"), F.col("href")))
    return frontier.frontier_unseen_marked(links, F.col("on_listing"))


def frontier_increment(i: Inputs) -> DataFrame:
    """The same against a store that the links of the listing pages came to in three appends."""
    links = i.links().withColumn("on_listing", frontier.has_page_parameter(F.col("url")))
    links = with_once(links, "url", urls.resolve(F.col("url"), F.col("href")))
    links = Stored(links.select("page_id", "url", "on_listing"), "links").rows
    store = SeenStore(i.spark, f"seen_{uuid.uuid4().hex}", scratch_path(i.spark, "seen"), buckets=8)
    for part in range(3):
        store.add(links.filter(F.col("on_listing") & (F.col("page_id") % 3 == part)))
    found = Stored(store.unseen(links), "unseen").rows
    store.drop()
    return found


def dedup_keep_first(i: Inputs) -> DataFrame:
    return records.dedup_keep_first(i.record_14()).withColumn("pos", _long("pos"))


def dedup_keep_first_text(i: Inputs) -> DataFrame:
    return records.dedup_keep_first_text(i.table("documents").select("doc_id", "text", "source"))


def dedup_dropped_report(i: Inputs) -> DataFrame:
    report = records.dedup_dropped_report(
        i.record_14().select("page_num", "pos", "title", "property_url"))
    return report.withColumn("pos", _long("pos"))


def page_yield(i: Inputs) -> DataFrame:
    return listing.page_yield(i.parsed())


def required_field_audit(i: Inputs) -> DataFrame:
    return records.required_field_audit(i.record_14()).select(
        "page_num", _long("pos"), "property_url",
        F.array_join("missing_fields", ",").alias("missing_fields"))


def required_field_totals(i: Inputs) -> DataFrame:
    return records.required_field_totals(i.record_14())


def best_of_n_complete(i: Inputs) -> DataFrame:
    return records.best_of_n_complete(
        r.snapshots(i.spark, i.sf_dir).drop("ts"), ["user_id", "event_type"], F.col("value") >= 100)


def union_records(i: Inputs) -> DataFrame:
    return i.union()


def merge_records(i: Inputs) -> DataFrame:
    return records.merge_records(i.record_16(), d.detail_record_16(i.arrived(), keep=("fetched",)))


# ---- what breaks off, and what a run did

def best_of_n_partial(i: Inputs) -> DataFrame:
    return flows.partial_reads(i.broken_reads())


def partial_rejects(i: Inputs) -> DataFrame:
    return flows.partial_read_rejects(i.broken_reads())


def json_defaults_strict(i: Inputs) -> DataFrame:
    return strict.json_defaults_strict(i.strict_payloads()).select(
        "page_num", F.size("adverts").cast("bigint").alias("n_adverts"),
        F.to_json("total_pages").alias("total_pages"), "next_url")


def listing_record_raw(i: Inputs) -> DataFrame:
    adverts = strict.adverts_strict(strict.json_defaults_strict(i.strict_payloads()))
    return strict.as_json(strict.listing_record_raw(adverts).select(
        "page_num", _long("pos"), "title", "rent_per_period", "rent_period", "bedrooms"))


def strict_rejects(i: Inputs) -> DataFrame:
    return strict.strict_rejects(i.strict_payloads()).withColumn("pos", _long("pos"))


def detail_rejects(i: Inputs) -> DataFrame:
    return d.detail_rejects(d.detail_audit(i.broken_pages())).drop("message")


def detail_accepted(i: Inputs) -> DataFrame:
    return d.detail_accepted(d.detail_audit(i.broken_pages()))


def flow_counters(i: Inputs) -> DataFrame:
    """What a run of the rent flow counted while its table was written."""
    counters = RunCounters()
    rows = flows.rent_listing_flow(i.payloads(), i.arrived(), r.SITE, r.STAT_PHRASE, counters)
    csv_table.sink_csv_overwrite(rows, scratch_path(i.spark, "rent"), rows.columns)
    return counters.table(i.spark)


# ---- fetch log

def status_histogram(i: Inputs) -> DataFrame:
    return fetchlog.status_histogram(i.log())


def failure_report(i: Inputs) -> DataFrame:
    micros = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', cast({} as timestamp_ntz))"
    return fetchlog.failure_report(i.failures()).select(
        "kind", "url", "failures", F.expr(micros.format("first_ts")).alias("first_us"),
        F.expr(micros.format("last_ts")).alias("last_us"))


def failure_totals(i: Inputs) -> DataFrame:
    return fetchlog.failure_totals(i.failures())


def retry_schedule(i: Inputs) -> DataFrame:
    return fetchlog.retry_schedule(i.failures(), priority=F.col("p0")).drop("ts")


def retry_schedule_exception(i: Inputs) -> DataFrame:
    return fetchlog.retry_schedule_exception(i.failures(), priority=F.col("p0")).drop("ts")


def frontier_ordered(i: Inputs) -> DataFrame:
    return frontier.frontier_ordered(fetchlog.retries_due(i.failures()), 100, discovery=("ts", "event_id")).select(
        "url", "event_id", "priority")


# ---- pagination

def page_number(i: Inputs) -> DataFrame:
    return paging.page_number(i.pages()).select("page_id", "page_num", "number_after_equals")


def next_page_url(i: Inputs) -> DataFrame:
    return paging.next_page_url(i.pages(), r.SITE, r.SLUG, r.API, F.col("page_id")).select(
        "page_id", "next_counted_url", "next_html_url", "api_url")


def _responses(i: Inputs) -> DataFrame:
    return i.parsed().select(F.lit(r.LISTING).alias("listing"), "page_num", "total_pages")


def page_plan(i: Inputs) -> DataFrame:
    fetched = i.payloads().select(F.lit(r.LISTING).alias("listing"), "page_num")
    return paging.page_plan(_responses(i), fetched)


def page_gap_report(i: Inputs) -> DataFrame:
    return paging.page_gap_report(_responses(i))


def _pointers(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Pointers and the pages that nothing points to. Every third listing has a page limit that comes
    before its last pointer."""
    part = i.table("part")
    last = part.agg(F.max("p_partkey")).scalar()
    ahead = F.col("p_partkey") + 250
    pointers = part.select(
        F.col("p_partkey").alias("page"),
        F.when((F.col("p_size") != 50) & (ahead <= last), ahead).alias("next_page"),
        F.floor(F.col("p_partkey") / 250).alias("page_num"),
        F.when(F.col("p_partkey") % 250 % 3 == 0, 3).otherwise(1_000_000_000).alias("total_pages"))
    led_to = pointers.select(F.col("next_page").alias("page")).dropna()
    seeds = pointers.select("page").join(led_to, "page", "left_anti")
    return pointers, seeds


def next_pointer_closure(i: Inputs) -> DataFrame:
    """All chains."""
    return paging.next_pointer_closure(*_pointers(i))


def next_pointer_increment(i: Inputs) -> DataFrame:
    """The same when the pages come in three parts, of which each goes on where the chains ended before."""
    pointers, seeds = _pointers(i)
    last = pointers.agg(F.max("page_num") + 1).scalar()
    parts = [pointers.filter(F.floor(F.col("page_num") * 3 / last) == n) for n in range(3)]
    reached, known = paging.next_pointer_closure(parts[0], seeds), parts[0]
    for part in parts[1:]:
        reached = paging.next_pointer_increment(reached, known, part)
        known = known.unionByName(part)
    return reached


# ---- whole flows

def rent_listing_flow(i: Inputs) -> DataFrame:
    return flows.rent_listing_flow(i.payloads(), i.arrived(), r.SITE, r.STAT_PHRASE)


def sale_listing_flow(i: Inputs) -> DataFrame:
    return flows.sale_listing_flow(i.payloads(), i.detail_reads(), r.SITE)


def account_flow(i: Inputs) -> DataFrame:
    """Of the account pages, every eleventh never arrived."""
    arrived = i.accounts().filter(F.regexp_extract("url", r"(\d+)$", 1).cast("bigint") % 11 != 7)
    return flows.account_flow(i.account_listing(), arrived, d.HEADING_ANCHOR)


def account_links(i: Inputs) -> DataFrame:
    """All links of pages with attribute values in every form."""
    return pages.extract_links(i.account_listing()).select("page_id", _long("pos"), "href")


def account_texts(i: Inputs) -> DataFrame:
    """Texts of elements with elements in them."""
    return pages.extract_all_texts(i.account_listing(), "a").select(
        "page_id", F.array_join("texts", "|").alias("texts"))


def link_flow(i: Inputs) -> DataFrame:
    """Links of the navigation, on one site; seen are those of the numbered listing pages."""
    chain = (Step("nav"), Step("li"), Step("a"))
    listing_pages = i.pages().filter(frontier.has_page_parameter(F.col("url")))
    seen = with_once(
        pages.extract_links(listing_pages), "url", urls.resolve(F.col("url"), F.col("href")))
    return flows.link_flow(i.pages(), seen, chain, ["example.net"])


# ---- streams

def _finished(i: Inputs, label: str, start: Callable) -> DataFrame:
    folder = scratch_path(i.spark, label)
    start(folder).awaitTermination()
    return i.spark.read.parquet(f"{folder}/out")


def stream_extract(i: Inputs) -> DataFrame:
    rows = pages.extract_first_text(i.stream("pages"), TEXTS)
    return _finished(i, "extract", lambda folder: jobs.stream_extract(rows, folder))


def stream_dedup(i: Inputs) -> DataFrame:
    """The log spans a month, so with this delay no URL returns."""
    return _finished(i, "dedup", lambda folder: jobs.stream_dedup(
        i.log_stream(), folder, delay="60 days")).select("url", "event_id")


def stream_enrich(i: Inputs) -> DataFrame:
    """Adverts are listed a minute apart; their pages come half an hour later, some once more."""
    listed = i.record_14().filter("property_url is not null").withColumns({
        "url": urls.prefix(r.SITE, F.col("property_url")),
        "listed_at": r.at_minute(F.col("page_num") * 20 - 20 + F.col("pos"))})
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("bigint")
    detail = d.detail_fields_8(i.arrived(), r.STAT_PHRASE, keep=("fetched",)).withColumn(
        "fetched_at", r.at_minute(number, 30) + F.make_interval(hours="fetched"))
    left, right = Stored(listed, "listed"), Stored(detail, "fetched")
    sides = [jobs.read_parquet_stream(i.spark, side.path, side.rows.schema) for side in (left, right)]
    folder = scratch_path(i.spark, "enrich")
    jobs.stream_enrich(*sides, folder, wait="1 day", delay="30 days").awaitTermination()
    return jobs.enriched(i.spark, folder, [*LISTING_14, *DETAIL_8], ("page_num", "pos", "fetched"))


def stream_status_counts(i: Inputs) -> DataFrame:
    return _finished(i, "status", lambda folder: jobs.stream_status_counts(i.log_stream(), folder))


def stream_retry_state(i: Inputs) -> DataFrame:
    failures = i.log_stream().filter("status = 'error'").select("url", "ts", "event_id")
    return _finished(i, "retry", lambda folder: jobs.stream_retry_state(failures, folder)).drop(
        "ts", "batch")


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the subpackage for training text, none where it is absent."""
    try:
        import corpus_pipeline
        from gleanframe.llm import queries as llm
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "gleanframe.llm", "gleanframe.llm.queries"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {**llm.ORACLES, **sql}


def _long(name: str):
    return F.col(name).cast("bigint").alias(name)


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    f.__name__: f for f in (
        src_listing_payloads, src_listing_files, src_pages, src_csv_head, sink_csv_overwrite,
        json_unwrap, json_rejects, json_defaults, non_empty_listing, listing_explode,
        attrs_last_wins, attrs_first_match, listing_record_14, listing_record_16,
        domain_filter, domain_filter_table, block_detect, retryable_filter,
        extract_links, extract_links_selected, absolutize_urls, extract_first_text,
        extract_all_texts, kv_table_explode, kv_pick_exact, kv_pick_any_keyword,
        kv_pick_last_chain, icon_classify, detail_record_16, detail_fields_8,
        account_record_7, account_rejects,
        enrich_listing_with_detail, listing_without_detail, frontier_unseen,
        dedup_keep_first, dedup_keep_first_text, dedup_dropped_report, status_histogram,
        page_yield, required_field_audit, required_field_totals, failure_report, failure_totals,
        best_of_n_complete, retry_schedule, retry_schedule_exception, frontier_ordered,
        union_records, merge_records, best_of_n_partial, partial_rejects, json_defaults_strict,
        listing_record_raw, strict_rejects, detail_rejects, detail_accepted, flow_counters,
        page_number, next_page_url, page_plan, page_gap_report, next_pointer_closure,
        next_pointer_increment,
        rent_listing_flow, sale_listing_flow, account_flow, account_links, account_texts, link_flow,
        stream_extract, stream_dedup, stream_enrich, stream_status_counts, stream_retry_state,
        frontier_increment, phrase_hits,
    )
}


def entry(spark: SparkSession) -> DataFrame:
    """Listing responses joined with their detail pages, on the smallest tables."""
    return enrich_listing_with_detail(Inputs(spark, "/root/testdata/sf0.001"))


def _bound(query: Callable[[Inputs], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(Inputs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_bound, query) for name, query in QUERIES.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **_training_data()[1]}
