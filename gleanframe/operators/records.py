"""Records: duplicates, joins with detail pages, audits, snapshots, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe import schemas
from gleanframe.functions import text as t
from gleanframe.functions import urls
from gleanframe.operators.listing import ORDER
from gleanframe.operators.skew import capped_rank


def dedup_keep_first(records: DataFrame, key: str = "property_url",
                     order: tuple[str, ...] = ORDER) -> DataFrame:
    """One record per key, the first in the given order (the smallest, if several stand at the
    same place); null counts as one key.

    An aggregate, so that copies of a record shrink to one per task before the shuffle.
    """
    rest = [c for c in records.columns if c not in (key, *order)]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return records.groupBy(key).agg(first).select(
        *[key if c == key else F.col("_first")[c].alias(c) for c in records.columns])


def dedup_keep_first_text(records: DataFrame, key: str = "text", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The same where the key is a long text: groups are formed by its digest and hold nothing but the
    order columns, which must tell the records apart; the records are then chosen by them."""
    first = records.groupBy(F.sha2(F.col(key).cast("string"), 256).alias("_digest")).agg(
        F.min(F.struct(*order)).alias("_first"))
    return records.join(first.select(*[F.col("_first")[c].alias(c) for c in order]), list(order), "left_semi")


def dedup_dropped_report(records: DataFrame, key: str = "property_url",
                         order: tuple[str, ...] = ORDER) -> DataFrame:
    """The records that dedup_keep_first leaves out, with the number of equal ones (``copies``).

    Equal records are counted first, which brings a record that was stored very often down to one
    row per task; the rest are ranked within their key (capped_rank).
    """
    rest = [c for c in records.columns if c not in (key, *order)]
    counted = records.groupBy(*records.columns).agg(F.count("*").alias("copies"))
    ranked = capped_rank(counted, [key], [*order, *rest], 1, "_place")
    dropped = F.col("copies") - F.when(F.col("_place") == 1, 1).otherwise(0)
    return ranked.withColumn("copies", dropped).filter(F.col("copies") > 0).drop("_place")


def _first_page(detail: DataFrame, key: str, values: list[str], arrival: tuple[str, ...]) -> DataFrame:
    """One page per URL, the first to arrive; values decide only between pages of the same arrival, or
    where the pages do not say when they came."""
    order = [c for c in arrival if c in detail.columns]
    return detail.groupBy(key).agg(F.min(F.struct(*order, *values)).alias("_detail"))


def first_listed(listing: DataFrame, site: str) -> DataFrame:
    """The first listing record of each absolute URL (``url``)."""
    return dedup_keep_first(
        listing.withColumn("url", urls.prefix(site, F.col("property_url")))
        .filter(F.col("url").isNotNull()), "url")


def enrich_listing_with_detail(listing: DataFrame, detail: DataFrame, site: str,
                               arrival: tuple[str, ...] = ("fetched",)) -> DataFrame:
    """Listing records completed by the eight columns of their detail page (22 columns).

    A URL is requested once, so the first listing record of a URL and its first page count; pages that
    came later by the ``arrival`` columns do not.
    Both sides are aggregated by the absolute URL; the join finds them partitioned by it already.
    A listing whose page never arrived gives no row.
    """
    return with_detail(first_listed(listing, site), detail, arrival)


def with_detail(first: DataFrame, detail: DataFrame, arrival: tuple[str, ...] = ("fetched",)) -> DataFrame:
    """First listing records (first_listed) with their first detail pages."""
    page = _first_page(detail, "url", list(schemas.DETAIL_8), arrival)
    return first.join(page, "url").select(
        *schemas.LISTING_14, *[F.col("_detail")[c].alias(c) for c in schemas.DETAIL_8])


def listing_without_detail(listing: DataFrame, pages: DataFrame, site: str) -> DataFrame:
    """Absolute URLs of listed adverts whose detail page never arrived, with the first place they
    are listed at."""
    listed = (
        listing.select(*ORDER, urls.prefix(site, F.col("property_url")).alias("url"))
        .filter(F.col("url").isNotNull())
        .groupBy("url").agg(F.min(F.struct(*ORDER)).alias("_at"))
    )
    return listed.join(pages.select("url").distinct(), "url", "left_anti").select(
        "url", *[F.col("_at")[c].alias(c) for c in ORDER])


# Required fields and the record columns that hold them (fixed values): price is kept as
# rent_per_period.
REQUIRED = {"title": "title", "price": "rent_per_period", "region": "region"}


def _missing(column: Column, kind: str) -> Column:
    """Null, or a value that counts as empty: '', 0 or false."""
    if kind == "string":
        return ~t.truthy(column)
    empty = F.lit(False) if kind == "boolean" else F.lit(0)
    return F.coalesce(column == empty, F.lit(True))


def missing_fields(records: DataFrame, required: dict[str, str] = REQUIRED) -> Column:
    """Names of the required fields a record lacks, as an array."""
    kinds = dict(records.dtypes)
    names = [F.when(_missing(F.col(c), kinds[c]), F.lit(n)) for n, c in required.items()]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def required_field_audit(records: DataFrame, required: dict[str, str] = REQUIRED,
                         keep: tuple[str, ...] = (*ORDER, "property_url")) -> DataFrame:
    """The records that lack a required field, with the list of what they lack."""
    audited = records.withColumn("missing_fields", missing_fields(records, required))
    return audited.filter(F.size("missing_fields") > 0).select(*keep, "missing_fields")


def required_field_totals(records: DataFrame, required: dict[str, str] = REQUIRED) -> DataFrame:
    """Records lacking each required field."""
    lacking = records.select(F.explode(missing_fields(records, required)).alias("field"))
    return lacking.groupBy("field").agg(F.count("*").alias("records"))


def best_of_n_complete(snapshots: DataFrame, key: list[str], complete: Column, n: int = 3,
                       attempt: str = "attempt") -> DataFrame:
    """Per page the first complete one among its first n snapshots; if none is complete, the last
    of them as it is, marked complete = false. An aggregate; no snapshot list is built."""
    others = [c for c in snapshots.columns if c not in (*key, attempt)]
    done = F.coalesce(complete, F.lit(False))
    snapshot = F.struct(attempt, *others)
    best = (
        snapshots.filter(F.col(attempt) <= n)
        .groupBy(*key)
        .agg(F.min(F.when(done, snapshot)).alias("_first"), F.max(snapshot).alias("_last"))
        .withColumn("_pick", F.coalesce("_first", "_last"))
    )
    return best.select(
        *key, *[F.col("_pick")[c].alias(c) for c in (attempt, *others)],
        F.col("_first").isNotNull().alias("complete"))


# The values of a read in the order in which they are taken from the page (fixed values); the URL is known
# before.
READ_ORDER = [
    "title", "location", "type", "property_address", "estate_name", "bedrooms", "bathrooms", "toilets",
    "property_size", "condition", "furnishing", "price_rent", "price_with_period", "seller_or_agent_name",
    "time_on_site"]


def best_of_n_partial(snapshots: DataFrame, key: list[str], complete: Column, fields: list[str], n: int = 3,
                      attempt: str = "attempt", failed_at: str = "failed_at") -> DataFrame:
    """The first complete read of a page among its first n; else what is left after all of them, with
    complete = false.

    A read takes its ``fields`` in order. One that breaks off has taken the first ``failed_at`` of them
    (null: it came to its end): these hold its values, the others those of the read before. So each field
    has the value of the last read that got to it, null included. A page of which some field was never
    reached gives no row (see partial_rejects). A read that broke off is never complete.

    One aggregate with a running greatest value per field; the reads of a page are not gathered.
    """
    return _partial_reads(snapshots, key, complete, fields, n, attempt, failed_at).filter(
        F.col("failed_field").isNull()).drop("failed_field", "reads")


def partial_rejects(snapshots: DataFrame, key: list[str], complete: Column, fields: list[str], n: int = 3,
                    attempt: str = "attempt", failed_at: str = "failed_at") -> DataFrame:
    """The pages that give no record: the first field that none of the ``reads`` got to."""
    return _partial_reads(snapshots, key, complete, fields, n, attempt, failed_at).select(
        *key, "failed_field", "reads").filter(F.col("failed_field").isNotNull())


def _partial_reads(snapshots: DataFrame, key: list[str], complete: Column, fields: list[str], n: int, attempt: str,
                   failed_at: str) -> DataFrame:
    ended = F.col(failed_at).isNull()
    done = F.coalesce(complete, F.lit(False)) & ended
    taken = {f: F.max(F.when(ended | (F.col(failed_at) > place), F.struct(attempt, f))).alias(f"_{f}")
             for place, f in enumerate(fields)}
    read = (
        snapshots.filter(F.col(attempt) <= n)
        .groupBy(*key)
        .agg(F.min(F.when(done, F.struct(attempt, *fields))).alias("_first"), F.max(attempt).alias("_last"),
             F.count("*").alias("reads"), *taken.values())
    )
    found = F.col("_first").isNotNull()
    return read.select(
        *key, F.when(found, F.col("_first")[attempt]).otherwise(F.col("_last")).alias(attempt),
        *[F.when(found, F.col("_first")[f]).otherwise(F.col(f"_{f}")[f]).alias(f) for f in fields],
        found.alias("complete"), "reads",
        F.when(~found, F.coalesce(*[F.when(F.col(f"_{f}").isNull(), F.lit(f)) for f in fields])).alias("failed_field"))


# The four fields a detail snapshot must have to count as complete (fixed values).
CRITICAL = ["seller_or_agent_name", "time_on_site", "condition", "furnishing"]


def critical_fields_present() -> Column:
    return reduce(lambda a, b: a & b, [t.truthy(F.col(x)) for x in CRITICAL])


def union_records(listing: DataFrame, detail: DataFrame) -> DataFrame:
    """Listing and detail records in one table of the canonical 16 columns; rows are kept as they
    are, not merged."""
    renamed = listing.withColumnsRenamed(schemas.LISTING_TO_DETAIL).select(*schemas.DETAIL_16)
    return renamed.unionByName(detail.select(*schemas.DETAIL_16))


def merge_records(listing: DataFrame, detail: DataFrame, arrival: tuple[str, ...] = ("fetched",)) -> DataFrame:
    """One row per URL: the value of its first page where there is one, else the first listing value.

    Both sides are aggregated by URL before the full outer join, which needs no shuffle of its
    own then. Rows without URL belong to no page and are left to union_records.
    """
    values = [c for c in schemas.DETAIL_16 if c != "property_url"]
    named = listing.withColumnsRenamed(schemas.LISTING_TO_DETAIL)
    first = (
        named.filter(F.col("property_url").isNotNull())
        .groupBy("property_url")
        .agg(F.min(F.struct(*ORDER, *values)).alias("_listing"))
    )
    page = _first_page(detail, "property_url", values, arrival)
    merged = first.join(page, "property_url", "full_outer")
    return merged.select(*[
        "property_url" if c == "property_url"
        else F.coalesce(F.col("_detail")[c], F.col("_listing")[c]).alias(c)
        for c in schemas.DETAIL_16])
