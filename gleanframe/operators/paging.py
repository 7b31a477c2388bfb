"""Pagination: page numbers, next pages, planned and missing pages, pointer chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.functions import urls
from gleanframe.functions.text import part
from gleanframe.operators.frontier import unseen
from gleanframe.operators.skew import join_hot
from gleanframe.session import Stored


def page_number(pages: DataFrame, url: str = "url") -> DataFrame:
    """Both ways to read the page number: the 'page' parameter (1 when absent), and the integer
    after the first '='."""
    return pages.withColumns({
        "page_num": urls.page_parameter(F.col(url)),
        "number_after_equals": urls.number_after_equals(F.col(url)),
    })


def next_page_url(pages: DataFrame, site: str, slug: str, api_base: str, stamp: Column,
                  url: str = "url") -> DataFrame:
    """URLs that follow a page: the URL counted up after its first '=', the next page of the HTML
    listing, and the API call for this page. ``stamp`` is the time stamp parameter; it is data,
    not the clock, so that a rerun gives the same URL."""
    u, n = F.col(url), F.col("page_num")
    api = urls.with_parameters(api_base, {
        "slug": F.lit(slug), "init_page": F.lit("true"), "page": n.cast("string"),
        "webp": F.lit("false"), "lsmid": stamp.cast("string"),
    })
    counted = F.concat(part(u, "=", 0), F.lit("="), (urls.number_after_equals(u) + 1).cast("string"))
    return pages.withColumn("page_num", urls.page_parameter(u)).withColumns({
        "next_counted_url": counted,
        "next_html_url": F.concat(F.lit(f"{site}/{slug}?page="), (n + 1).cast("string")),
        "api_url": F.when(n.isNotNull(), api),
    })


def _number_range(ranges: DataFrame, first: str, last: str, name: str,
                  chunk: int = 10_000) -> DataFrame:
    """One row per number of each range. Long ranges are cut and spread first, so that no task
    writes out a whole listing."""
    steps = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(last) - F.col(first)) / chunk))
    cut = ranges.filter(F.col(first) <= F.col(last)).withColumn("_chunk", F.explode(steps))
    start = F.col(first) + F.col("_chunk") * chunk
    end = F.least(F.col(last), start + (chunk - 1))
    return (
        cut.repartition(*[c for c in ranges.columns if c not in (first, last)], "_chunk")
        .withColumn(name, F.explode(F.sequence(start, end)))
        .drop("_chunk", first, last)
    )


def page_plan(responses: DataFrame, fetched: DataFrame, key: str = "listing") -> DataFrame:
    """Pages still to be requested per listing: from the page after the first one read up to
    total_pages, less those already fetched. ``responses`` has key, page_num, total_pages."""
    ranges = responses.filter(F.col("page_num") < F.col("total_pages")).groupBy(key).agg(
        (F.min("page_num") + 1).alias("_first"), F.max("total_pages").alias("_last"))
    return unseen(_number_range(ranges, "_first", "_last", "page_num"), fetched, [key, "page_num"])


def page_gap_report(responses: DataFrame, key: str = "listing") -> DataFrame:
    """Pages of each listing, from 1 to total_pages, without a readable response."""
    ranges = responses.groupBy(key).agg(
        F.lit(1).cast("bigint").alias("_first"), F.max("total_pages").alias("_last"))
    return unseen(_number_range(ranges, "_first", "_last", "page_num"), responses, [key, "page_num"])


def next_pointer_closure(pointers: DataFrame, seeds: DataFrame, page: str = "page",
                         next_page: str = "next_page", page_num: str = "page_num",
                         total_pages: str = "total_pages") -> DataFrame:
    """Pages reachable from the seeds over next pointers, with their distance to the nearest seed. Where
    the pointers carry a page number and the number of pages, a pointer of the last page does not count.

    A page points to at most one next page (the smallest is taken if copies disagree). Following
    the chain page by page would need one round per page; here the pointer length doubles each
    round, so a chain of a million pages takes twenty rounds. Each round is stored in the
    shared folder, and the one before it deleted. Cycles end, because a round without new pages ends
    the loop.
    """
    counts = F.col(next_page).isNotNull()
    if {page_num, total_pages} <= set(pointers.columns):
        counts &= F.col(page_num) < F.col(total_pages)
    jump = (
        pointers.filter(counts)
        .groupBy(F.col(page).alias("_from")).agg(F.min(next_page).alias("_to"))
    )
    # where no two pages point to the same one, none do so over longer steps either
    no_merging = jump.groupBy("_to").agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()
    reached = seeds.select(F.col(page)).distinct().withColumn("depth", F.lit(0).cast("bigint"))
    reached, length = Stored(reached, "reached"), 1
    pointer: Stored | None = None
    while True:
        ahead = reached.rows.join(jump, F.col(page) == F.col("_from")).select(
            F.col("_to").alias(page), (F.col("depth") + length).alias("depth"))
        both = reached.rows.unionByName(ahead).groupBy(page).agg(F.min("depth").alias("depth"))
        reached = reached.replaced(both)
        # pages found in this round are at least this far from every seed
        if reached.rows.filter(F.col("depth") >= length).isEmpty():
            break
        second = jump.select(F.col("_from").alias("_to"), F.col("_to").alias("_end"))
        twice = (jump.join(second, "_to") if no_merging else join_hot(jump, second, "_to")).select(
            "_from", F.col("_end").alias("_to"))
        pointer = pointer.replaced(twice) if pointer else Stored(twice, "pointers")
        jump, length = pointer.rows, 2 * length
    if pointer:
        pointer.delete()
    return reached.rows


def _effective(pointers: DataFrame, page: str, next_page: str, page_num: str, total_pages: str) -> DataFrame:
    """The one page that a page points to, as (_from, _to)."""
    counts = F.col(next_page).isNotNull()
    if {page_num, total_pages} <= set(pointers.columns):
        counts &= F.col(page_num) < F.col(total_pages)
    return pointers.filter(counts).groupBy(F.col(page).alias("_from")).agg(F.min(next_page).alias("_to"))


def _nearest(starts: DataFrame, jump: DataFrame, page: str) -> DataFrame:
    """Pages that the starts (page, depth) lead to, with their least depth. The step doubles each round;
    a round that improves nothing ends it, as then no longer step would either."""
    # where no two pages point to the same one, none do so over longer steps either
    no_merging = jump.groupBy("_to").agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()
    reached, pointer, length = Stored(starts.groupBy(page).agg(F.min("depth").alias("depth")), "nearest"), None, 1
    while True:
        ahead = reached.rows.join(jump, F.col(page) == F.col("_from")).select(
            F.col("_to").alias(page), (F.col("depth") + length).alias("depth"), F.lit(True).alias("_new"))
        both = reached.rows.withColumn("_new", F.lit(False)).unionByName(ahead).groupBy(page).agg(
            F.min("depth").alias("depth"), F.min(F.struct("depth", "_new")).alias("_first"))
        found = Stored(both.select(page, "depth", F.col("_first._new").alias("_new")), "nearest")
        reached.delete()
        reached = found
        if reached.rows.filter("_new").isEmpty():
            break
        reached.rows = reached.rows.drop("_new")
        second = jump.select(F.col("_from").alias("_to"), F.col("_to").alias("_end"))
        twice = jump.join(second, "_to") if no_merging else join_hot(jump, second, "_to")
        twice = Stored(twice.select("_from", F.col("_end").alias("_to")), "pointers")
        if pointer:
            pointer.delete()
        pointer, length = twice, 2 * length
        jump = pointer.rows
    if pointer:
        pointer.delete()
    return reached.rows.drop("_new")


def next_pointer_increment(reached: DataFrame, pointers: DataFrame, added: DataFrame, seeds: DataFrame | None = None,
                           page: str = "page", next_page: str = "next_page", page_num: str = "page_num",
                           total_pages: str = "total_pages") -> DataFrame:
    """The closure (page, depth) after ``added`` pointers and further ``seeds`` have come to the ``pointers`` that
    ``reached`` was made from; equal to next_pointer_closure over all of them.

    New pages are found along added pointers and those of pages that were not reached before; chains that were
    reached are only followed again where a new way to one of their pages is shorter, and then their depths
    are made smaller. A copy that gives a page another next page than it had takes an old way away, so then
    the closure is made anew from the seeds.
    """
    names = (page, next_page, page_num, total_pages)
    old, new = _effective(pointers, *names), Stored(_effective(added, *names), "added")
    starts = reached.select(page).limit(0).withColumn("depth", F.lit(0).cast("bigint"))
    if seeds is not None:
        starts = seeds.select(page).distinct().withColumn("depth", F.lit(0).cast("bigint"))
    both = new.rows.join(old.select("_from", F.col("_to").alias("_was")), "_from", "left")
    if not both.filter("_to < _was").isEmpty():
        new.delete()
        everything = pointers.unionByName(added, allowMissingColumns=True)
        return next_pointer_closure(
            everything, reached.filter("depth = 0").select(page).union(starts.select(page)), *names)
    fresh = Stored(both.filter("_was is null").select("_from", "_to"), "added")
    new.delete()
    # ways out of pages that were reached before, which had none
    before = reached.select(F.col(page).alias("_from"), "depth")
    out = fresh.rows.join(before, "_from").select(F.col("_to").alias(page), (F.col("depth") + 1).alias("depth"))
    starts = Stored(out.unionByName(starts), "starts")
    beyond = fresh.rows.unionByName(old).join(before.select("_from"), "_from", "left_anti")
    near = Stored(_nearest(starts.rows, beyond, page), "near")
    known = reached.select(F.col(page).alias("_page"), F.col("depth").alias("_depth"))
    shorter = near.rows.join(known, F.col(page) == F.col("_page")).filter("depth < _depth").select(page, "depth")
    found = near.rows
    if not shorter.isEmpty():
        found = found.unionByName(_nearest(shorter, fresh.rows.unionByName(old), page))
    result = Stored(reached.select(page, "depth").unionByName(found).groupBy(page).agg(
        F.min("depth").alias("depth")), "reached")
    for table in (near, starts, fresh):
        table.delete()
    return result.rows
