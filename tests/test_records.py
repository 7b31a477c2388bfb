"""Joins, audits, snapshots, union and the written table."""

from pyspark.sql import functions as F

from gleanframe import schemas
from gleanframe.operators import details, fetchlog, records
from gleanframe.plans import flows
from gleanframe.sources import csv_table
from fixtures import render

SF = "/root/testdata/sf0.001"


def test_best_of_n(spark):
    rows = [("a", 1, "", 1), ("a", 2, "x", 2), ("a", 3, "y", 3),     # the first complete one
            ("b", 1, None, 4), ("b", 2, "", 5),                      # none complete: the last
            ("c", 1, None, 6), ("c", 2, None, 7), ("c", 3, None, 8), ("c", 4, "z", 9)]  # too late
    df = spark.createDataFrame(rows, "url string, attempt int, seller string, id int")
    got = records.best_of_n_complete(df, ["url"], F.col("seller") != "")
    assert sorted((r.url, r.attempt, r.id, r.complete) for r in got.collect()) == [
        ("a", 2, 2, True), ("b", 2, 5, False), ("c", 3, 8, False)]


def test_required_fields_count_empty_and_zero_as_missing(spark):
    df = spark.createDataFrame(
        [(1, 0, "/a", "t", 5.0, "r"), (1, 1, "/b", "", 0.0, None), (1, 2, "/c", None, None, "r")],
        "page_num int, pos int, property_url string, title string, rent_per_period double, region string")
    rows = {r.property_url: r.missing_fields for r in records.required_field_audit(df).collect()}
    assert rows == {"/b": ["title", "price", "region"], "/c": ["title", "price"]}
    totals = {r.field: r.records for r in records.required_field_totals(df).collect()}
    assert totals == {"title": 2, "price": 2, "region": 1}


def _listing(spark, rows):
    names = ["page_num", "pos", *schemas.LISTING_14]
    schema = ", ".join(f"{n} {'long' if n in ('page_num', 'pos') else 'string'}" for n in names)
    full = [(p, q, *[t if n == "title" else u if n == "property_url" else None for n in schemas.LISTING_14])
            for p, q, t, u in rows]
    return spark.createDataFrame(full, schema)


def test_enrich_takes_first_listing_and_needs_a_page(spark):
    listing = _listing(spark, [(2, 0, "late", "/a"), (1, 5, "first", "/a"), (1, 1, "lost", "/b"), (1, 2, "none", None)])
    page = [("S/a", *[f"{c}!" for c in schemas.DETAIL_8])] * 2 + [("S/c", *[""] * 8)]
    detail = spark.createDataFrame(page, ["url", *schemas.DETAIL_8])
    rows = records.enrich_listing_with_detail(listing, detail, "S").collect()
    assert [(r.title, r.property_url, r.condition) for r in rows] == [("first", "/a", "condition!")]
    assert len(rows[0]) == 22
    lost = records.listing_without_detail(listing, detail, "S").collect()
    assert [(r.url, r.page_num, r.pos) for r in lost] == [("S/b", 1, 1)]


def test_enrich_joins_without_a_shuffle_of_its_own(spark):
    listing = _listing(spark, [(1, 0, "t", "/a")])
    detail = spark.createDataFrame([("S/a", *["x"] * 8)], ["url", *schemas.DETAIL_8])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = records.enrich_listing_with_detail(listing, detail, "S")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2


def test_retryable_codes(spark):
    df = spark.createDataFrame([(c,) for c in (200, 404, 408, 429, 500, 501, 502, 503, 504, 522, 524)], "status int")
    assert sorted(r.status for r in fetchlog.retryable_filter(df).collect()) == sorted(fetchlog.RETRY_CODES)


def test_written_table_round_trip(spark, tmp_path):
    odd = ['line\nbreak', 'quo"te', "com,ma", None, "", "  blanks  ", "back\\slash", "ümläut", 'a\r\nb', '"', "'", "#x"]
    rows = [tuple([v] + [str(n)] * 15) for n, v in enumerate(odd)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in schemas.DETAIL_16))
    path = str(tmp_path / "out")
    for _ in range(2):  # the second run replaces the first
        csv_table.sink_csv_overwrite(df, path, header={"time_on_site": "time_here"})
    text = spark.read.text(path).first()[0]
    assert text.split(",")[:2] == ["title", "location"] and "time_here" in text
    got = csv_table.read_csv_table(spark, path, ", ".join(f"{c} string" for c in schemas.DETAIL_16))
    want = [None if v == "" else v for v in odd]
    assert [r.title for r in sorted(got.collect(), key=lambda r: int(r.location))] == want
    head = csv_table.src_csv_head(spark, path, ["location"])
    assert [r.location for r in head.collect()] == [0, 1, 2, 3, 4]


def test_union_keeps_rows_and_merge_prefers_the_page(spark):
    strings = ", ".join(f"{c} string" for c in schemas.LISTING_16)
    listed = spark.createDataFrame(
        [(1, 0, *["L"] * 15, "/a"), (1, 1, *["late"] * 15, "/a"), (1, 2, *["only"] * 15, "/b"), (1, 3, *["x"] * 15, None)],
        "page_num int, pos int, " + strings)
    detail = spark.createDataFrame([(*["D"] * 3, None, *["D"] * 11, "/a"), (*["E"] * 15, "/c")],
                                   ", ".join(f"{c} string" for c in schemas.DETAIL_16))
    assert records.union_records(listed, detail).columns == schemas.DETAIL_16
    assert records.union_records(listed, detail).count() == 6
    merged = {r.property_url: r for r in records.merge_records(listed, detail).collect()}
    assert set(merged) == {"/a", "/b", "/c"}
    assert (merged["/a"].title, merged["/a"].property_address, merged["/b"].estate_name) == ("D", "L", "only")


def test_whole_flows(spark):
    payloads, pages = render.listing_payloads(spark, SF), render.detail_pages(spark, SF)
    rent = flows.rent_listing_flow(payloads, pages, render.SITE, render.STAT_PHRASE)
    assert rent.count() == rent.select("property_url").distinct().count() > 100
    # the first read of every page lacks its seller
    first = F.regexp_replace("html", "b-seller-block__name", "later")
    reads = pages.select("url", F.lit(1).alias("attempt"), first.alias("html")).unionByName(
        pages.select("url", F.lit(2).alias("attempt"), "html"))
    sale = flows.sale_listing_flow(payloads, reads, render.SITE)
    n_pages = pages.count()
    complete = sale.filter("property_url is not null and seller_or_agent_name is not null")
    assert sale.columns == schemas.DETAIL_16
    assert n_pages - 10 < complete.count() <= n_pages
    # a failed last read leaves the values of the one before, failed reads alone give no row
    url = pages.first().url
    page = pages.filter(F.col("url") == url)
    reads = page.select("url", F.lit(2).alias("attempt"), first.alias("html")).unionByName(
        page.select("url", F.lit(3).alias("attempt"), F.lit(None).cast("string").alias("html"))).unionByName(
        page.select(F.lit("lost").alias("url"), F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("html")))
    kept = flows.sale_listing_flow(payloads.limit(0), reads, render.SITE).collect()
    assert [(r.property_url, r.title is None, r.seller_or_agent_name) for r in kept] == [(url, False, None)]
    pages = render.account_pages(spark, SF)
    good, bad = details.account_record_7(pages), details.account_rejects(pages)
    assert good.count() + bad.count() == 200 == details.account_audit(pages).count()


def test_link_flow(spark):
    html = "".join(f'<h3 class="add-title"><a href="{h}">x</a></h3>' for h in
                   ("/a", "b", "https://other.example/c", "/a#x", "//sub.site.example/d")) + '<a href="/no">n</a>'
    stored = spark.createDataFrame([(1, "https://site.example/list/", html), (2, "https://site.example/x", html)],
                                   "page_id long, url string, html string")
    seen = spark.createDataFrame([("https://site.example/b#seen",)], "url string")
    rows = flows.link_flow(stored, seen, details.HEADING_ANCHOR, ["site.example"]).collect()
    assert {(r.url, r.first_page, r.n_links) for r in rows} == {
        ("https://site.example/a", 1, 4), ("https://site.example/list/b", 1, 1),
        ("https://sub.site.example/d", 1, 2)}
