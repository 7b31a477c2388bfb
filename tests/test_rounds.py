"""Orders of arrival, page limits, exact ranks, all forms of markup, streams of many batches."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanframe import schemas
from gleanframe.functions import html as H
from gleanframe.operators import fetchlog, pages, paging, records
from gleanframe.operators.skew import exact_rank
from gleanframe.plans import flows
from gleanframe.session import scratch_path
from gleanframe.streaming import jobs


@pytest.fixture(scope="module")
def log(spark):
    """30,000 failures; every third one is of URL 0, some of no URL."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 != 1, F.col("id") % 500 + 1).alias("url"),
        F.col("id").alias("event_id"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("ts"))


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_exact_rank_equals_a_window(log, buckets):
    place = F.row_number().over(Window.partitionBy("url").orderBy("ts", "event_id"))
    got, want = exact_rank(log, ["url"], ["ts", "event_id"], "n", buckets=buckets), log.withColumn("n", place.cast("bigint"))
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_exact_rank_goes_on_from_earlier_places(spark, log):
    start = spark.createDataFrame([(0, 5), (None, 100), (9999, 1)], "url long, before long")
    got = exact_rank(log, ["url"], ["ts", "event_id"], "n", start)
    least = {r.url: r.n for r in got.groupBy("url").agg(F.min("n").alias("n")).collect()}
    assert (least[0], least[None], least[2]) == (6, 101, 1)


def test_exact_rank_spreads_the_hot_key(spark, log):
    """No task of the ranking window holds all rows of the hot key."""
    shares = exact_rank(log, ["url"], ["ts", "event_id"], "n").filter("url = 0").groupBy(
        F.floor((F.col("n") - 1) / 500)).count()
    assert shares.count() == 20
    plan = exact_rank(log, ["url"], ["ts", "event_id"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(url" in plan and "_bucket" in plan.split("Window")[1]


def test_exact_rank_of_nothing(log):
    assert exact_rank(log.limit(0), ["url"], ["ts", "event_id"], "n").collect() == []


def test_the_first_page_to_arrive_counts(spark):
    listing = spark.createDataFrame([(1, 0, "/a"), (1, 1, "/b")], "page_num int, pos int, property_url string")
    for c in schemas.LISTING_14:
        if c not in listing.columns:
            listing = listing.withColumn(c, F.lit("x"))
    full = {c: F.lit("full") for c in schemas.DETAIL_8}
    detail = spark.createDataFrame([("s/a", 1), ("s/a", 2), ("s/b", 7), ("s/b", 3)], "url string, fetched int").withColumns({
        c: F.when(F.col("fetched") == F.when(F.col("url") == "s/a", 1).otherwise(3), v) for c, v in full.items()})
    rows = records.enrich_listing_with_detail(listing, detail, "s").collect()
    assert len(rows) == 2 and all(r[c] == "full" for r in rows for c in schemas.DETAIL_8)


FORMS = """<a href='/single'>one<b>two</b>three</a><a href=/bare>x</a><A HREF = "/blanks">it&#8217;s &eacute;</A>
<a name=top>no link</a><a title="a > b" href="/late?a=1&amp;b=2"> y </a><p class=k>p<i>q</i>r</p><p class="k">s</p>"""
PLAIN = '<a class="c" href="/x">one</a><a href="/y?a&amp;b">two &lt; &copy;</a><p class="k">s</p>'


def test_links_and_texts_in_all_forms_equal_the_walk(spark):
    stored = spark.createDataFrame([(1, "u", FORMS), (2, "u", PLAIN), (3, "u", None), (4, "u", ""),
                                    (5, "u", PLAIN.replace('"', "'")), (6, "u", PLAIN.upper()),
                                    (7, "u", "<a href=\"/z\">open")], "page_id int, url string, html string")
    anchor, para = ((H.Step("a"),),), ((H.Step("p", "k"),),)
    walked = {r.page_id: r for r in pages.walk_pages(
        stored, [H.Field("hrefs", "attr", anchor, "href"), H.Field("a", "texts", anchor), H.Field("p", "texts", para)],
        ("page_id",)).collect()}
    links = {}
    for r in pages.extract_links(stored).orderBy("page_id", "pos").collect():
        links.setdefault(r.page_id, []).append(r.href)
    assert links == {n: w.hrefs for n, w in walked.items() if w.hrefs}
    assert links[1] == ["/single", "/bare", "/blanks", "/late?a=1&b=2"]
    texts = {r.page_id: r.texts for r in pages.extract_all_texts(stored, "a").collect()}
    assert texts == {n: [x.strip() for x in w.a if x.strip()] for n, w in walked.items()}
    assert texts[1] == ["one", "three", "x", "it\u2019s \u00e9", "no link", "y"]
    first = {r.page_id: r.k for r in pages.extract_first_text(stored, {"k": ("p", "k")}).collect()}
    assert first == {n: (w.p[0].strip() if w.p else None) for n, w in walked.items()}


def test_plain_pages_are_not_walked(spark):
    stored = spark.createDataFrame([(1, "u", PLAIN)], "page_id int, url string, html string")
    plan = pages.extract_links(stored)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    assert [r.href for r in pages.extract_links(stored).collect()] == ["/x", "/y?a&b"]


def test_a_chain_ends_at_its_page_limit(spark):
    chain = [(n, n + 1, n, 4) for n in range(1, 8)] + [(n, n + 1, n - 99, 1000) for n in range(100, 230)]
    pointers = spark.createDataFrame(chain, "page int, next_page int, page_num int, total_pages int")
    seeds = spark.createDataFrame([(1,), (100,)], "page int")
    got = {r.page: r.depth for r in paging.next_pointer_closure(pointers, seeds).collect()}
    assert got == {**{n: n - 1 for n in range(1, 5)}, **{n: n - 100 for n in range(100, 231)}}
    assert paging.next_pointer_closure(pointers.drop("page_num"), seeds).count() == 8 + 131


def test_next_pages_follow_pages_with_links_only(spark):
    listing = spark.createDataFrame([
        (1, "http://a/x?page=1", "<h3 class=add-title><a href=/i/1>o</a></h3><h3 class=add-title><a href=/i/2>o</a></h3>"),
        (2, "http://a/x?page=2", "<a href=/about>none</a>")], "page_id int, url string, html string")
    requests, following = flows.account_requests(listing, (H.Step("h3", "add-title"), H.Step("a")))
    assert sorted(r.url for r in requests.collect()) == ["http://a/i/1", "http://a/i/2"]
    assert [r.url for r in following.collect()] == ["http://a/x?page=2"]


def batches(spark, log, folder, n, start):
    """The log in n batches, by time; ``start`` runs the stream to the end of what is there."""
    source = scratch_path(spark, "source")
    for number in range(n):
        log.filter(F.floor(F.unix_seconds("ts") * n / 1000) == number).coalesce(1).write.mode("append").parquet(source)
        start(jobs.read_parquet_stream(spark, source, log.schema), folder).awaitTermination()


def test_retry_state_over_many_batches(spark, log):
    log, folder = log.filter("event_id < 3000"), scratch_path(spark, "retry")
    assert log.filter("url is null").count() > 5
    batches(spark, log, folder, 9, jobs.stream_retry_state)
    want = fetchlog.retry_schedule(log)
    got = spark.read.parquet(f"{folder}/out").select(*want.columns)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_a_stream_passes_on_the_first_row_of_each_key(spark, log):
    log, folder = log.filter("event_id < 3000"), scratch_path(spark, "dedup")
    batches(spark, log, folder, 5, lambda s, f: jobs.stream_dedup(s, f, delay="1 hour"))
    got = {r.url: r.event_id for r in spark.read.parquet(f"{folder}/out").collect()}
    first = log.groupBy("url").agg(F.min(F.struct("ts", "event_id")).alias("first")).collect()
    assert got == {r.url: r["first"].event_id for r in first}
    assert spark.read.parquet(f"{folder}/out").count() == len(got)


def test_rows_behind_the_watermark_and_keys_that_return(spark):
    """Batches of (url, minute): the watermark stands ten minutes behind the newest row of those before."""
    folder, source = scratch_path(spark, "dedup"), scratch_path(spark, "source")
    landed = [[("a", 100), ("b", 100)], [("a", 105), ("late", 80), ("c", 95)], [("a", 130)], [("a", 131), ("b", 121)],
              [("late", 119), ("late", 125)]]
    for rows in landed:
        df = spark.createDataFrame(rows, "url string, minute long").coalesce(1).select(
            "url", F.timestamp_seconds(F.col("minute") * 60).alias("ts"), F.col("minute").alias("event_id"))
        df.write.mode("append").parquet(source)
        stream = jobs.read_parquet_stream(spark, source, df.schema)
        jobs.stream_dedup(stream, folder, delay="10 minutes").awaitTermination()
    got = sorted((r.url, r.event_id) for r in spark.read.parquet(f"{folder}/out").collect())
    # at 130 a is still known, since the watermark stands at 95; then it stands at 120, and a and b are forgotten
    assert got == [("a", 100), ("a", 131), ("b", 100), ("b", 121), ("c", 95), ("late", 125)]
