"""Jobs on tables in which one key holds a third of all rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanframe.operators import fetchlog, frontier, records
from gleanframe.operators.skew import capped_rank, join_hot


@pytest.fixture(scope="module")
def log(spark):
    """30,000 attempts; every third one belongs to URL 0."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1).alias("url"),
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("ts"))


@pytest.mark.parametrize("salts", [1, 7, None])
def test_capped_rank_is_exact_and_keeps_all_rows(log, salts):
    got = capped_rank(log, ["url"], ["ts", "event_id"], 5, "n", salts)
    place = F.row_number().over(Window.partitionBy("url").orderBy("ts", "event_id"))
    want = log.withColumn("n", F.least(place, F.lit(6)).cast("bigint"))
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_capped_rank_spreads_the_hot_key(log):
    plan = capped_rank(log, ["url"], ["ts", "event_id"], 5, "n", 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(url") == 2
    assert plan.count("_salt") > 2


def test_retry_schedule_modes(spark):
    df = spark.range(1, 9).select(F.lit("u").alias("url"), F.timestamp_seconds("id").alias("ts"),
                                  F.col("id").alias("event_id"))
    rows = fetchlog.retry_schedule(df).orderBy("event_id").collect()
    assert [(r.attempt, r.delay, r.priority, r.gave_up) for r in rows] == [
        (1, 1, -1, False), (2, 2, -3, False), (3, 4, -6, False), (4, 8, -10, False), (5, 16, -15, False),
        (6, None, None, True), (7, None, None, True), (8, None, None, True)]
    with_priority = df.withColumn("p0", F.lit(10) * F.col("event_id"))
    rows = fetchlog.retry_schedule_exception(with_priority, priority=F.col("p0")).orderBy("event_id").collect()
    assert [r.priority for r in rows] == [9, 18, 27, 36, 45, None, None, None]
    rows = fetchlog.retry_schedule(df, max_retries=7, cap=30).orderBy("event_id").collect()
    assert [r.delay for r in rows] == [1, 2, 4, 8, 16, 30, 30, None]


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_join_hot_equals_a_plain_join(spark, log, how):
    left = log.unionByName(spark.createDataFrame([(None, -1, None)], log.schema))
    right = spark.range(0, 4000, 2).select(F.col("id").alias("url"), (F.col("id") * 10).alias("x"))
    got, want = join_hot(left, right, "url", how), left.join(right, "url", how).select(
        *join_hot(left, right, "url", how).columns)
    assert got.count() > 10_000
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_join_hot_broadcasts_hot_keys_only(log, spark):
    right = spark.range(100).select(F.col("id").alias("url"), F.lit(1).alias("x"))
    hot = log.groupBy("url").count().filter(F.col("count") * 1000 > log.count())
    assert [r.url for r in hot.collect()] == [0]
    assert join_hot(log, right, "url").filter("url = 0").count() == 10_000


def test_duplicates_of_a_hot_url(spark):
    rows = spark.range(9000).select(
        (F.col("id") % 90).alias("page_num"), F.floor(F.col("id") / 90).alias("pos"),
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot")
        .otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("property_url"))
    first = records.dedup_keep_first(rows)
    kept = {r.property_url: (r.page_num, r.pos) for r in first.collect()}
    assert len(kept) == 3002
    assert kept[None] == (0, 0) and kept["hot"] == (1, 0)
    dropped = records.dedup_dropped_report(rows)
    assert dropped.count() == 9000 - 3002
    assert dropped.filter("copies <> 1").count() == 0
    assert first.unionByName(dropped.drop("copies")).exceptAll(rows).count() == 0


def test_many_copies_of_one_record(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("page_num"), F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 1000)).alias("property_url"),
        F.lit("t").alias("title"))
    first, dropped = records.dedup_keep_first(rows), records.dedup_dropped_report(rows)
    assert first.count() == rows.select("property_url").distinct().count()
    assert [tuple(r) for r in dropped.filter("property_url = 'hot'").collect()] == [(1, 0, "hot", "t", 1999)]
    assert dropped.agg(F.sum("copies")).first()[0] == 6000 - first.count()


def test_different_records_at_the_same_place(spark):
    rows = spark.createDataFrame([(1, 0, "/a", "x"), (1, 0, "/a", "b"), (1, 0, "/a", "b"), (1, 0, "/a", None)],
                                 "page_num int, pos int, property_url string, title string")
    assert [r.title for r in records.dedup_keep_first(rows).collect()] == [None]
    assert {(r.title, r.copies) for r in records.dedup_dropped_report(rows).collect()} == {("x", 1), ("b", 2)}


def test_frontier_with_a_link_on_every_page(spark):
    links = spark.range(6000).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, "home").otherwise(F.col("id").cast("string")).alias("url"))
    seen = links.filter("page_id % 3 = 1").select("url").unionByName(links.filter("url = '4'").select("url"))
    rows = frontier.frontier_unseen(links, seen).collect()
    assert len(rows) == 2001
    assert {(r.first_page, r.n_links) for r in rows if r.url == "home"} == {(0, 2000)}


def test_failure_report_has_one_row_per_url(spark, log):
    failures = log.withColumn("kind", F.lit("timeout"))
    rows = fetchlog.failure_report(failures)
    assert rows.filter("url = 0").first().failures == 10_000
    total = fetchlog.failure_totals(failures).first()
    assert (total.failures, total.urls) == (30_000, rows.count())


def test_retries_due_are_the_schedule_without_what_was_given_up(spark):
    from gleanframe.operators import fetchlog
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).alias("url"), F.col("id").alias("event_id"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(100))).alias("ts"))
    want = fetchlog.retry_schedule(rows).filter("not gave_up")
    got = fetchlog.retries_due(rows).select(want.columns)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
