"""Streams that take several batches and a restart."""

import os

import pytest
from pyspark.sql import functions as F

from fixtures import render
from gleanframe.operators import details, fetchlog, listing
from gleanframe.session import scratch_path
from gleanframe.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def log(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("user_id").alias("url"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.col("event_type").alias("status"))


def land(log, folder, number):
    """Write one third of the log, by time, as one file."""
    bounds = [F.timestamp_seconds(F.lit(s)) for s in (0, 1704844800, 1705708800, 4000000000)]
    part = log.filter((F.col("ts") >= bounds[number]) & (F.col("ts") < bounds[number + 1]))
    assert part.count() > 100
    part.coalesce(1).write.mode("append").parquet(folder)


def test_retry_state_equals_batch_over_restarts(spark, log):
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "retry")
    failures = log.filter("status = 'error'").select("url", "ts", "event_id")
    for number in range(3):
        land(log, source, number)
        stream = jobs.read_parquet_stream(spark, source, log.schema).filter("status = 'error'")
        jobs.stream_retry_state(stream.select("url", "ts", "event_id"), folder).awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    assert got.select("batch").distinct().count() == 3
    want = fetchlog.retry_schedule(failures)
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_status_counts_run_on(spark, log):
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "status")
    for number in range(2):
        land(log, source, number)
        stream = jobs.read_parquet_stream(spark, source, log.schema)
        jobs.stream_status_counts(stream, folder).awaitTermination()
        want = fetchlog.status_histogram(spark.read.parquet(source))
        got = spark.read.parquet(f"{folder}/out").select(*want.columns)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_dedup_passes_each_url_once_over_batches(spark, log):
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "dedup")
    for number in range(3):
        land(log, source, number)
        stream = jobs.read_parquet_stream(spark, source, log.schema)
        jobs.stream_dedup(stream, folder, delay="60 days").awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == got.select("url").distinct().count() == log.select("url").distinct().count()


def test_dedup_forgets_a_url_behind_the_watermark(spark, log):
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "dedup")
    for number in range(3):
        land(log, source, number)
        stream = jobs.read_parquet_stream(spark, source, log.schema)
        jobs.stream_dedup(stream, folder, delay="1 hour").awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    assert got.select("url").distinct().count() == log.select("url").distinct().count() < got.count()


def test_a_batch_that_runs_again_replaces_its_output(spark, log):
    """A run that is lost after its output was written, before it was noted, is done again from the state before."""
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "retry")
    for number in range(2):
        land(log, source, number)
        stream = jobs.read_parquet_stream(spark, source, log.schema).filter("status = 'error'")
        jobs.stream_retry_state(stream.select("url", "ts", "event_id"), folder).awaitTermination()
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/progress/commits/{name}")
    stream = jobs.read_parquet_stream(spark, source, log.schema).filter("status = 'error'")
    jobs.stream_retry_state(stream.select("url", "ts", "event_id"), folder).awaitTermination()
    want = fetchlog.retry_schedule(spark.read.parquet(source).filter("status = 'error'").select("url", "ts", "event_id"))
    got = spark.read.parquet(f"{folder}/out").select(*want.columns)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_page_walk_runs_on_a_stream(spark):
    pages = render.detail_pages(spark, SF)
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "records")
    pages.write.parquet(source)
    stream = jobs.read_parquet_stream(spark, source, pages.schema, max_files=2)
    jobs.stream_extract(details.detail_record_16(stream), folder).awaitTermination()
    got, want = spark.read.parquet(f"{folder}/out"), details.detail_record_16(pages)
    assert got.count() > 100
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_listing_records_on_a_stream(spark):
    payloads = render.listing_payloads(spark, SF)
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "listing")
    payloads.write.parquet(source)

    def records(rows):
        return listing.listing_record_14(listing.listing_explode(listing.parse_listing(rows)))

    stream = jobs.read_parquet_stream(spark, source, payloads.schema)
    jobs.stream_extract(records(stream), folder).awaitTermination()
    got, want = spark.read.parquet(f"{folder}/out"), records(payloads)
    assert got.count() > 100
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
