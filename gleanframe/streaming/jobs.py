"""Streaming forms of the jobs. Each takes a streaming DataFrame and writes below a folder; what
is running is the caller's ``StreamingQuery``.

Output and progress live in the folder, which all executors share, so a restarted query goes on
where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from gleanframe.operators import fetchlog
from gleanframe.session import reach_workers
from gleanframe.streaming import state


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files: int | None = None) -> DataFrame:
    """Newly landed files of a folder (or of a path pattern) as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _writer(stream: DataFrame, folder: str, trigger: dict | None = None):
    """``trigger`` as in ``DataStreamWriter.trigger``; without one, what is there is read and the query
    ends."""
    return stream.writeStream.option("checkpointLocation", f"{folder}/progress").trigger(
        **(trigger or {"availableNow": True}))


def stream_extract(rows: DataFrame, folder: str, trigger: dict | None = None) -> StreamingQuery:
    """Stateless: ``rows`` is any extraction job applied to a page stream."""
    return _writer(rows, folder, trigger).format("parquet").outputMode("append").start(f"{folder}/out")


def stream_dedup(log: DataFrame, folder: str, key: str = "url", ts: str = "ts", tie: str = "event_id",
                 delay: str = "1 day", trigger: dict | None = None) -> StreamingQuery:
    """The first row per key, by (ts, tie) within a batch and by arrival over batches; a key that
    returns later than ``delay`` behind the watermark is passed on again, and rows behind the
    watermark are left out. The watermark stands ``delay`` behind the newest row of the batches before.

    The state store holds a time per key until the watermark has passed it by ``delay``. The rows of a key in
    one batch go through one task, of which it keeps one; how many there are is up to the stream's source
    (``max_files``). Outputs are named by the batch, so a batch that runs again replaces its own.
    """
    reach_workers(log.sparkSession)
    delay_ms = _milliseconds(log.sparkSession, delay)
    # Spark's watermark starts at 1970, and a row at the watermark is late; so times are moved up, and it
    # stands a millisecond lower
    moved = F.unix_millis(ts) + state.EPOCH_MS
    first = log.withColumns({"_ms": moved, "_at": F.timestamp_millis(moved)}).withWatermark("_at", f"{delay_ms + 1} milliseconds").groupBy(
        key).applyInPandasWithState(
        state.first_of_key(log.columns, ts, tie, delay_ms), log.schema, "at long", "append",
        GroupStateTimeout.EventTimeTimeout)
    return _by_batch(first, folder, trigger)


def _milliseconds(spark: SparkSession, delay: str) -> int:
    at = F.timestamp_seconds(F.lit(0))
    return int(spark.range(1).select(F.unix_millis(at + F.expr(f"interval {delay}"))).first()[0])


def _by_batch(rows: DataFrame, folder: str, trigger: dict | None) -> StreamingQuery:
    """Write each batch to a table of its own below ``out``; one that runs again replaces it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    return _writer(rows, folder, trigger).outputMode("append").foreachBatch(write).start()


def stream_enrich(listing: DataFrame, detail: DataFrame, folder: str, wait: str = "1 day", delay: str = "1 day",
                  trigger: dict | None = None) -> StreamingQuery:
    """Listing records (``url``, ``listed_at``) and detail fields (``url``, ``fetched_at``) as they arrive, in any
    order, joined where the page came within ``wait`` of the listing.

    Both sides wait in the state store: a page until no listing older than the watermark can ask for it, a
    listing until its page can no longer come; then it passes with ``arrived`` false. Rows that come later than
    ``delay`` behind the newest of their side are left out. ``out`` holds a row per listing row and page: a URL
    that was listed twice, or whose page came twice, has several (see enriched).
    """
    left = listing.withWatermark("listed_at", delay)
    right = detail.withColumnRenamed("url", "_url").withWatermark("fetched_at", delay)
    joined = left.join(right, (F.col("url") == F.col("_url")) & F.expr(
        f"fetched_at >= listed_at and fetched_at <= listed_at + interval {wait}"), "left_outer")
    rows = joined.withColumn("arrived", F.col("_url").isNotNull()).drop("_url")
    return _writer(rows, folder, trigger).format("parquet").outputMode("append").start(f"{folder}/out")


def enriched(spark: SparkSession, folder: str, columns: list[str], order: tuple[str, ...]) -> DataFrame:
    """What stream_enrich has joined so far: one record per URL, of its first listing and page by ``order``."""
    rows = spark.read.parquet(f"{folder}/out").filter("arrived")
    first = rows.groupBy("url").agg(F.min(F.struct(*order, *[c for c in columns if c not in order])).alias("_first"))
    return first.select(*[F.col("_first")[c].alias(c) for c in columns])


def stream_status_counts(log: DataFrame, folder: str, status: str = "status",
                         trigger: dict | None = None) -> StreamingQuery:
    """Running counts per status; after each batch ``out`` holds the present totals (a handful of
    rows)."""
    totals = fetchlog.status_histogram(log, status)

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    return _writer(totals, folder, trigger).outputMode("complete").foreachBatch(replace).start()


def stream_retry_state(failures: DataFrame, folder: str, max_retries: int = fetchlog.MAX_RETRIES,
                       trigger: dict | None = None) -> StreamingQuery:
    """Retry schedule over a stream of failures (url, ts, event_id), with one counter per URL in the state
    store.

    The failures of a URL in one batch are numbered in one task, from where the batch before ended; how many come
    in one batch is up to the stream's source (``max_files``). Counters are kept for good, as a URL may fail
    again at any time. Outputs are named by the batch, so a batch that runs again replaces its own.
    """
    reach_workers(failures.sparkSession)
    order = ["ts", "event_id"]
    rows = failures.select("url", *order)
    schema = T.StructType([*rows.schema.fields, T.StructField("attempt", T.LongType())])
    numbered = rows.groupBy("url").applyInPandasWithState(
        state.numbered_failures("url", order), schema, "failed long", "append", GroupStateTimeout.NoTimeout)
    return _by_batch(fetchlog.scheduled(numbered, max_retries), folder, trigger)
