"""Fetch logs: status counts, failures, retry schedules.

A fetch log has one row per attempt: url, ts, event_id (tells the attempts of a URL apart), status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.operators.skew import capped_rank, exact_rank

# Retried status codes (fixed values).
RETRY_CODES = [429, 500, 502, 503, 504, 408, 522, 524]
# Retries before a request is dropped, and the longest delay (fixed values).
MAX_RETRIES = 5
DELAY_CAP_SECONDS = 30


def retryable_filter(log: DataFrame, codes: list[int] = RETRY_CODES,
                     status: str = "status") -> DataFrame:
    """Attempts whose status calls for a retry."""
    return log.filter(F.col(status).isin(codes))


def status_histogram(log: DataFrame, status: str = "status") -> DataFrame:
    """Responses per status."""
    return log.groupBy(status).agg(F.count("*").alias("responses"))


def failure_report(failures: DataFrame, kind: str = "kind", url: str = "url") -> DataFrame:
    """Failed URLs by kind of error, one row each with its number of failures. The URLs of a kind
    are rows, not a list, so that a frequent kind does not end up in one task."""
    return failures.groupBy(kind, url).agg(
        F.count("*").alias("failures"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def failure_totals(failures: DataFrame, kind: str = "kind", url: str = "url") -> DataFrame:
    """Failures and failed URLs per kind, counted in two steps instead of a distinct count."""
    per_url = failures.groupBy(kind, url).agg(F.count("*").alias("_n"))
    return per_url.groupBy(kind).agg(
        F.sum("_n").alias("failures"), F.count(url).alias("urls"))


def _schedule(attempt: Column, priority: Column, max_retries: int, cap: int,
              mode: str) -> dict[str, Column]:
    n = attempt
    retry = n <= max_retries
    power = F.pow(F.lit(2.0), n - 1)
    # a retried response lowers the priority by one more each time, since each copy of the request
    # keeps the former adjustment; a retried exception lowers it by one
    lowered = {"response": n * (n + 1) / 2, "exception": n}[mode]
    return {
        "delay": F.when(retry, F.least(power, F.lit(float(cap))).cast("bigint")),
        "priority": F.when(retry, (priority - lowered).cast("bigint")),
        "gave_up": ~retry,
    }


def retry_schedule(failures: DataFrame, key: str = "url", order: tuple[str, ...] = ("ts", "event_id"),
                   max_retries: int = MAX_RETRIES, cap: int = DELAY_CAP_SECONDS,
                   mode: str = "response", priority: Column | None = None) -> DataFrame:
    """For the n-th failed attempt of a URL the delay before the next one and its priority, or
    the mark that it was given up. ``priority`` is that of the request before any failure, an
    expression on the failures' columns.

    A URL with very many failures is spread over the tasks (exact_rank).
    """
    base = F.lit(0) if priority is None else priority
    rows = failures.select(key, *order, base.alias("_base"))
    ranked = exact_rank(rows, [key], list(order), "attempt")
    return ranked.withColumns(
        _schedule(F.col("attempt"), F.col("_base"), max_retries, cap, mode)).drop("_base")


def retries_due(failures: DataFrame, key: str = "url", order: tuple[str, ...] = ("ts", "event_id"),
                max_retries: int = MAX_RETRIES, cap: int = DELAY_CAP_SECONDS, mode: str = "response",
                priority: Column | None = None) -> DataFrame:
    """The rows of retry_schedule that are not given up. Only the first ``max_retries`` failures of a URL are
    ranked: each task keeps no more of one, and the log is read once."""
    base = F.lit(0) if priority is None else priority
    rows = failures.select(key, *order, base.alias("_base"))
    first = capped_rank(rows, [key], list(order), max_retries, "attempt").filter(F.col("attempt") <= max_retries)
    return first.withColumns(_schedule(F.col("attempt"), F.col("_base"), max_retries, cap, mode)).drop("_base")


def retry_schedule_exception(failures: DataFrame, **options) -> DataFrame:
    """The schedule after an exception in a page callback."""
    return retry_schedule(failures, mode="exception", **options)


def scheduled(numbered: DataFrame, max_retries: int = MAX_RETRIES, cap: int = DELAY_CAP_SECONDS) -> DataFrame:
    """The same schedule where the failures have their numbers already (``attempt``)."""
    return numbered.withColumns(_schedule(F.col("attempt"), F.lit(0), max_retries, cap, "response"))
