"""Readers for stored responses and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def src_listing_payloads(source: DataFrame, page_num: str = "page_num",
                         body: str = "body") -> DataFrame:
    """Raw listing responses, one row each, from a table."""
    return source.select(F.col(page_num).cast("bigint").alias("page_num"), F.col(body).alias("body"))


def src_listing_files(spark: SparkSession, path: str, name_pattern: str = r"(\d+)\.[^.]*$") -> DataFrame:
    """Raw listing responses from a folder with one file per response; the page number is read
    from the end of the file's path."""
    files = spark.read.text(path, wholetext=True)
    number = F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1).try_cast("bigint")
    return files.select(number.alias("page_num"), F.col("value").alias("body"))


def src_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages: page_id, url, html. The columnar file gives html only to jobs that use it."""
    return spark.read.parquet(path).select("page_id", "url", "html")
