"""Tables that operators store between their steps, and ids that may be null."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gleanframe.session import reach_workers, scratch_path

# Stands for a null id inside the operators; it sorts behind all others.
NO_ID = 2**63 - 1


# While a table is stored, texts are handed over in small batches, and the shuffle files of the job
# are deleted at its end: what it made is in the table.
_WHILE_STORING = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def storing(spark: SparkSession) -> Iterator[None]:
    """The session with those settings; its own come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in _WHILE_STORING}
    for key, value in _WHILE_STORING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: plans start afresh from there, and a
    lost executor costs no more than the tasks that read from it."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    with storing(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(spark: SparkSession, rows: DataFrame) -> None:
    """Delete a stored table that no later plan reads."""
    for file in rows.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_column(name: str) -> Column:
    """A whole-number id, NO_ID for null."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID))


def shown_id(column: Column | str) -> Column:
    """The id again, null for NO_ID."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != NO_ID, column)


def id_and_text(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just the two columns as ``id`` and ``text``; a null text is empty."""
    reach_workers(rows.sparkSession)
    return rows.select(id_column(id_col).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def with_fields(rows: DataFrame, *added: StructField) -> tuple[list[str], StructType]:
    """Names of the columns that are kept beside new ones, and the schema of both; a column that has
    the name of a new one is replaced."""
    reach_workers(rows.sparkSession)
    names = {f.name for f in added}
    kept = [f for f in rows.schema.fields if f.name not in names]
    return [f.name for f in kept], StructType([*kept, *added])


def quoted(names: list[str]) -> list[Column]:
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]
