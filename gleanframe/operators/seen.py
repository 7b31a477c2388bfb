"""The URLs that were requested already, as a stored table that grows by appending.

The table is bucketed by URL, so new links are dealt to its buckets and the stored side is read where it lies:
what an increment shuffles grows with the new links, not with those seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SeenStore:
    """Seen keys in the catalog table ``name`` below ``path``; ``buckets`` is fixed when it is made, and should be
    some hundred for a store that grows large: a bucket is what one task reads."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int = 64, key: str = "url",
                 kind: T.DataType = T.StringType()):
        self._spark, self.name, self._path, self.key = spark, name, path, key
        self._schema = T.StructType([T.StructField(key, kind)])
        self.buckets = buckets
        if spark.catalog.tableExists(name):
            number = spark.sql(f"describe extended {name}").filter("col_name = 'Num Buckets'").first()
            self.buckets = int(number["data_type"])
        else:
            self._write(spark.createDataFrame([], self._schema), "error")

    def _write(self, keys: DataFrame, mode: str, path: str | None = None) -> None:
        writer = keys.write.mode(mode).format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        if path or self._path:
            writer = writer.option("path", path or self._path)
        writer.saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self._spark.table(self.name)

    def unseen(self, links: DataFrame, source: str = "page_id") -> DataFrame:
        """Links that are not in the store, each once, with the first page that shows it and how often it
        stands there. A null link is one like any other, and is never stored.

        Links that stand on many pages are combined in every task before they are dealt to the buckets.
        """
        found = links.groupBy(self.key).agg(F.min(source).alias("first_page"), F.count("*").alias("n_links"))
        dealt = found.repartition(self.buckets, self.key)
        return dealt.hint("merge").join(self.rows().hint("merge"), self.key, "left_anti")

    def add(self, links: DataFrame) -> None:
        """Append the keys of the links that are not there yet."""
        keys = links.select(F.col(self.key).cast(self._schema[0].dataType)).filter(F.col(self.key).isNotNull())
        new = keys.distinct().repartition(self.buckets, self.key).hint("merge").join(
            self.rows().hint("merge"), self.key, "left_anti")
        self._write(new, "append")
        self._spark.catalog.refreshTable(self.name)

    def files(self) -> int:
        """Files of the table: an append adds one per bucket at most."""
        return len(self.rows().inputFiles())

    def drop(self) -> None:
        """Take the table out of the catalog, and its files with it."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(
            self._spark.sql(f"describe extended {self.name}").filter("col_name = 'Location'").first()["data_type"])
        self._spark.sql(f"drop table {self.name}")
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
