"""The written table: CSV, UTF-8, header, fixed column order."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe import schemas

_QUOTING = {"header": "true", "escape": '"', "lineSep": "\n", "encoding": "UTF-8"}


def sink_csv_overwrite(records: DataFrame, path: str, columns: Iterable[str] = schemas.DETAIL_16,
                       header: dict[str, str] | None = None, rows_per_file: int = 200_000) -> None:
    """Replace the output in one step. ``header`` renames columns on the way out. Null and '' are both written
    as nothing; blanks at the ends of a value are kept. Values may hold line ends, so a file is read
    back by one task; no file gets more than ``rows_per_file`` rows.

    The new table is written beside the old one and takes its place only when the write has come to its
    end, so a run that fails leaves the old rows; ``records`` may be read from the old table. A run that is
    lost between the two renames leaves the old table beside, from where reading or writing brings it
    back (Replacing)."""
    names = header or {}
    chosen = records.select(*[F.col(c).alias(names.get(c, c)) for c in columns])
    table = Replacing(records.sparkSession, path)
    table.recover()
    (chosen.write.options(**_QUOTING).option("maxRecordsPerFile", rows_per_file)
     .option("emptyValue", "").option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(table.new))
    table.swap()


class Replacing:
    """A folder whose content is replaced by renames: ``new`` is written first, then the old folder steps aside
    and the new one takes its name. Names that begin with an underscore or a dot are no data to Spark, so
    what a lost run leaves behind is in nobody's way; the next run deletes it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._system = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._parent, name = self._path.getParent(), self._path.getName()
        self._make = lambda child: spark._jvm.org.apache.hadoop.fs.Path(self._parent, child)
        self._new_prefix = f"._new-{name}-"
        self._old = self._make(f"._old-{name}")
        self._new = self._make(f"{self._new_prefix}{uuid.uuid4().hex}")
        self.new = self._new.toString()

    def recover(self) -> None:
        """The old table back in its place, if a run was lost while it stood aside."""
        if not self._system.exists(self._path) and self._system.exists(self._old):
            self._rename(self._old, self._path)

    def swap(self) -> None:
        """The new table in place of the old one, if its write came to its end."""
        if not self._system.exists(self._make(f"{self._new.getName()}/_SUCCESS")):
            raise FileNotFoundError(f"{self.new} was not written to its end")
        if self._system.exists(self._path):
            self._system.delete(self._old, True)
            self._rename(self._path, self._old)
        self._rename(self._new, self._path)
        self._system.delete(self._old, True)
        for left in self._system.listStatus(self._parent):
            if left.getPath().getName().startswith(self._new_prefix):
                self._system.delete(left.getPath(), True)

    def _rename(self, old, new) -> None:
        if not self._system.rename(old, new):
            raise OSError(f"{old.toString()} could not be renamed to {new.toString()}")


def read_csv_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read the table back; values may hold line ends. Types are inferred when no schema is
    given, which takes one more pass over the files."""
    Replacing(spark, path).recover()
    reader = spark.read.options(**_QUOTING).option("multiLine", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def src_csv_head(spark: SparkSession, path: str, order: Iterable[str], n: int = 5,
                 schema=None) -> DataFrame:
    """The first n rows. A distributed table has no file order, so the order is named."""
    return read_csv_table(spark, path, schema).orderBy(*order).limit(n)
