"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "gleanframe", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for. A cluster's own settings win where
    nothing is passed here."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # stored pages are large rows: read and hand over few of them at a time
        .config("spark.sql.parquet.columnarReaderBatchSize", "512")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package: by its own folder where they run on this machine, else as
    an archive that goes to every executor."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in paths:
        return
    sc.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    if not sc.master.startswith("local") and not root.endswith((".zip", ".egg")):
        # the driver serves the archive as long as the session lasts
        folder = tempfile.mkdtemp(prefix="gleanframe-")
        sc.addPyFile(shutil.make_archive(f"{folder}/gleanframe", "zip", root, "gleanframe"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gleanframe-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/gleanframe/{label}-{uuid.uuid4().hex}"


class Stored:
    """Rows written to the shared folder and read back, so that their plan starts afresh."""

    def __init__(self, rows: DataFrame, label: str):
        self._spark, self._label = rows.sparkSession, label
        self.path = scratch_path(self._spark, label)
        rows.write.parquet(self.path)
        self.rows = self._spark.read.schema(rows.schema).parquet(self.path)

    def replaced(self, rows: DataFrame) -> Stored:
        """New rows, made from these, in their place."""
        new = Stored(rows, self._label)
        self.delete()
        return new

    def delete(self) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
