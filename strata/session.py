"""Session settings and the shared work location.

The library never creates its own session; callers hand one in.  ``configure``
pins the settings every layer relies on:

* session time zone UTC -- all stored timestamps are UTC instants;
* JSON expression optimization off -- with it on, Catalyst inlines one
  ``from_json`` per referenced field and prunes each copy to its own schema,
  so the envelope text is parsed once per validation rule instead of once;
* adaptive execution on, so shuffle partition counts and join strategies are
  re-planned from runtime sizes;
* small pieces: envelope texts are long and alike, so a megabyte of files or of
  shuffle holds many times that in rows, and a task sorts whole pieces.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.optimizer.enableJsonExpressionOptimization": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
}
#: Rows of a staged file.  With the size of a scan's pieces and Spark's cost of
#: opening a file (4 MB) it bounds the rows that one task of a scan gets.
ROWS_PER_FILE = 50_000
#: Pieces that a shuffle is cut in before adaptive execution puts small ones together.
PIECES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the pipeline depends on (idempotent)."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only when nothing is set (tests, a bare local
    session) is a folder chosen: a subfolder of the SQL warehouse, which on a
    cluster is shared storage, never a machine-local temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        configured = warehouse.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    # setCheckpointDir appends a per-application folder; report that one.
    return (sc.getCheckpointDir() or configured).rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the checkpoint location for one run's tables."""
    return f"{checkpoint_dir(spark)}/runs/{label}-{uuid.uuid4().hex[:12]}"


def staged(spark: SparkSession, df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to ``folder`` and read again in pieces of bounded size,
    however few tasks make it."""
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def in_pieces(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles of ``rows`` rows that run inside are cut in at least a piece per
    ``ROWS_PER_FILE`` rows, however few shuffle partitions the session asks for:
    windows, joins and aggregates sort or hash whole pieces.  Adaptive execution
    joins small pieces up to its advisory size, so a short batch gets few."""
    usual = spark.conf.get(PIECES, None)
    least = int(usual or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(PIECES, str(max(least, -(-rows // ROWS_PER_FILE))))
    try:
        yield
    finally:
        if usual is None:
            spark.conf.unset(PIECES)
        else:
            spark.conf.set(PIECES, usual)


def folder_has(spark: SparkSession, folder: str, name: str) -> bool:
    """Whether ``folder`` holds ``name``, asked of the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly under ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return [f.getPath().getName() for f in found if f.isDirectory()]


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a run's folder through the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
