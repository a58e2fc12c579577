"""Helpers shared by the operators: staging, vector checks, batch slicing."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handled at once inside a task; bounds the Python side of a batch.
SLICE_ROWS = 512


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once per application.

    Python workers import the operators' modules; a cluster whose machines do
    not have the package installed gets it this way.
    """
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(context, "_llm_shipped", False) or not os.path.isdir(root):
        return
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".py"))
    digest = hashlib.sha256(b"".join(open(f, "rb").read() for f in files)).hexdigest()[:16]
    path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(root)}-{digest}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for f in files:
            out.write(f, os.path.relpath(f, os.path.dirname(root)))
    context.addPyFile(path)
    context._llm_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, shared by driver and executors.

    Read from the session.  Only where it is unset, as in tests, a folder
    below the warehouse is used.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        where = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return where.rstrip("/")


#: Lets the session drop a finished write's shuffle files at once.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of any executor.  What
    the write shuffled is not needed after it, so its files go when it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete staged tables that nothing will read again."""
    for table in tables:
        if (path := getattr(table, "_staged_path", None)) is not None:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Return memory that earlier tasks of this worker freed to the machine.

    Workers are used again from stage to stage, and what the allocators keep
    of one stage counts beside what the next one needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others give back by themselves
    if trim is not None:
        trim(0)


def text_batches(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def bytes_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column end to end, and where each text begins and the last one ends."""
    column = texts.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[cuts[0] : cuts[-1]], cuts - cuts[0]


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some stretches end to end, and where each begins and the last one ends."""
    cuts = np.append(0, np.cumsum(size))
    return data[np.repeat(start - cuts[:-1], size) + np.arange(cuts[-1])], cuts


def usable_vector(vector: Column, allow_zero: bool = True) -> Column:
    """True where a vector is not null and all its components are finite numbers."""
    value = vector.cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    ok = vector.isNotNull() & ~F.coalesce(bad, F.lit(True))
    if not allow_zero:
        ok = ok & F.coalesce(F.exists(value, lambda x: x != 0.0), F.lit(False))
    return ok


def parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
