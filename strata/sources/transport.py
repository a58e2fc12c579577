"""Reading the transport topic.

With the Kafka connector on the classpath, ``fmt="kafka"`` reads the topic
itself and offsets go to the connector.  Without it (as here) the topic is a
Kafka-shaped table -- topic, partition, offset, timestamp, value -- in any
file format, and offset bounds become filters that reach the scan.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas
from strata.session import folder_has


def _offset_filter(offsets, bound: str):
    """'earliest' as start and 'latest' as end -> no filter; a dict or JSON
    text ``{"topic": {"partition": offset}}`` -> per-partition bound.
    Starting offsets are inclusive, ending offsets exclusive (Kafka
    semantics); partitions not named are unbounded.  A stored topic has no
    end that moves, so starting at 'latest' or ending at 'earliest' raises."""
    if offsets is None or offsets == {"start": "earliest", "end": "latest"}[bound]:
        return None
    if offsets in ("earliest", "latest"):
        raise ValueError(f"a stored topic cannot {bound} at {offsets!r}")
    spec = json.loads(offsets) if isinstance(offsets, str) else offsets
    terms = []
    for topic, parts in spec.items():
        for part, off in parts.items():
            if int(off) == (-2 if bound == "start" else -1):  # earliest, latest: no bound
                continue
            if int(off) < 0:
                raise ValueError(f"a stored topic cannot {bound} at {off}")
            same = (F.col("topic") == topic) & (F.col("partition") == int(part))
            cmp = F.col("offset") >= int(off) if bound == "start" else F.col("offset") < int(off)
            terms.append(~same | cmp)
    if not terms:
        return None
    pred = terms[0]
    for t in terms[1:]:
        pred = pred & t
    return pred


def read_topic(
    spark: SparkSession,
    topic: str,
    fmt: str = "parquet",
    path: str | None = None,
    starting_offsets="earliest",
    ending_offsets="latest",
    options: dict[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Batch read of a topic between offsets (default earliest -> latest)."""
    if fmt == "kafka":
        reader = spark.read.format("kafka").option("subscribe", topic)
        reader = reader.option("startingOffsets", _as_json(starting_offsets))
        reader = reader.option("endingOffsets", _as_json(ending_offsets))
        return reader.options(**(options or {})).load()
    df = spark.read.format(fmt).schema(schema or schemas.TRANSPORT).options(**(options or {})).load(path)
    df = df.filter(F.col("topic") == topic)
    for offsets, bound in ((starting_offsets, "start"), (ending_offsets, "end")):
        pred = _offset_filter(offsets, bound)
        if pred is not None:
            df = df.filter(pred)
    return df


def read_topic_stream(
    spark: SparkSession,
    topic_pattern: str,
    fmt: str = "parquet",
    path: str | None = None,
    starting_offsets: str | None = None,
    options: dict[str, str] | None = None,
    schema: StructType | None = None,
    start_folder: str | None = None,
) -> DataFrame:
    """Streaming read.  Kafka: ``subscribePattern`` from the given
    offsets (default latest); progress lives in the query checkpoint (the
    consumer group's committed offsets in the row-at-a-time consumer).

    Files: a file stream with an explicit schema, by default from the earliest
    record on.  From 'latest', or from offsets that hold -1 (latest), the start
    is decided once and kept in ``start_folder``, beside the checkpoint: a
    restart goes on from the checkpoint with the same start.  Records before
    the start are filtered in the scan; a partition that was not there yet is
    read from its first record.  Read limits are the file source's options
    (``maxFilesPerTrigger``, ``maxBytesPerTrigger``).  The pattern must match
    the whole topic name, as the connector's does."""
    if fmt == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("subscribePattern", topic_pattern)
            .option("startingOffsets", starting_offsets or "latest")
            .options(**(options or {}))
            .load()
        )
    matches = F.col("topic").rlike(rf"\A(?:{topic_pattern})\z")
    schema = schema or schemas.TRANSPORT
    df = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(path).filter(matches)
    if starting_offsets in (None, "earliest"):
        return df
    if _names_latest(starting_offsets):
        if start_folder is None:
            raise ValueError("a stream from the latest offsets needs a folder to keep its start in")
        stored = spark.read.format(fmt).schema(schema).load(path).filter(matches)
        starting_offsets = decided_start(stored, starting_offsets, start_folder)
    pred = _offset_filter(starting_offsets, "start")
    return df if pred is None else df.filter(pred)


def _names_latest(offsets) -> bool:
    if offsets == "latest":
        return True
    spec = json.loads(offsets) if isinstance(offsets, str) else offsets
    return any(int(off) == -1 for parts in spec.values() for off in parts.values())


def stored_ends(records: DataFrame) -> DataFrame:
    """The next offset of every topic-partition that has records: what
    'latest' means for a stored topic.  Reads the three key columns only."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def decided_start(records: DataFrame, starting_offsets, folder: str) -> dict[str, dict[str, int]]:
    """The offsets a stream begins at, ``{topic: {partition: offset}}``.

    The first call finds where the stored ``records`` end and writes it to
    ``folder``; every later call reads the folder, so a stream that starts
    again does not skip what came while it was down.  A start whose writing was
    cut short is decided anew: no record was read with it.  In given offsets
    -1 stands for a partition's end; a named partition without records has no
    end and is read whole.  One row per topic-partition."""
    spark = records.sparkSession
    if not folder_has(spark, folder, "_SUCCESS"):
        stored_ends(records).coalesce(1).write.mode("overwrite").parquet(folder)
    rows = spark.read.schema("topic string, partition int, next_offset long").parquet(folder).collect()
    ends: dict[str, dict[str, int]] = {}
    for row in rows:
        ends.setdefault(row.topic, {})[str(row.partition)] = int(row.next_offset)
    if starting_offsets == "latest":
        return ends
    spec = json.loads(starting_offsets) if isinstance(starting_offsets, str) else starting_offsets
    return {
        topic: {part: ends.get(topic, {}).get(str(part), -2) if int(off) == -1 else int(off) for part, off in parts.items()}
        for topic, parts in spec.items()
    }


def _as_json(offsets) -> str:
    return offsets if isinstance(offsets, str) else json.dumps(offsets)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """``spark.table`` when the table exists, else None."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_quarantine_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Quarantine JSON lines back into typed rows.  Older lines have no
    ``ValidationErrors``; they read as an empty list."""
    df = spark.read.schema(schemas.QUARANTINE_RECORD).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSS][.SSSSSS][.SSS]XXX").json(path)
    return df.withColumn("ValidationErrors", F.coalesce(F.col("ValidationErrors"), F.array().cast("array<string>")))


def read_bronze_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Accepted JSON lines (18 PascalCase fields) back into typed rows."""
    return spark.read.schema(schemas.BRONZE_ROW).json(path)
