"""Streaming Bronze (S2, S3, K2, ST1, ST2).

* ``bronze_streams`` -- the streaming design: one source, two stateless
  append queries (accepted, quarantine), each with its own checkpoint.  Both
  use the same rule column as batch, so they are complementary (the
  reference's separate streaming predicates dropped rows with a null league
  or season from both outputs).
* ``dedup_stream`` -- the consumer loop with redelivery protection: each
  micro-batch goes through the batch Bronze write (first arrival, then the
  anti-join against what is stored), so a key seen in any earlier batch, or
  a micro-batch replayed after a failure, appends nothing.
* ``outcome_stream`` -- the same loop with the outcome of every message as a
  third sink, from one parse of each micro-batch.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from strata import schemas
from strata.operators.bronze import accepted_records, message_outcome, quarantine_records
from strata.operators.envelope import prepare
from strata.session import configure, drop_folder, folder_has, in_pieces, run_dir, staged
from strata.streaming.metrics import counted

AVAILABLE_NOW = {"availableNow": True}


def _sink(df: DataFrame, path: str, checkpoint: str, trigger: dict, name: str | None) -> StreamingQuery:
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(schemas.PARTITION_COLUMN)
        .trigger(**trigger)
    )
    if name:
        writer = writer.queryName(name)
    return writer.start(path)


def bronze_streams(
    stream: DataFrame,
    accepted_path: str,
    quarantine_path: str,
    checkpoint_root: str,
    clock: Column | None = None,
    passthrough: Iterable[str] = (),
    trigger: dict | None = None,
    typed_ids: bool = True,
) -> tuple[StreamingQuery, StreamingQuery]:
    """ST1 + K2: two append queries over one source, one checkpoint each.

    The streaming design keeps league and season as integers (P6,
    ``typed_ids``).  ``clock`` defaults to the micro-batch time."""
    validated = prepare(stream, clock, passthrough)
    trigger = trigger or AVAILABLE_NOW
    accepted = _sink(
        counted(accepted_records(validated, typed_ids=typed_ids), "accepted"), accepted_path, f"{checkpoint_root}/accepted", trigger, None
    )
    quarantine = _sink(counted(quarantine_records(validated), "quarantine"), quarantine_path, f"{checkpoint_root}/quarantine", trigger, None)
    return accepted, quarantine


def bronze_stream_tables(
    stream: DataFrame,
    layout: schemas.Layout,
    checkpoint_root: str,
    clock: Column | None = None,
    passthrough: Iterable[str] = (),
    trigger: dict | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """ST1 + K2 into the layer tables: two append queries, as the streaming
    design has them.  League and season are written as text, the batch
    tables' type, and every micro-batch goes through the batch Bronze write
    for its sink, which logs keys and offsets, so batch and stream can append
    to the same tables."""
    from strata.plans.medallion import bronze_write, create_run_tables

    configure(stream.sparkSession)  # a stream starts with a copy of its settings
    validated = prepare(stream, clock, passthrough)
    trigger = trigger or AVAILABLE_NOW
    create_run_tables(stream.sparkSession, layout)
    turn = threading.Lock()  # both append to the key log and the record of runs, and file tables take one writer

    def start(sink: str) -> StreamingQuery:
        def per_batch(batch: DataFrame, _epoch: int) -> None:
            with turn:
                bronze_write(batch.sparkSession, batch, layout, sinks=[sink])

        return (
            validated.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", f"{checkpoint_root}/{sink}")
            .trigger(**trigger)
            .start()
        )

    return start("accepted"), start("quarantine")


def dedup_stream(
    stream: DataFrame,
    layout: schemas.Layout,
    checkpoint: str,
    clock: Column | None = None,
    passthrough: Iterable[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """ST2 (A3 stream form): every micro-batch is appended through the batch
    Bronze write, which de-duplicates within the batch and against the
    stored tables.  Idempotent per batch, so exactly-once end to end with a
    replayable source."""
    from strata.plans.medallion import bronze_write

    configure(stream.sparkSession)  # a stream starts with a copy of its settings
    validated = prepare(stream, clock, passthrough)

    def per_batch(batch: DataFrame, _epoch: int) -> None:
        bronze_write(batch.sparkSession, batch, layout)

    return (
        validated.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def outcome_stream(
    stream: DataFrame,
    layout: schemas.Layout,
    outcomes: str,
    checkpoint: str,
    clock: Column | None = None,
    passthrough: Iterable[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """F7 + ST2: accepted, quarantine and the outcome of every delivery.

    A micro-batch is parsed once and staged.  Its outcomes are judged against
    the offsets that earlier micro-batches stored, so a valid message counts as
    written the first time it comes, in whatever micro-batch, and as a
    duplicate from then on.  The state is the offset log: a row per gap.

    Outcomes lie in a folder per micro-batch under ``outcomes``, which belongs
    to ``checkpoint``.  They are written whole before the tables are appended
    to, and a micro-batch that is run again keeps those it has: judged anew it
    would meet its own rows."""
    from strata.plans.medallion import bronze_write, stored_within

    configure(stream.sparkSession)  # a stream starts with a copy of its settings
    validated = prepare(stream, clock, passthrough)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        folder = run_dir(spark, "deliveries")
        try:
            parsed = staged(spark, batch, f"{folder}/parsed")
            own = f"{outcomes}/batch_id={epoch}"
            if not folder_has(spark, own, "_SUCCESS"):
                stored = stored_within(spark, layout, parsed)
                with in_pieces(spark, parsed.count() + stored.count()):
                    message_outcome(parsed, f"{folder}/collapsed", stored).write.mode("overwrite").parquet(own)
            bronze_write(spark, parsed, layout)
        finally:
            drop_folder(spark, folder)

    return (
        validated.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
