"""Streaming Bronze: same rows as batch; redeliveries across micro-batches
and across restarts land once."""

from __future__ import annotations

import pytest
from conftest import TOPIC, records, text
from pyspark.sql import functions as F

from strata.operators import bronze
from strata.operators.envelope import prepare
from strata.plans import medallion, runs
from strata.session import run_dir
from strata.sources import transport
from strata.streaming import bronze_stream

PATTERN = "raw[.]ingestion[.].*"


def topic_values():
    return [text(LeagueId=i % 5 + 1, CorrelationId=f"c{i}") if i % 4 else "garbage" for i in range(20)]


def open_stream(spark, path, per_trigger="1"):
    return transport.read_topic_stream(spark, PATTERN, "parquet", path, options={"maxFilesPerTrigger": per_trigger})


def test_two_streams_equal_batch(spark):
    root = run_dir(spark, "t-stream")
    topic = records(spark, topic_values())
    topic.coalesce(2).write.parquet(f"{root}/topic")
    clock = F.col("kafka_timestamp_utc")
    qs = bronze_stream.bronze_streams(open_stream(spark, f"{root}/topic"), f"{root}/acc", f"{root}/qua",
                                      f"{root}/cp", clock=clock)
    for q in qs:
        q.awaitTermination()
    v = prepare(topic, clock=clock)
    want_acc = bronze.accepted_records(v, typed_ids=True)
    assert sorted(spark.read.parquet(f"{root}/acc").select(*want_acc.columns).collect()) == sorted(want_acc.collect())
    want_q = bronze.quarantine_records(v)
    assert sorted(spark.read.parquet(f"{root}/qua").select(*want_q.columns).collect()) == sorted(want_q.collect())


def test_dedup_stream_across_batches_and_restart(spark):
    layout, root = runs.fresh_layout(spark, "t-dedup")
    path = f"{root}/topic"
    topic = records(spark, topic_values())
    topic.coalesce(1).write.mode("append").parquet(path)
    topic.filter("offset % 3 = 0").coalesce(1).write.mode("append").parquet(path)  # redelivered
    stream = open_stream(spark, path)
    q = bronze_stream.dedup_stream(stream, layout, f"{root}/cp", clock=F.col("kafka_timestamp_utc"))
    q.awaitTermination()
    assert q.lastProgress is not None
    acc = spark.table(layout.accepted)
    assert acc.count() == 15 and acc.select("kafka_offset").distinct().count() == 15
    assert spark.table(layout.quarantine).count() == 5
    # Restart on the same checkpoint after the whole topic is replayed.
    topic.coalesce(1).write.mode("append").parquet(path)
    q = bronze_stream.dedup_stream(open_stream(spark, path), layout, f"{root}/cp", clock=F.col("kafka_timestamp_utc"))
    q.awaitTermination()
    assert spark.table(layout.accepted).count() == 15 and spark.table(layout.quarantine).count() == 5


def test_streams_into_layer_tables(spark):
    layout, root = runs.fresh_layout(spark, "t-stream-tables")
    topic = records(spark, topic_values())
    topic.write.parquet(f"{root}/topic")
    clock = F.col("kafka_timestamp_utc")
    for q in bronze_stream.bronze_stream_tables(open_stream(spark, f"{root}/topic", "4"), layout, f"{root}/cp", clock):
        q.awaitTermination()
    v = prepare(topic, clock=clock)
    acc = bronze.accepted_records(v)
    assert sorted(spark.table(layout.accepted).select(*acc.columns).collect()) == sorted(acc.collect())
    assert spark.table(layout.quarantine).count() == bronze.quarantine_records(v).count()


def test_batch_after_the_streams_appends_nothing(spark):
    layout, root = runs.fresh_layout(spark, "t-stream-batch")
    topic = records(spark, topic_values())
    topic.coalesce(2).write.parquet(f"{root}/topic")
    clock = F.col("kafka_timestamp_utc")
    accepted, quarantine = bronze_stream.bronze_stream_tables(open_stream(spark, f"{root}/topic", "4"), layout, f"{root}/cp", clock)
    accepted.awaitTermination()
    quarantine.awaitTermination()
    assert medallion.resume_offsets(spark, layout, TOPIC) == {TOPIC: {"0": 20}}
    assert medallion.bronze_ingest(spark, topic, layout, clock=clock) == medallion.BronzeRun(0, 0)
    assert spark.table(layout.accepted).count() == 15 and spark.table(layout.quarantine).count() == 5


def test_offsets_of_one_sink_are_not_committed(spark):
    layout, _ = runs.fresh_layout(spark, "t-one-sink")
    clock = F.col("kafka_timestamp_utc")
    topic = records(spark, topic_values())
    medallion.bronze_write(spark, prepare(topic, clock), layout, sinks=["accepted"])
    assert medallion.resume_offsets(spark, layout, TOPIC) is None
    assert medallion.bronze_ingest(spark, topic, layout, clock=clock) == medallion.BronzeRun(0, 5)


def test_a_first_fill_that_was_cut_short_is_done_again(spark, monkeypatch):
    layout, _ = runs.fresh_layout(spark, "t-fill")
    clock = F.col("kafka_timestamp_utc")
    topic = records(spark, topic_values())
    medallion.bronze_ingest(spark, topic, layout, clock=clock)
    for table in (layout.offsets, layout.progress):
        spark.sql(f"DROP TABLE {table}")
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "_store", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            medallion.bronze_ingest(spark, topic, layout, clock=clock)
    assert medallion.bronze_ingest(spark, topic, layout, clock=clock) == medallion.BronzeRun(0, 0)
