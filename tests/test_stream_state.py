"""Streams that keep state: rows per sink and micro-batch, calls per day,
arrived offsets, outcomes."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from conftest import records, text
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.operators import quota
from strata.plans import runs
from strata.session import run_dir
from strata.sources import transport
from strata.streaming import arrival_stream, bronze_stream, quota_stream
from strata.streaming.metrics import SinkRows


def test_rows_are_counted_per_sink_and_micro_batch(spark):
    root = run_dir(spark, "t-stream-rows")
    for start in (0, 10):
        records(spark, [text(), "garbage", text()], start=start).coalesce(1).write.mode("append").parquet(f"{root}/topic")
    stream = transport.read_topic_stream(spark, "raw[.].*", "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1"})
    listener = SinkRows()
    spark.streams.addListener(listener)
    try:
        queries = bronze_stream.bronze_streams(stream, f"{root}/a", f"{root}/q", f"{root}/cp", clock=F.col("kafka_timestamp_utc"))
        for q in queries:
            q.awaitTermination()
        listener.wait(queries)
    finally:
        spark.streams.removeListener(listener)
    assert listener.batches() == [("accepted", 0, 2), ("accepted", 1, 2), ("quarantine", 0, 1), ("quarantine", 1, 1)]
    assert listener.totals() == {"accepted": spark.read.parquet(f"{root}/a").count(), "quarantine": spark.read.parquet(f"{root}/q").count()}


def answer(spark, root):
    stream = spark.readStream.schema("id long, ts timestamp").parquet(f"{root}/calls")
    out = quota_stream.reserve_calls(stream, "ts", "id", cap=3)
    query = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start(f"{root}/out")
    query.awaitTermination()
    return sorted((r.id is None, r.id or 0, r.call_number or 0, r.admitted) for r in spark.read.parquet(f"{root}/out").collect())


def test_calls_are_answered_across_batches_and_restarts(spark):
    root = run_dir(spark, "t-quota")
    day = dt.datetime(2026, 4, 10, 8)
    rows = [(i, day + dt.timedelta(hours=3 * i)) for i in range(12)] + [(20, None), (None, None)]
    parts = [rows[:2], rows[2:7], rows[7:]]
    for part in parts:
        spark.createDataFrame(part, "id long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{root}/calls")
        got = answer(spark, root)
    want = quota.admit_calls(spark.createDataFrame(rows, "id long, ts timestamp"), "ts", "id", 3).collect()
    assert got == sorted((r.id is None, r.id or 0, r.call_number or 0, r.admitted) for r in want)


def test_a_late_call_meets_its_days_count(spark):
    root = run_dir(spark, "t-quota-late")
    day, other = dt.datetime(2026, 4, 10, 8), dt.datetime(2026, 4, 11, 8)
    for rows in ([(i, day) for i in range(1, 4)], [(4, other)], [(5, day), (6, other)]):
        spark.createDataFrame(rows, "id long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{root}/calls")
        got = answer(spark, root)
    assert [(g[1], g[3]) for g in got] == [(1, True), (2, True), (3, True), (4, True), (5, False), (6, True)]


def arrivals(spark, root, order=("delivered_at", "timestamp", "value")):
    """One run over what lies in the folder; the rows kept so far and the progress of the run."""
    stream = spark.readStream.schema(spark.read.parquet(f"{root}/topic").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/topic")
    query = arrival_stream.first_deliveries(stream, order).writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start(f"{root}/out")
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out"), query.recentProgress


def test_every_offset_is_kept_once_however_late(spark):
    root = run_dir(spark, "t-arrivals")
    size = 2 * arrival_stream.OFFSETS_PER_BITMAP + 100
    every = spark.range(size).select(
        F.lit("raw.a").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.timestamp_seconds("id").alias("timestamp"), F.encode(F.col("id").cast("string"), "UTF-8").alias("value"),
        F.timestamp_seconds("id").alias("delivered_at"))
    again = every.withColumn("delivered_at", F.col("delivered_at") + F.expr("INTERVAL 1 DAY"))
    late = F.col("offset") < 50  # long behind all others in time and arrival
    for part in (every.filter(~late), again.filter(~late), every.filter(late).unionByName(again.filter(late))):
        part.coalesce(1).write.mode("append").parquet(f"{root}/topic")
        out, progress = arrivals(spark, root)
    got = out.agg(F.count("*"), F.countDistinct("offset"), F.sum(F.col("delivered_at").eqNullSafe(F.col("timestamp")).cast("int"))).first()
    assert tuple(got) == (size, size, size)
    states = [s.numRowsTotal for p in progress for s in p.stateOperators]
    assert max(states) == 3  # a bitmap for each 4,096 offsets


def test_arrival_ties_nulls_and_partitions(spark):
    root = run_dir(spark, "t-arrivals-nulls")
    at = dt.datetime(2026, 4, 10)
    rows = [
        ("a", 0, 1, at, bytearray(b"y"), at), ("a", 0, 1, at, bytearray(b"x"), at), ("a", 0, 1, at, None, at), ("a", 0, 1, None, bytearray(b"a"), at),
        ("a", 1, 1, at, bytearray(b"y"), None), ("b", 0, 1, at, bytearray(b""), at), (None, None, 1, None, None, None),
        ("a", 0, None, at, bytearray(b"n"), at), ("a", 0, None, at, bytearray(b"m"), at),
    ]
    schema = "topic string, partition int, offset long, timestamp timestamp, value binary, delivered_at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/topic")
    out, _ = arrivals(spark, root)
    got = {(r.topic, r.partition, r.offset): None if r.value is None else bytes(r.value) for r in out.collect()}
    assert out.count() == len(got) == 5
    assert got == {("a", 0, 1): b"x", ("a", 1, 1): b"y", ("b", 0, 1): b"", (None, None, 1): None, ("a", 0, None): b"m"}


def outcomes(spark, layout, root):
    stream = transport.read_topic_stream(spark, "raw[.].*", "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1"})
    bronze_stream.outcome_stream(stream, layout, f"{root}/outcomes", f"{root}/cp", clock=F.col("kafka_timestamp_utc")).awaitTermination()
    rows = spark.read.parquet(f"{root}/outcomes").collect()
    return sorted((r.batch_id, r.kafka_offset, r.outcome.split(":")[0].split(" ")[0], r.written_to_bronze, r.written_to_quarantine) for r in rows)


def test_outcomes_across_micro_batches(spark):
    layout, root = runs.fresh_layout(spark, "t-outcomes")
    for values in ([text(), "garbage"], [text(), "garbage", text()]):
        records(spark, values).coalesce(1).write.mode("append").parquet(f"{root}/topic")
        got = outcomes(spark, layout, root)
    assert got == [
        (0, 0, "Consumed", True, False), (0, 1, "JSON", False, True),
        (1, 0, "Duplicate", False, False), (1, 1, "JSON", False, True), (1, 2, "Consumed", True, False),
    ]
    assert spark.table(layout.accepted).count() == 2 and spark.table(layout.quarantine).count() == 1


@pytest.mark.parametrize("sink", ["accepted", "quarantine"])
def test_a_micro_batch_run_again_keeps_its_outcomes(spark, sink):
    layout, root = runs.fresh_layout(spark, f"t-outcomes-{sink}")
    records(spark, [text(), "garbage", text()]).coalesce(1).write.parquet(f"{root}/topic")
    # A view takes no rows: the append to this sink fails, after the outcomes are written.
    broken = dataclasses.replace(layout, **{f"{sink}_object": f"no_{sink}"})
    spark.sql(f"CREATE VIEW {getattr(broken, sink)} AS SELECT * FROM {getattr(layout, sink)}")
    with pytest.raises(StreamingQueryException):
        outcomes(spark, broken, root)
    got = outcomes(spark, layout, root)
    assert got == [(0, 0, "Consumed", True, False), (0, 1, "JSON", False, True), (0, 2, "Consumed", True, False)]
    assert spark.table(layout.accepted).count() == 2 and spark.table(layout.quarantine).count() == 1
