"""Transport records derived from the ``events`` table (test and bench input).

The rules are in FIXTURES.md section 4.  Every event becomes one status
envelope published to one topic; ``event_id % 40`` picks a fault (or none);
events with ``event_id % 10 = 0`` are delivered a second time, one day later,
with the same transport key.  All of it is a projection of ``events`` (no
shuffle), so it scales with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.envelope import build_envelope, envelope_json

# Fixed values of the fixture.
TOPIC = "raw.ingestion.dev"
PARTITIONS = 4
LEAGUES = 7
FIRST_SEASON = 2020
SEASONS = 3
FAULT_CYCLE = 40
REDELIVERY_CYCLE = 10
NOT_JSON_TEXT = "not valid json"
DELIVERY_CLOCK = "delivered_at"


def _payload(events: DataFrame) -> Column:
    status = F.to_json(
        F.struct(
            F.col("event_type").alias("status"),
            F.get_json_object("props", "$.k").cast("int").alias("response_length"),
            F.when(F.col("event_type") == "error", F.lit("w")).alias("warning"),
        )
    )
    return status


def _override(value: Column, fault: Column, cases: dict[int, Column]) -> Column:
    out = None
    for code, replacement in cases.items():
        out = (F.when(fault == code, replacement) if out is None else out.when(fault == code, replacement))
    return out.otherwise(value) if out is not None else value


def fixture_envelopes(events: DataFrame) -> DataFrame:
    """events -> (event_id, ts, partition, fault, envelope struct)."""
    ts = F.col("ts").cast("timestamp")
    league = (F.col("user_id") % LEAGUES + 1).cast("int")
    season = (F.lit(FIRST_SEASON) + F.col("user_id") % SEASONS).cast("int")
    base = build_envelope(
        league, season, _payload(events),
        correlation_id=F.concat(F.lit("c-"), F.col("event_id").cast("string")),
        fetched_at=ts,
    )
    fault = (F.col("event_id") % FAULT_CYCLE).cast("int")
    e = F.col("_base")
    null_s = F.lit(None).cast("string")
    env = F.struct(
        _override(e["SchemaVersion"], fault, {2: F.lit(" ")}).alias("SchemaVersion"),
        _override(e["Source"], fault, {3: F.lit(""), 12: F.lit("")}).alias("Source"),
        _override(e["EntityType"], fault, {4: F.lit(""), 13: F.lit("fixtures")}).alias("EntityType"),
        _override(e["LeagueId"], fault, {5: F.lit(0), 12: F.lit(0)}).alias("LeagueId"),
        e["LeagueName"].alias("LeagueName"),
        _override(e["Season"], fault, {6: F.lit(-1)}).alias("Season"),
        _override(e["CorrelationId"], fault, {7: null_s}).alias("CorrelationId"),
        e["FetchedAtUtc"].alias("FetchedAtUtc"),
        _override(e["Endpoint"], fault, {8: F.lit("  ")}).alias("Endpoint"),
        _override(e["RequestKey"], fault, {9: null_s, 12: null_s}).alias("RequestKey"),
        _override(e["SourceEntityId"], fault, {10: F.lit("")}).alias("SourceEntityId"),
        _override(e["PayloadJson"], fault, {11: F.lit("")}).alias("PayloadJson"),
    )
    return events.select(
        "event_id", ts.alias("ts"), (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        fault.alias("fault"), base.alias("_base"),
    ).select("event_id", "ts", "partition", "fault", env.alias("envelope"))


def fixture_topic(events: DataFrame, with_clock: bool = False) -> DataFrame:
    """The topic: one Kafka-shaped record per event (first delivery)."""
    env = fixture_envelopes(events)
    text = (
        F.when(F.col("fault") == 0, F.lit(NOT_JSON_TEXT))
        .when(F.col("fault") == 1, F.lit(""))
        .otherwise(envelope_json(F.col("envelope")))
    )
    cols = [
        F.lit(TOPIC).alias("topic"),
        F.col("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.encode(text, "UTF-8").alias("value"),
    ]
    if with_clock:
        cols.append(F.col("ts").alias(DELIVERY_CLOCK))
    return env.select(*cols)


def redeliveries(topic_with_clock: DataFrame) -> DataFrame:
    """Records delivered again: same transport key, ingested one day later."""
    return topic_with_clock.filter(F.col("offset") % REDELIVERY_CYCLE == 0).withColumn(
        DELIVERY_CLOCK, F.col(DELIVERY_CLOCK) + F.expr("INTERVAL 1 DAY")
    )


def deliveries(events: DataFrame) -> DataFrame:
    """First deliveries and redeliveries together, each with its clock.

    One pass over the topic: a redelivered record is exploded into two
    deliveries (copy 0 at ``ts``, copy 1 a day later) instead of unioning a
    second derivation of the whole topic."""
    first = fixture_topic(events, with_clock=True)
    copies = F.when(F.col("offset") % REDELIVERY_CYCLE == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        first.select("*", F.explode(copies).alias("_copy"))
        .withColumn(DELIVERY_CLOCK, F.col(DELIVERY_CLOCK) + F.make_dt_interval(days=F.col("_copy")))
        .drop("_copy")
    )
