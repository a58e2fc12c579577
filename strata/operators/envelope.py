"""Transport projection, envelope parse, derived columns; envelope build and
serialisation (P1-P4, P15, P16, K6)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.rules import first_error, parse_failure, rule_errors

# Micro-second text for timestamps inside JSON; the default writes millis.
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def transport_columns(kafka_df: DataFrame, passthrough: Iterable[str] = ()) -> DataFrame:
    """Rename the Kafka columns; value bytes -> UTF-8 text.

    ``passthrough`` names extra columns to carry along unchanged (e.g. a
    per-record delivery clock in test fixtures)."""
    return kafka_df.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp_utc"),
        F.col("value").cast("string").alias("raw_message_json"),
        *[F.col(c) for c in passthrough],
    )


def _parse(text: Column) -> Column:
    return F.from_json(
        text, schemas.ENVELOPE_PARSE, {"columnNameOfCorruptRecord": schemas.CORRUPT_FIELD, "mode": "PERMISSIVE"}
    )


def _transport_key() -> Column:
    return F.concat_ws(
        "|", F.col("kafka_topic"), F.col("kafka_partition").cast("string"), F.col("kafka_offset").cast("string")
    )


def parse_envelope(df: DataFrame, text_col: str = "raw_message_json") -> DataFrame:
    """Parse the text once into ``envelope`` (12 fields + corrupt-record
    text) and derive ``parse_reason`` from it."""
    parsed_struct = _parse(F.col(text_col))
    # The parse runs inside a Generate (explode of a one-element array, so
    # one output row per input row, a null struct included).  Filters on
    # fields of the parsed struct -- the accepted/quarantine split, Silver's
    # eligibility -- cannot be pushed below a generator's output, so the text
    # is parsed exactly once per row.  From a plain projection, Catalyst
    # would push those filters down to the scan with the parse inlined in
    # every predicate, evaluated before any repartition.
    parsed = df.select("*", F.explode(F.array(parsed_struct)).alias("envelope"))
    return parsed.withColumn("parse_reason", parse_failure(F.col(text_col), F.col("envelope")))


def derive_columns(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """Ingest time, ingest date (the partition) and the transport key.

    ``clock`` defaults to ``current_timestamp()``; pass a column to make a run
    reproducible."""
    clock = (F.current_timestamp() if clock is None else clock).cast("timestamp")
    return df.withColumns(
        {
            "ingested_at_utc": clock,
            schemas.PARTITION_COLUMN: F.to_date(clock),
            "idempotency_key": _transport_key(),
        }
    )


def business_key(df: DataFrame, name: str = "business_key") -> DataFrame:
    """``Source|EntityType|RequestKey``.  ``concat_ws`` skips nulls, so
    keys of invalid envelopes can collide; validate before relying on it."""
    e = F.col("envelope")
    return df.withColumn(name, F.concat_ws("|", e["Source"], e["EntityType"], e["RequestKey"]))


def validate(df: DataFrame) -> DataFrame:
    """F3 + F4: ``validation_errors`` (all failures, in rule order) and
    ``validation_reason`` (the first of them, or null) from the one rule
    list.  The reason is read off the list, so the rules are evaluated once."""
    errors = rule_errors(F.col("parse_reason"), F.col("envelope"))
    return df.withColumn("validation_errors", errors).withColumn(
        "validation_reason", first_error(F.col("validation_errors"))
    )


def prepare(kafka_df: DataFrame, clock: Column | None = None, passthrough: Iterable[str] = ()) -> DataFrame:
    """P1 -> P2 -> P3 -> F3/F4: the validated frame both Bronze sinks read."""
    parsed = parse_envelope(transport_columns(kafka_df, passthrough))
    return validate(derive_columns(parsed, clock))


# --- building and publishing envelopes (the producer side) -------------------

# What the producer writes into every status envelope.
SCHEMA_VERSION = "1.0"
SOURCE = "api-football"
ENTITY_TYPE = "league-status"
ENDPOINT = "/status"
MISSING_PAYLOAD_JSON = '{"warning":"API key not configured"}'


def build_envelope(
    league_id: Column,
    season: Column,
    payload: Column,
    correlation_id: Column | None = None,
    fetched_at: Column | None = None,
) -> Column:
    """P15 + P16: the envelope struct for one (league, season, payload).

    A null payload becomes the synthetic warning payload.  Correlation id and
    fetch time default to ``uuid()`` and ``current_timestamp()``; pass columns
    for reproducible output."""
    correlation_id = F.expr("uuid()") if correlation_id is None else correlation_id
    fetched_at = F.current_timestamp() if fetched_at is None else fetched_at
    league = league_id.cast("int")
    season = season.cast("int")
    return F.struct(
        F.lit(SCHEMA_VERSION).alias("SchemaVersion"),
        F.lit(SOURCE).alias("Source"),
        F.lit(ENTITY_TYPE).alias("EntityType"),
        league.alias("LeagueId"),
        F.concat(F.lit("League-"), league.cast("string")).alias("LeagueName"),
        season.alias("Season"),
        correlation_id.cast("string").alias("CorrelationId"),
        fetched_at.cast("timestamp").alias("FetchedAtUtc"),
        F.lit(ENDPOINT).alias("Endpoint"),
        F.format_string("status-%d-%d", league, season).alias("RequestKey"),
        league.cast("string").alias("SourceEntityId"),
        F.coalesce(payload.cast("string"), F.lit(MISSING_PAYLOAD_JSON)).alias("PayloadJson"),
    )


def envelope_json(envelope: Column) -> Column:
    """K6: serialise an envelope struct to JSON text (null fields omitted,
    micro-second timestamps)."""
    return F.to_json(envelope, {"timestampFormat": JSON_TIMESTAMP_FORMAT})


def to_transport(df: DataFrame, envelope_col: str, topic: str, passthrough: Iterable[str] = ()) -> DataFrame:
    """K6: records ready for a Kafka sink -- null key, JSON value, topic."""
    return df.select(
        *[F.col(c) for c in passthrough],
        F.lit(None).cast("binary").alias("key"),
        F.encode(envelope_json(F.col(envelope_col)), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
    )
