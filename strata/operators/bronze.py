"""Bronze: accepted and quarantine rows, offset de-duplication, first arrival,
split invariant and per-message outcome (P5-P8, F5, F7, J1, A3, X1)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import offsets
from strata.operators.latest import latest_by, oldest_first
from strata.session import run_dir, staged

ACCEPTED_STATUS = "accepted"


def accepted_records(validated: DataFrame, typed_ids: bool = False) -> DataFrame:
    """P5 (F5): rows with no validation reason, 22 columns.

    League and season are text in the batch table (as its DDL says); the
    streaming design kept them integers (P6): ``typed_ids=True``."""
    e = F.col("envelope")
    league = e["LeagueId"] if typed_ids else e["LeagueId"].cast("string")
    season = e["Season"] if typed_ids else e["Season"].cast("string")
    return validated.filter(F.col("validation_reason").isNull()).select(
        e["SchemaVersion"].alias("schema_version"),
        e["Source"].alias("source"),
        e["EntityType"].alias("entity_type"),
        e["RequestKey"].alias("request_key"),
        e["CorrelationId"].alias("correlation_id"),
        e["SourceEntityId"].alias("source_entity_id"),
        league.alias("league_id"),
        e["LeagueName"].alias("league_name"),
        season.alias("season"),
        e["Endpoint"].alias("endpoint"),
        e["FetchedAtUtc"].alias("fetched_at_utc"),
        "kafka_timestamp_utc",
        "ingested_at_utc",
        schemas.PARTITION_COLUMN,
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        e["PayloadJson"].alias("payload_json"),
        "raw_message_json",
        "idempotency_key",
        F.lit(ACCEPTED_STATUS).alias("ingestion_status"),
        F.lit(False).alias("quarantined"),
    )


def quarantine_records(validated: DataFrame) -> DataFrame:
    """P7 (F5): rows with a validation reason, 9 columns.  ``reason`` is the
    first failure, ``validation_errors`` all of them."""
    return validated.filter(F.col("validation_reason").isNotNull()).select(
        F.col("validation_reason").alias("reason"),
        F.col("validation_errors"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp_utc",
        F.col("ingested_at_utc").alias("quarantined_at_utc"),
        schemas.PARTITION_COLUMN,
        "raw_message_json",
    )


def flat_rows(validated: DataFrame) -> DataFrame:
    """The row-at-a-time consumer's 18-column row for valid envelopes:
    the 12 envelope fields, then topic, partition, offset, Kafka time, ingest
    time and raw text."""
    envelope_fields = [F.col("envelope")[f.name].alias(f.name) for f in schemas.ENVELOPE.fields]
    return validated.filter(F.col("validation_reason").isNull()).select(
        *envelope_fields,
        F.col("kafka_topic").alias("KafkaTopic"),
        F.col("kafka_partition").alias("KafkaPartition"),
        F.col("kafka_offset").alias("KafkaOffset"),
        F.col("kafka_timestamp_utc").alias("KafkaTimestampUtc"),
        F.col("ingested_at_utc").alias("IngestedAtUtc"),
        F.col("raw_message_json").alias("RawMessageJson"),
    )


def first_arrival(df: DataFrame, key: Sequence[str] = schemas.TRANSPORT_KEY) -> DataFrame:
    """A3: one row per key, the earliest ingest wins (ties: Kafka time, then
    the text, so the pick is deterministic)."""
    return latest_by(df, key, oldest_first("ingested_at_utc", "kafka_timestamp_utc", "raw_message_json"))


def remove_existing_offsets(
    df: DataFrame,
    existing: DataFrame | None,
    key: Sequence[str] = schemas.TRANSPORT_KEY,
    allow_missing_key: bool = False,
) -> DataFrame:
    """J1 against a table: drop rows whose transport key is already stored
    (``offsets.outside`` is the form against stored ranges).

    ``existing`` None (no table yet) passes everything through.  A table
    without the key columns raises unless ``allow_missing_key`` -- skipping
    silently would let duplicates in.  No distinct on the stored side: an
    anti-join ignores duplicates anyway.  Strategy (broadcast or sort-merge)
    is left to the planner and AQE, since the stored side has no size bound."""
    if existing is None:
        return df
    missing = set(key) - set(existing.columns)
    if missing:
        if allow_missing_key:
            return df
        raise ValueError(f"stored table lacks key columns {sorted(missing)}; duplicates cannot be removed")
    return df.join(existing.select(*key), list(key), "left_anti")


def split_conservation(
    validated: DataFrame,
    accepted: Callable[[DataFrame], DataFrame] = accepted_records,
    quarantine: Callable[[DataFrame], DataFrame] = quarantine_records,
) -> DataFrame:
    """input = accepted + quarantine, no row in both, none in neither.

    Runs the two sink functions themselves and compares, per transport key,
    how many rows went in and how many came out of each: one union, one
    aggregate with a map-side phase."""
    key = list(schemas.TRANSPORT_KEY)
    sides = (validated, accepted(validated), quarantine(validated))
    tagged = [d.select(*key, F.lit(i).alias("_side")) for i, d in enumerate(sides)]
    counts = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy(*key).agg(
        *[F.count_if(F.col("_side") == i).alias(n) for i, n in enumerate(("_in", "_acc", "_qua"))]
    )
    surplus = F.col("_acc") + F.col("_qua") - F.col("_in")
    total = [(F.col("_in"), "input_rows"), (F.col("_acc"), "accepted_rows"), (F.col("_qua"), "quarantine_rows"),
             (F.greatest(surplus, F.lit(0)), "rows_in_both"), (F.greatest(-surplus, F.lit(0)), "rows_in_neither")]
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in total]).withColumn(
        "conserved", (F.col("rows_in_both") == 0) & (F.col("rows_in_neither") == 0)
    )


# Outcome texts of the per-message consumer.
VALIDATION_FAILURE = "Envelope validation failure"
DUPLICATE_SKIPPED = "Duplicate skipped"
WRITTEN_FORMAT = "Consumed offset %d from %s and wrote Bronze row."


def message_outcome(validated_deliveries: DataFrame, stage: str | None = None, stored: DataFrame | None = None) -> DataFrame:
    """the outcome of every delivery, as the row-at-a-time consumer
    reports it.  Only valid envelopes are checked for duplicates, so a
    redelivered bad message is quarantined each time; the first valid
    arrival of a transport key is written, later ones are skipped.

    Nothing depends on the order in which rows are read.  Identical
    deliveries (key, ingest time, Kafka time, text) collapse to one row with
    their number; that frame is parsed once and written to ``stage`` (a
    folder in shared storage, by default a fresh one).  The first of a key is
    the rank-1 row under the total order of those columns, limited map-side;
    it is joined back on the same columns, and copies are expanded: copy 0 of
    the first is written, every other copy is skipped.

    ``stored`` are the offsets that earlier runs have stored, as ranges: valid
    deliveries inside them are duplicates too.  Bad ones go to quarantine
    whatever is stored."""
    spark = validated_deliveries.sparkSession
    stage = stage or f"{run_dir(spark, 'outcome')}/deliveries"
    delivery = [*schemas.TRANSPORT_KEY, "ingested_at_utc", "kafka_timestamp_utc", "raw_message_json"]
    verdict = ["parse_reason", "validation_errors", "validation_reason"]  # follow from the text
    collapsed = validated_deliveries.groupBy(*delivery, *verdict).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    d = staged(spark, collapsed, stage)
    valid = F.col("validation_reason").isNull()
    first = latest_by(d.filter(valid), schemas.TRANSPORT_KEY, oldest_first(*delivery[3:]))
    if stored is not None:
        first = offsets.outside(first, stored)
    first = first.select(*[F.col(c).alias(f"_{c}") for c in delivery], F.lit(True).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in delivery]
    joined = d.join(first, same, "left").select(
        *d.columns, "_first", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy")
    )
    is_first = valid & F.coalesce(F.col("_first"), F.lit(False)) & (F.col("_copy") == 0)
    parse = F.col("parse_reason")
    outcome = (
        F.when(parse.isNotNull(), parse)
        .when(~valid, F.concat(F.lit(VALIDATION_FAILURE + ": "), F.array_join("validation_errors", "; ")))
        .when(~is_first, F.lit(DUPLICATE_SKIPPED))
        .otherwise(F.format_string(WRITTEN_FORMAT, F.col("kafka_offset"), F.col("kafka_topic")))
    )
    return joined.select(
        *schemas.TRANSPORT_KEY,
        "ingested_at_utc",
        is_first.alias("written_to_bronze"),
        (~valid).alias("written_to_quarantine"),
        outcome.alias("outcome"),
    )


__all__ = [
    "ACCEPTED_STATUS", "DUPLICATE_SKIPPED", "VALIDATION_FAILURE", "accepted_records",
    "first_arrival", "flat_rows", "message_outcome", "quarantine_records",
    "remove_existing_offsets", "split_conservation",
]
