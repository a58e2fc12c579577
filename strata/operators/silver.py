"""Silver: eligible Bronze rows, parsed payload, one row per idempotency key
(F8, P9, P10, W1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.operators.bronze import ACCEPTED_STATUS
from strata.operators.envelope import ENTITY_TYPE
from strata.operators.latest import latest_by, newest_first

# The Silver key and its "latest" order.
SILVER_KEY = ("idempotency_key",)
SILVER_ORDER = ("ingested_at_utc", "kafka_offset", "kafka_partition")


def eligible(bronze: DataFrame, entity_type: str = ENTITY_TYPE) -> DataFrame:
    """F8: three equality and six not-null predicates.  All are simple column
    comparisons, so they reach the table scan as pushed filters (and
    ``event_date IS NOT NULL`` as a partition filter)."""
    return bronze.filter(
        (F.col("entity_type") == entity_type)
        & (F.col("quarantined") == F.lit(False))
        & (F.col("ingestion_status") == ACCEPTED_STATUS)
        & F.col("idempotency_key").isNotNull()
        & F.col("payload_json").isNotNull()
        & F.col("ingested_at_utc").isNotNull()
        & F.col(schemas.PARTITION_COLUMN).isNotNull()
        & F.col("league_id").isNotNull()
        & F.col("season").isNotNull()
    )


def with_payload(df: DataFrame) -> DataFrame:
    """Status, response length and warning from the payload text.  Text
    that is not a JSON object gives nulls, not an error."""
    payload = F.from_json(F.col("payload_json"), schemas.PAYLOAD)
    return df.withColumn("_payload", payload).select(
        *df.columns,
        F.col("_payload.status").alias("api_status"),
        F.col("_payload.response_length").alias("api_response_length"),
        F.col("_payload.warning").alias("api_warning"),
    )


def to_int(col: str):
    # try_cast: with ANSI on, a plain cast of bad text fails the whole job.
    return F.expr(f"try_cast(`{col}` AS INT)")


def silver_row(df: DataFrame) -> DataFrame:
    """P10: the 20 Silver columns; league, season and length as integers."""
    return df.select(
        "idempotency_key", "schema_version", "source", "entity_type", "request_key",
        "correlation_id", "source_entity_id",
        to_int("league_id").alias("league_id"),
        "league_name",
        to_int("season").alias("season"),
        "endpoint", "api_status",
        to_int("api_response_length").alias("api_response_length"),
        "api_warning", "fetched_at_utc", "kafka_timestamp_utc", "ingested_at_utc",
        schemas.PARTITION_COLUMN, "payload_json", "raw_message_json",
    )


def silver_events(bronze: DataFrame) -> DataFrame:
    """F8 -> P9 -> W1 -> P10: one typed event per idempotency key; a replayed
    delivery (later ingest) replaces the earlier one.

    The payload is parsed after the rank-1 pick, so only surviving rows pay
    for JSON parsing."""
    picked = latest_by(eligible(bronze), SILVER_KEY, newest_first(*SILVER_ORDER))
    return silver_row(with_payload(picked))
