"""JSON-lines sinks of the row-at-a-time consumer (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.envelope import JSON_TIMESTAMP_FORMAT


def quarantine_lines(quarantine: DataFrame) -> DataFrame:
    """Quarantine rows (P7 shape) as the consumer's 8 PascalCase fields."""
    return quarantine.select(
        F.col("reason").alias("Reason"),
        F.col("validation_errors").alias("ValidationErrors"),
        F.col("kafka_topic").alias("KafkaTopic"),
        F.col("kafka_partition").alias("KafkaPartition"),
        F.col("kafka_offset").alias("KafkaOffset"),
        F.col("kafka_timestamp_utc").alias("KafkaTimestampUtc"),
        F.col("quarantined_at_utc").alias("QuarantinedAtUtc"),
        F.col("raw_message_json").alias("RawMessageJson"),
    )


def append_jsonl(df: DataFrame, path: str) -> None:
    """K5: append JSON lines (micro-second timestamps, nulls omitted)."""
    df.write.mode("append").option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)
