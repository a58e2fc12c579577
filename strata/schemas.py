"""One StructType per table, DDL generated from it, and the table name builder.

Column names, order and types of the stored tables are fixed values that must
equal the reference's DDL so that existing tables and readers keep working.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, I, L, TS, D, B = StringType(), IntegerType(), LongType(), TimestampType(), DateType(), BooleanType()

# Kafka source schema (the transport record).
TRANSPORT = _struct(
    ("topic", S), ("partition", I), ("offset", L), ("timestamp", TS), ("value", BinaryType()),
)

# The 12 envelope fields, in serialisation order.
ENVELOPE = _struct(
    ("SchemaVersion", S),
    ("Source", S),
    ("EntityType", S),
    ("LeagueId", I),
    ("LeagueName", S),
    ("Season", I),
    ("CorrelationId", S),
    ("FetchedAtUtc", TS),
    ("Endpoint", S),
    ("RequestKey", S),
    ("SourceEntityId", S),
    ("PayloadJson", S),
)

CORRUPT_FIELD = "_corrupt_record"
ENVELOPE_PARSE = StructType(ENVELOPE.fields + [StructField(CORRUPT_FIELD, S, True)])

# Payload fields read by Silver.
PAYLOAD = _struct(("status", S), ("response_length", I), ("warning", S))

# Bronze accepted table, 22 columns.
BRONZE_ACCEPTED = _struct(
    ("schema_version", S), ("source", S), ("entity_type", S), ("request_key", S),
    ("correlation_id", S), ("source_entity_id", S), ("league_id", S), ("league_name", S),
    ("season", S), ("endpoint", S), ("fetched_at_utc", TS), ("kafka_timestamp_utc", TS),
    ("ingested_at_utc", TS), ("event_date", D), ("kafka_topic", S), ("kafka_partition", I),
    ("kafka_offset", L), ("payload_json", S), ("raw_message_json", S), ("idempotency_key", S),
    ("ingestion_status", S), ("quarantined", B),
)

# Bronze quarantine table, 9 columns.
BRONZE_QUARANTINE = _struct(
    ("reason", S), ("validation_errors", ArrayType(S)), ("kafka_topic", S), ("kafka_partition", I),
    ("kafka_offset", L), ("kafka_timestamp_utc", TS), ("quarantined_at_utc", TS), ("event_date", D),
    ("raw_message_json", S),
)

# Silver event table, 20 columns.
SILVER = _struct(
    ("idempotency_key", S), ("schema_version", S), ("source", S), ("entity_type", S),
    ("request_key", S), ("correlation_id", S), ("source_entity_id", S), ("league_id", I),
    ("league_name", S), ("season", I), ("endpoint", S), ("api_status", S),
    ("api_response_length", I), ("api_warning", S), ("fetched_at_utc", TS),
    ("kafka_timestamp_utc", TS), ("ingested_at_utc", TS), ("event_date", D),
    ("payload_json", S), ("raw_message_json", S),
)

# Gold current-state table, 14 columns.
GOLD = _struct(
    ("league_id", I), ("league_name", S), ("season", I), ("api_status", S),
    ("api_response_length", I), ("api_warning", S), ("status_category", S),
    ("latest_idempotency_key", S), ("latest_request_key", S), ("latest_correlation_id", S),
    ("latest_fetched_at_utc", TS), ("latest_ingested_at_utc", TS), ("event_date", D),
    ("latest_payload_json", S),
)

# The served row, 8 columns.
SERVED_COLUMNS = (
    "league_id", "league_name", "season", "status_category", "api_status", "api_warning",
    "latest_fetched_at_utc", "latest_ingested_at_utc",
)

# The row-at-a-time consumer's JSON-lines rows (PascalCase).
BRONZE_ROW = _struct(
    ("SchemaVersion", S), ("Source", S), ("EntityType", S), ("LeagueId", I), ("LeagueName", S),
    ("Season", I), ("CorrelationId", S), ("FetchedAtUtc", TS), ("Endpoint", S), ("RequestKey", S),
    ("SourceEntityId", S), ("PayloadJson", S), ("KafkaTopic", S), ("KafkaPartition", I),
    ("KafkaOffset", L), ("KafkaTimestampUtc", TS), ("IngestedAtUtc", TS), ("RawMessageJson", S),
)

QUARANTINE_RECORD = _struct(
    ("Reason", S), ("ValidationErrors", ArrayType(S)), ("KafkaTopic", S), ("KafkaPartition", I),
    ("KafkaOffset", L), ("KafkaTimestampUtc", TS), ("QuarantinedAtUtc", TS), ("RawMessageJson", S),
)

# What the Bronze job has stored, as ranges of offsets, and its record of runs.
STORED_OFFSETS = _struct(("kafka_topic", S), ("kafka_partition", I), ("low_offset", L), ("next_offset", L))
INGEST_PROGRESS = _struct(
    ("run_id", S), ("state", S), ("kafka_topic", S), ("kafka_partition", I), ("low_offset", L), ("next_offset", L),
)

TRANSPORT_KEY = ("kafka_topic", "kafka_partition", "kafka_offset")
PARTITION_COLUMN = "event_date"


@dataclass(frozen=True)
class Layout:
    """Where the layer tables live: ``[catalog.]schema.object``.

    Fixed values: the object names of the four tables.
    """

    catalog: str | None = None
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    accepted_object: str = "raw_ingestion_events"
    quarantine_object: str = "raw_ingestion_quarantine"
    silver_object: str = "league_status_events"
    gold_object: str = "current_league_status"
    offsets_object: str = "raw_ingestion_offsets"
    progress_object: str = "raw_ingestion_progress"
    # Format of the tables the jobs create and write.
    fmt: str = "parquet"

    def name(self, schema: str, obj: str) -> str:
        parts = [self.catalog, schema, obj] if self.catalog else [schema, obj]
        return ".".join(parts)

    @property
    def accepted(self) -> str:
        return self.name(self.bronze_schema, self.accepted_object)

    @property
    def quarantine(self) -> str:
        return self.name(self.bronze_schema, self.quarantine_object)

    @property
    def offsets(self) -> str:
        return self.name(self.bronze_schema, self.offsets_object)

    @property
    def progress(self) -> str:
        return self.name(self.bronze_schema, self.progress_object)

    @property
    def silver(self) -> str:
        return self.name(self.silver_schema, self.silver_object)

    @property
    def gold(self) -> str:
        return self.name(self.gold_schema, self.gold_object)


def ddl_type(dtype: DataType) -> str:
    if isinstance(dtype, ArrayType):
        return f"ARRAY<{ddl_type(dtype.elementType)}>"
    if isinstance(dtype, TimestampNTZType):
        return "TIMESTAMP_NTZ"
    return dtype.simpleString().upper()


def create_table_ddl(
    name: str,
    schema: StructType,
    partition_by: tuple[str, ...] = (PARTITION_COLUMN,),
    fmt: str = "parquet",
    location: str | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for one table schema (K7).

    Partition columns go last, as Spark stores them.
    """
    data = [f for f in schema.fields if f.name not in partition_by]
    parts = [f for name in partition_by for f in schema.fields if f.name == name]
    cols = ",\n  ".join(f"`{f.name}` {ddl_type(f.dataType)}" for f in data + parts)
    text = f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING {fmt}"
    if partition_by:
        text += f"\nPARTITIONED BY ({', '.join(partition_by)})"
    if location:
        text += f"\nLOCATION '{location}'"
    return text
