"""Gold: the current row per (league_id, league_name, season) with a derived
status category (W2, P11, P12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.columns import status_category
from strata.operators.latest import latest_by, latest_by_max_by, newest_first

# The Gold grain and its "latest" order.
GOLD_KEY = ("league_id", "league_name", "season")
GOLD_ORDER = ("ingested_at_utc", "fetched_at_utc", "idempotency_key")


def with_status_category(df: DataFrame) -> DataFrame:
    """Warning non-blank -> warning; status non-blank -> ok; else unknown."""
    return df.withColumn("status_category", status_category(F.col("api_warning"), F.col("api_status")))


def gold_row(df: DataFrame) -> DataFrame:
    """The 14 Gold columns with ``latest_*`` names."""
    # Names, order and aliases of the stored schema.
    return df.select(
        "league_id",
        "league_name",
        "season",
        "api_status",
        "api_response_length",
        "api_warning",
        "status_category",
        F.col("idempotency_key").alias("latest_idempotency_key"),
        F.col("request_key").alias("latest_request_key"),
        F.col("correlation_id").alias("latest_correlation_id"),
        F.col("fetched_at_utc").alias("latest_fetched_at_utc"),
        F.col("ingested_at_utc").alias("latest_ingested_at_utc"),
        schemas.PARTITION_COLUMN,
        F.col("payload_json").alias("latest_payload_json"),
    )


_GOLD_INPUT = (
    "league_id", "league_name", "season", "api_status", "api_response_length", "api_warning",
    "idempotency_key", "request_key", "correlation_id", "fetched_at_utc", "ingested_at_utc",
    schemas.PARTITION_COLUMN, "payload_json",
)


def current_status(silver: DataFrame, keys: Sequence[str] = GOLD_KEY, method: str = "window") -> DataFrame:
    """W2 -> P12 -> P11.  ``method`` is ``window`` (rank-1 window, partial
    WindowGroupLimit) or ``max_by`` (a sorting aggregate, for comparison).
    Each map task sends at most one row per key to the shuffle, which matters
    because the grain is coarse: a handful of keys hold all rows."""
    narrow = silver.select(*_GOLD_INPUT)
    if method == "window":
        latest = latest_by(narrow, keys, newest_first(*GOLD_ORDER))
    elif method == "max_by":
        latest = latest_by_max_by(narrow, keys, GOLD_ORDER)
    else:
        raise ValueError(f"unknown method {method!r}")
    return gold_row(with_status_category(latest))


def merged_status(gold: DataFrame, silver: DataFrame, keys: Sequence[str] = GOLD_KEY) -> DataFrame:
    """W2 over stored Gold rows and further Silver rows: Gold holds each
    key's newest row with all columns of the order, so the newest of both is
    the newest of all."""
    names = {f"latest_{c}": c for c in ("idempotency_key", "request_key", "correlation_id", "fetched_at_utc", "ingested_at_utc", "payload_json")}
    old = gold.withColumnsRenamed(names).select(*_GOLD_INPUT)
    latest = latest_by(old.unionByName(silver.select(*_GOLD_INPUT)), keys, newest_first(*GOLD_ORDER))
    return gold_row(with_status_category(latest))
