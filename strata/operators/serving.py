"""Serving reads of Gold: optional filters, the 8-column projection, the
served null policy, and the most-recent-rows report (F10, P13, P14, T1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.sinks.tables import partition_values


def current_statuses(gold: DataFrame, league_id: int | None = None, season: int | None = None) -> DataFrame:
    """F10 + P13: filters only for the arguments given (AND-ed), values as
    literals so they reach the scan; no order, no limit."""
    df = gold
    if league_id is not None:
        df = df.filter(F.col("league_id") == F.lit(int(league_id)))
    if season is not None:
        df = df.filter(F.col("season") == F.lit(int(season)))
    return df.select(*schemas.SERVED_COLUMNS)


def served_rows(served: DataFrame) -> DataFrame:
    """The served null policy.  Name and category become '' when null;
    ids become 0; status and warning stay null; timestamps stay null (the
    reference's client would put its minimum date there)."""
    return served.select(
        F.coalesce(F.col("league_id").cast("int"), F.lit(0)).alias("league_id"),
        F.coalesce(F.col("league_name"), F.lit("")).alias("league_name"),
        F.coalesce(F.col("season").cast("int"), F.lit(0)).alias("season"),
        F.coalesce(F.col("status_category"), F.lit("")).alias("status_category"),
        "api_status",
        "api_warning",
        "latest_fetched_at_utc",
        "latest_ingested_at_utc",
    )


def most_recent_stored(
    spark: SparkSession, table: str, n: int, order: Sequence[str], tie_break: Sequence[str], column: str = schemas.PARTITION_COLUMN
) -> DataFrame:
    """T1 over a stored table without a scan of its history: the dates are
    walked from the newest down, in steps of 1, 2, 4 ... dates, until those
    passed hold ``n`` rows; only their files are read.

    ``column``, the table's partition, must be the date of the first column of
    ``order``, as in both Bronze tables: then no older date holds a newer row.
    Rows without a date come last and are read only when all dates are."""
    rows = spark.table(table)
    dates, step, taken = partition_values(spark, table, column), 1, 0
    counted = 0
    while taken < len(dates) and counted < n:
        part = dates[taken : taken + step]
        counted += rows.filter(_dated(column, part)).limit(n).count()
        taken, step = taken + len(part), step * 2
    return most_recent(rows.filter(_dated(column, dates[:taken])), n, order, tie_break)


def _dated(column: str, newest_first: Sequence[str | None]) -> Column:
    """Rows of these consecutive dates, as a range that prunes partitions."""
    known = [d for d in newest_first if d is not None]
    inside = F.lit(False)
    if known:
        inside = F.col(column).between(F.lit(known[-1]).cast("date"), F.lit(known[0]).cast("date"))
    return inside | F.col(column).isNull() if None in newest_first else inside


def most_recent(df: DataFrame, n: int, order: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """The newest ``n`` rows; the full key breaks ties so the report is
    stable.  ``orderBy().limit()`` plans as TakeOrderedAndProject: each task
    keeps its own top n, only those reach the final merge."""
    cols = [F.col(c).desc_nulls_last() for c in order] + [F.col(c).desc_nulls_last() for c in tie_break]
    return df.orderBy(*cols).limit(n)
