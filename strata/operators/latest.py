"""Latest row per key.

Two plans for the same result:

* ``latest_by`` -- ``row_number() = 1`` over a window.  Catalyst turns the
  rank-1 filter into a partial ``WindowGroupLimit`` before the shuffle, so a
  key holding a third of all rows ships one row per map task, not the group.
* ``latest_by_max_by`` -- ``max_by(struct(row), struct(order))`` with a partial
  (map-side) phase.  A struct buffer is not mutable, so Spark plans a sort
  aggregate: kept as a cross-check of the window, not as a cheaper form.  Only
  for orders that are all descending (nulls last), the common "newest wins".

The order must be total (break ties on a unique column) or the pick is not
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_COLUMN = "_rank"


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (sort expressions)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(RANK_COLUMN, F.row_number().over(window))
        .filter(F.col(RANK_COLUMN) == 1)
        .drop(RANK_COLUMN)
    )


def newest_first(*columns: str) -> list[Column]:
    """Descending, nulls last, for each column."""
    return [F.col(c).desc_nulls_last() for c in columns]


def oldest_first(*columns: str) -> list[Column]:
    """Ascending, nulls last, for each column."""
    return [F.col(c).asc_nulls_last() for c in columns]


def latest_by_max_by(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """Same rows as ``latest_by(df, keys, newest_first(*order_desc))``.

    Struct comparison puts null fields below any value, so the maximum is the
    descending-nulls-last first row."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(
            F.struct(*[F.col(f"`{c}`") for c in rest]),
            F.struct(*[F.col(f"`{c}`") for c in order_desc]),
        ).alias("_latest")
    )
    return picked.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"_latest.`{c}`").alias(c) for c in rest]).select(
        *[F.col(f"`{c}`") for c in df.columns]
    )
