"""Stored offsets as intervals (J1, A2): per topic-partition a set of disjoint
ranges ``[low_offset, next_offset)``.

Offsets of a partition are nearly contiguous, so what a table holds is a row
per gap instead of a row per message.  Nothing here sorts a whole partition:
offsets become ranges, and ranges are merged, inside buckets of
``OFFSETS_PER_BUCKET``, and a batch meets ranges only in buckets of
``OFFSETS_PER_PIECE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import schemas

#: Offsets whose ranges one window finds.
OFFSETS_PER_BUCKET = 1 << 18
#: Offsets within which a batch's rows are compared with ranges.
OFFSETS_PER_PIECE = 4096

PLACE = ("kafka_topic", "kafka_partition")
RANGE = (*PLACE, "low_offset", "next_offset")


def _bucket(offset: str) -> Column:
    return F.expr(f"({offset} - pmod({offset}, {OFFSETS_PER_BUCKET}L)) div {OFFSETS_PER_BUCKET}L")


def _joined(ranges: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """Overlapping and touching ranges of a group become one.

    One sort and no aggregate: a row opens a range where all rows before it
    have ended, and that range ends where the rows before the next opening do."""
    order = Window.partitionBy(*group).orderBy("low_offset", "next_offset")
    marked = ranges.select(
        *ranges.columns,
        F.max("next_offset").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.max("next_offset").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_last"),
    )
    opening = marked.filter(F.col("_before").isNull() | (F.col("_before") < F.col("low_offset")))
    end = F.coalesce(F.lead("_before").over(order), F.col("_last"))
    return opening.select(*group, "low_offset", end.alias("next_offset"))


def islands(keys: DataFrame) -> DataFrame:
    """Ranges that hold exactly the offsets of ``keys`` (repeats allowed), at
    least one per bucket of offsets."""
    once = keys.filter(F.col("kafka_offset").isNotNull()).select(*schemas.TRANSPORT_KEY).distinct()
    single = once.select(
        *PLACE, F.col("kafka_offset").alias("low_offset"), (F.col("kafka_offset") + 1).alias("next_offset"), _bucket("kafka_offset").alias("_bucket"))
    return _joined(single, (*PLACE, "_bucket")).select(*RANGE)


def merged(ranges: DataFrame) -> DataFrame:
    """The same offsets in as few ranges as possible: overlapping and touching
    ranges become one.

    Ranges are cut at bucket borders and joined inside each bucket.  What is
    left to join lies at a border, at most two ranges a bucket; only those
    meet in a window over the topic-partition."""
    buckets = F.explode(F.sequence(_bucket("low_offset"), _bucket("(next_offset - 1)"))).alias("_bucket")
    start = F.col("_bucket") * OFFSETS_PER_BUCKET
    cut = ranges.select(*RANGE, buckets).select(
        *PLACE, F.greatest("low_offset", start).alias("low_offset"), F.least("next_offset", start + OFFSETS_PER_BUCKET).alias("next_offset"), "_bucket")
    inner = _joined(cut, (*PLACE, "_bucket"))
    border = (F.col("low_offset") % OFFSETS_PER_BUCKET == 0) | (F.col("next_offset") % OFFSETS_PER_BUCKET == 0)
    return inner.filter(~border).select(*RANGE).unionByName(_joined(inner.filter(border), PLACE).select(*RANGE))


def clipped(ranges: DataFrame, ends: DataFrame) -> DataFrame:
    """The parts of ``ranges`` inside ``ends``, one span a topic-partition."""
    spans = ends.select(*PLACE, F.col("low_offset").alias("_low"), F.col("next_offset").alias("_next"))
    low, end = F.greatest("low_offset", "_low"), F.least("next_offset", "_next")
    return ranges.join(spans, list(PLACE)).select(*PLACE, low.alias("low_offset"), end.alias("next_offset")).filter("low_offset < next_offset")


def outside(batch: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of ``batch`` whose offset lies in none of ``ranges``.

    Ranges are cut at piece borders, so rows and ranges meet by equality of
    the piece; a piece holds at most ``OFFSETS_PER_PIECE`` offsets and half as
    many ranges.  Strategy and skew are left to the planner and AQE."""
    piece = F.explode(F.sequence(F.expr(f"low_offset div {OFFSETS_PER_PIECE}"), F.expr(f"(next_offset - 1) div {OFFSETS_PER_PIECE}")))
    pieces = ranges.select(*[F.col(c).alias(f"_{c}") for c in RANGE], piece.alias("_piece"))
    own = F.expr(f"kafka_offset div {OFFSETS_PER_PIECE}") == F.col("_piece")
    same = [F.col(c) == F.col(f"_{c}") for c in PLACE]
    inside = (F.col("kafka_offset") >= F.col("_low_offset")) & (F.col("kafka_offset") < F.col("_next_offset"))
    return batch.join(pieces, [own, *same, inside], "left_anti")


__all__ = ["RANGE", "clipped", "islands", "merged", "outside"]
