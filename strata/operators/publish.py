"""Publishing Gold to an outside target and reconciling the copy
(P17, K4, A5, X2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strata.sinks.tables import observed, rows_written


def published_shape(df: DataFrame) -> DataFrame:
    """Upper-case column names, timestamps without zone (UTC wall
    clock), integers kept as numbers."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(field.name.upper()))
    return df.select(*cols)


def publish_snapshot(df: DataFrame, fmt: str = "parquet", options: dict[str, str] | None = None) -> int:
    """K4: full-refresh copy.  ``fmt`` and ``options`` name the target (a
    warehouse connector, or a path for file formats).  Returns the rows
    written, counted during the write."""
    watched, obs = observed(published_shape(df))
    watched.write.format(fmt).options(**(options or {})).mode("overwrite").save()
    return rows_written(obs)


#: Buckets of a reconciliation by checksums.
BUCKETS = 4_096


def reconcile_buckets(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A5 + X2 for large copies that mostly agree; the same report row as
    ``reconcile``.

    Rows fall into buckets by a hash of all columns.  Per bucket each side has
    its rows and the sums of two independent hashes, which do not depend on
    order and are added up before the shuffle: a few numbers a task are moved,
    no rows.  Only rows of buckets whose sums differ are compared one by one.
    Row counts are exact.  A difference is missed only where a bucket has equal
    counts and both 64-bit sums agree by chance; ``reconcile`` has no such
    chance.  The differing buckets are at most ``buckets`` rows and broadcast."""
    src = published_shape(source)
    cols = [F.col(f"`{c}`") for c in src.columns]
    # A hash passes over nulls, so which columns are null is hashed too.
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])

    def hashed(df: DataFrame, side: int) -> DataFrame:
        out = df.select(*cols, F.lit(side).alias("_side"), F.xxhash64(nulls, *cols).alias("_h1"), F.xxhash64(F.lit(1), *reversed(cols), nulls).alias("_h2"))
        return out.withColumn("_bucket", F.pmod("_h1", F.lit(buckets)))

    both = hashed(src, 1).unionByName(hashed(target.select(*cols), -1))
    signed = [F.sum(F.col(h).cast("decimal(20,0)") * F.col("_side")).alias(h) for h in ("_h1", "_h2")]
    sums = both.groupBy("_bucket").agg(F.count_if(F.col("_side") == 1).alias("_src"), F.count_if(F.col("_side") == -1).alias("_tgt"), *signed)
    differ = sums.filter((F.col("_src") != F.col("_tgt")) | (F.col("_h1") != 0) | (F.col("_h2") != 0)).select("_bucket")
    rows = both.join(F.broadcast(differ), "_bucket", "left_semi")
    zero = F.lit(0).cast("long")
    per_row = _row_counts(rows, cols)
    surplus = F.col("_src") - F.col("_tgt")
    parts = sums.select("_src", "_tgt", zero.alias("_missing"), zero.alias("_extra")).unionByName(
        per_row.select(zero.alias("_src"), zero.alias("_tgt"), F.greatest(surplus, zero).alias("_missing"), F.greatest(-surplus, zero).alias("_extra")))
    return _report(parts)


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """A5 + X2: one report row -- row counts of both sides and the size of
    the multiset difference in each direction.

    Equivalent to ``exceptAll`` both ways, done in one shuffle: tag the rows
    of each side, group by every column (nulls compare equal) and compare
    the per-row multiplicities."""
    src = published_shape(source)
    cols = [F.col(f"`{c}`") for c in src.columns]
    both = src.withColumn("_side", F.lit(1)).unionByName(target.select(*cols).withColumn("_side", F.lit(-1)))
    surplus = F.col("_src") - F.col("_tgt")
    counted = _row_counts(both, cols).select(
        "_src", "_tgt", F.greatest(surplus, F.lit(0)).alias("_missing"), F.greatest(-surplus, F.lit(0)).alias("_extra"))
    return _report(counted)


def _row_counts(both: DataFrame, cols: list[Column]) -> DataFrame:
    return both.groupBy(*cols).agg(F.count_if(F.col("_side") == 1).alias("_src"), F.count_if(F.col("_side") == -1).alias("_tgt"))


def _report(parts: DataFrame) -> DataFrame:
    named = {"_src": "source_rows", "_tgt": "target_rows", "_missing": "missing_in_target", "_extra": "extra_in_target"}
    return parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in named.items()]).withColumn(
        "matched",
        (F.col("source_rows") == F.col("target_rows"))
        & (F.col("missing_in_target") == 0)
        & (F.col("extra_in_target") == 0),
    )
