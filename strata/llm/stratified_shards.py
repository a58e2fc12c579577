"""Sharding by proportional stratified interleaving, in DataFrame operations.

Rows of a source are shuffled by a seeded digest and ranked.  A row's
fractional rank (rank - 1/2) / rows of its source spreads every source evenly
over (0, 1); sorting all rows by it interleaves the sources in proportion, and
cutting the sorted sequence into equal runs gives shards whose row counts are
at most one apart and whose mixture is that of the whole (law ``rows``).

Neither ranking passes through one task: rows of a source are dealt to buckets
by leading bits of the digest, and the sorted sequence to buckets of the
fractional rank.  Buckets hold about ``bucket_rows`` rows, whatever the size of
a source; their counts, summed up in order, give the rank at which each starts.

Defined cases: a null text has size 8 and the checksum of empty bytes; null
sources form one source; a null id is shuffled as a value of its own; repeated
rows are kept, each with its own slot; shards get no row when there are fewer
rows than shards; an empty table gives an empty result.  Only the three named
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import discard, staged

#: Rows ranked together by one task, on average.
BUCKET_ROWS = 5_000
#: Leading bits of the digest that number the buckets of a source.
KEY_BITS = 32


def seeded_key(seed: int, *columns: Column) -> Column:
    """Hex digest that shuffles rows: the same rows, the same order, on every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns]))


def starts(counts: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """``before``: rows of the group in the buckets ahead of this one.

    ``counts`` has a row per bucket, far fewer than the rows they count.
    """
    order = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    order = order.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))


def stratified_shards(
    docs: DataFrame,
    shards: int = 24,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per row: id, size, text_crc32, source, shard, and its slot in the shard."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    ).withColumn("digest", seeded_key(seed, F.col("id")))
    rows = staged(rows, "shard-rows")

    # Rank in the source: by bucket of the digest, then inside the bucket.
    per_source = rows.groupBy("source").agg(F.count("*").alias("total"))
    head = F.conv(F.substring("digest", 1, KEY_BITS // 4), 16, 10).cast("long")
    parts = F.ceil(F.col("total") / F.lit(bucket_rows)).cast("long")
    per_source = per_source.select(F.col("source").alias("s"), "total", parts.alias("parts"))
    dealt = rows.join(per_source, F.col("source").eqNullSafe(F.col("s")))
    dealt = dealt.drop("s").withColumn("bucket", F.shiftright(head * F.col("parts"), KEY_BITS))
    counts = dealt.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    begin = starts(counts, ["source"], "bucket").select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before")
    inside = W.partitionBy("source", "bucket").orderBy("digest", "id", "crc", "size")
    ranked = dealt.withColumn("r", F.row_number().over(inside))
    ranked = ranked.join(begin, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    ranked = ranked.withColumn("rank", F.col("before") + F.col("r")).withColumn("place", (F.col("rank") - F.lit(0.5)) / F.col("total"))
    ranked = staged(ranked.select("id", "source", "size", "crc", "digest", "place"), "shard-ranks")
    discard(rows)

    # Position among all rows: by bucket of the fractional rank, then inside it.
    n = ranked.count()
    wide = max(1, -(-n // bucket_rows))
    ranked = ranked.withColumn("bucket", F.floor(F.col("place") * wide))
    counts = ranked.groupBy("bucket").agg(F.count("*").alias("n"))
    begin = starts(counts, [], "bucket").select(F.col("bucket").alias("b"), "before")
    inside = W.partitionBy("bucket").orderBy("place", "source", "digest", "id", "crc", "size")
    placed = ranked.withColumn("r", F.row_number().over(inside))
    placed = placed.join(begin, F.col("bucket") == F.col("b")).withColumn("at", F.col("before") + F.col("r") - 1)
    shard = F.expr(f"at * {shards} div {max(n, 1)}")
    placed = placed.withColumn("shard", shard.cast("int"))
    # The first position of shard s is the least p with p * shards >= s * n.
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return placed.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("source").alias(source_col), "shard", (F.col("at") - first).alias("slot")
    )
