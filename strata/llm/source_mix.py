"""Mixing sources to target weights, in DataFrame operations.

Targets.  Sources in code-point order (null last) take the weights in turn and
share all words in proportion; no target exceeds ``most`` times its source's
words, and what is cut off goes to the others by weight.  The final level is
found in one ordered pass over the sources.

Blocks.  The rows of a source, shuffled by a seeded digest, are cut into
blocks.  A target is met by whole passes over all blocks, and for the rest by
the leading blocks of one more pass; inside the block where the rest ends, rows
are taken up to the digest at which the words taken come nearest to it.

Splitting tree.  Block units (block, pass) are split among the output shards
by a binary tree over shards.  At a node, the left half draws its number of
units from the urn of all the node's units, without replacement, so that its
count for every source is multivariate hypergeometric.  Counts at the leaves
are exact quotas: they add up to each source's units, and shards are level.

Draws.  A source's units are permuted, and each shard draws its quota of them
in turn, hence disjoint.  Inside a shard the rows are shuffled by digest
(``delivered``).

All tables but the rows themselves have one row per block or unit, that is
some thousandth of the rows; a source of any size is many blocks.

Defined cases: null text has size 0 and is taken like an empty one; a null
source is a source of its own; rows with equal ids have equal digests and are
taken together in the last block; null ids count as equal; no words at all
give targets of 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import discard, staged
from strata.llm.stratified_shards import seeded_key

WEIGHTS = (1, 2, 3)
#: Rows in a block, on average.
BLOCK_ROWS = 1_000
KEY_BITS = 32
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Per source: rows, source_size, target.  ``rows`` has source and size."""
    per = rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
    turn = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    # Sources that fill up first come first; the level is set by the first that does not.
    fill = W.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead, onward = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(0, W.unboundedFollowing)
    every = W.partitionBy(F.lit(0))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(ahead), F.lit(0))
    per = per.withColumn("level", left.cast("double") / F.sum("weight").over(onward))
    holds = F.col("level") * F.col("weight") <= F.col("cap")
    per = per.withColumn("share", F.min(F.when(holds, F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(every)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("share") * F.col("weight"))
    return per.select("source", "n_rows", "source_size", target.alias("target"))


class Mix:
    """The decisions of one mix: small tables that any row can be held against."""

    def __init__(self, rows: DataFrame, sources: DataFrame, blocks: DataFrame, seed: int):
        self.rows, self.sources, self.blocks, self.seed = rows, sources, blocks, seed

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with source and digest) plus source_size, target and ``places``,
        the shard of each copy taken, in the order of the passes."""
        head = _head(F.col("digest"))
        sources = self.sources.select(F.col("source").alias("s"), "source_size", "target", "parts")
        out = rows.join(sources, _same("source", "s")).drop("s")
        out = out.withColumn("block", F.shiftright(head * F.col("parts"), KEY_BITS)).drop("parts")
        blocks = self.blocks.select(F.col("source").alias("s"), F.col("block").alias("b"), "passes", "cut", "shards")
        out = out.join(blocks, _same("source", "s") & (F.col("block") == F.col("b")), "left").drop("s", "b")
        last = F.when(F.col("digest") <= F.col("cut"), 1).otherwise(0)
        copies = F.coalesce(F.col("passes") + last, F.lit(0)).cast("int")
        places = F.coalesce(F.slice("shards", F.lit(1), copies), F.array().cast("array<int>"))
        return out.withColumn("places", places).drop("block", "passes", "cut", "shards")


def _head(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def prepared(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The narrow columns the mix works on."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        words(F.col(text_col)).alias("size"),
        seeded_key(seed, F.col(id_col)).alias("digest"),
    )


def _quotas(units: DataFrame, shards: int, total: int, seed: int) -> DataFrame:
    """(source, shard, quota): the leaves of the splitting tree."""
    node = units.select("source", "block", "pass", F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    for level in range(max(shards - 1, 0).bit_length()):
        mid = F.expr("(lo + hi) div 2").cast("int")
        room = F.expr(f"({total}L * mid) div {shards}") - F.expr(f"({total}L * lo) div {shards}")
        urn = W.partitionBy("lo", "hi").orderBy(seeded_key(seed, F.lit(f"urn{level}"), F.col("source"), F.col("block"), F.col("pass")), "source", "block", "pass")
        node = node.withColumn("mid", mid).withColumn("drawn", F.row_number().over(urn) <= room)
        node = node.select("source", "block", "pass", F.when(F.col("drawn"), F.col("lo")).otherwise(F.col("mid")).alias("lo"), F.when(F.col("drawn"), F.col("mid")).otherwise(F.col("hi")).alias("hi"))
    return node.groupBy("source", F.col("lo").alias("shard")).agg(F.count("*").alias("quota"))


def plan_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = 3,
    shards: int = 16,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> Mix:
    """Work out targets, blocks, quotas and draws for ``docs``."""
    rows = staged(prepared(docs, seed, id_col, text_col, source_col), "mix-rows")
    sources = source_targets(rows, weights, most)
    sources = sources.withColumn("parts", F.ceil(F.col("n_rows") / F.lit(block_rows)).cast("long"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    sources = staged(sources.withColumn("full", full).withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")), "mix-sources")

    of_source = sources.select(F.col("source").alias("s"), "parts")
    dealt = rows.join(of_source, _same("source", "s")).drop("s")
    dealt = dealt.withColumn("block", F.shiftright(_head(F.col("digest")) * F.col("parts"), KEY_BITS)).drop("parts")
    sums = dealt.groupBy("source", "block").agg(F.sum("size").alias("size"))
    ahead = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    sums = sums.join(sources.select(F.col("source").alias("s"), "full", "rest"), _same("source", "s")).drop("s")
    whole = F.col("before") + F.col("size") <= F.col("rest")
    ends = ~whole & (F.col("before") < F.col("rest"))
    blocks = staged(sums.withColumn("ends", ends).withColumn("passes", F.col("full") + whole.cast("long")), "mix-blocks")

    # One block a source holds the end of its rest: find the digest to stop at.
    last = blocks.where("ends").select(F.col("source").alias("s"), F.col("block").alias("b"), "before", "rest")
    inside = dealt.join(last, _same("source", "s") & (F.col("block") == F.col("b")))
    run = W.partitionBy("source", "block").orderBy("digest").rowsBetween(W.unboundedPreceding, -1)
    taken = F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0)) + F.col("size") / 2 <= F.col("rest")
    cuts = inside.withColumn("taken", taken).where("taken").groupBy("s", "b").agg(F.max("digest").alias("cut"))
    blocks = blocks.join(cuts, _same("source", "s") & (F.col("block") == F.col("b")), "left").drop("s", "b")
    blocks = blocks.select("source", "block", "passes", "cut")

    count = (F.col("passes") + F.col("cut").isNotNull().cast("long")).cast("int")
    units = blocks.withColumn("count", count).where("count > 0")
    units = staged(units.select("source", "block", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("pass")), "mix-units")
    quotas = _quotas(units, shards, units.count(), seed)
    after = W.partitionBy("source").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)
    quotas = quotas.withColumn("end", F.sum("quota").over(after))
    turns = quotas.select(F.col("source").alias("s"), "shard", F.explode(F.sequence(F.col("end") - F.col("quota") + 1, F.col("end"))).alias("t"))
    permuted = W.partitionBy("source").orderBy(seeded_key(seed, F.lit("draw"), F.col("source"), F.col("block"), F.col("pass")), "block", "pass")
    drawn = units.withColumn("turn", F.row_number().over(permuted).cast("long"))
    drawn = drawn.join(turns, _same("source", "s") & (F.col("turn") == F.col("t")))
    homes = drawn.groupBy("source", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("shards"))
    homes = homes.select(F.col("source").alias("s"), F.col("block").alias("b"), "shards")
    blocks = blocks.join(homes, _same("source", "s") & (F.col("block") == F.col("b"))).drop("s", "b")
    plan = staged(blocks, "mix-plan")
    discard(units)
    return Mix(rows, sources, plan, seed)


def mix_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: id, size, source, source_size, target, places, taken."""
    mix = plan_mix(docs, id_col=id_col, **options)
    out = mix.placed(mix.rows)
    taken = F.col("size") * F.size("places")
    return out.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", "places", taken.alias("taken"))


def delivered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", slots: bool = True, **options) -> DataFrame:
    """``docs`` as mixed: each row once per copy taken, with mix_shard and, if
    asked for, mix_slot, its place in the shard's local shuffle."""
    mix = plan_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source_col).cast("string").alias("source"),
        seeded_key(mix.seed, F.col(id_col)).alias("digest"),
    )
    out = mix.placed(packed).select("row", "digest", F.posexplode("places").alias("copy", "shard"))
    if slots:
        local = W.partitionBy("shard").orderBy(seeded_key(mix.seed, F.lit("slot"), F.col("digest"), F.col("copy")))
        return out.select("row.*", F.col("shard").alias("mix_shard"), (F.row_number().over(local) - 1).alias("mix_slot"))
    return out.select("row.*")
