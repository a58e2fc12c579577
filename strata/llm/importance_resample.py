"""Target-distribution importance resampling.

Documents are drawn with odds that follow how much more likely their words are
in a target set than in the corpus.  Features are runs of words, hashed into
buckets; a bucket's gain is the (floored, thousandfold) log ratio of its
smoothed shares in target and corpus, and a document's weight the floored mean
of its features' gains.  Adding seeded Gumbel noise to the weights turns "take
the highest" into a draw without replacement.

Method: array-scored weights, then numeric threshold bisection.

* Two passes over the texts: one counts features per bucket (a task adds its
  counts up in an array and hands on at most ``buckets`` rows), one sums every
  document's gains by indexing the array of gains with the array of its
  features' buckets.  The gains are the only thing sent to the tasks, and have
  ``buckets`` entries whatever the input.
* The scores are written once.  The cut-off is found by bisection: each round
  is one exact count job over the written scores that counts at several
  thresholds at once.  Rows that tie at the cut-off score are settled the same
  way by id, and rows with one id by their place in the written table, so no
  row is ranked to find the cut-off and no tie lands in one task.
* Only the drawn rows are range-partitioned and numbered, a partition's first
  rank being the number of rows in the partitions before it.

Defined cases: a null text has no words; a document without features has
weight 0; a null id is hashed as ``null`` and comes last among ties; rows equal
in id and score are interchangeable and each counts as a document; an empty
corpus gives an empty result, an empty target leaves the smoothed gains.  Only
the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import parallelism, ship, staged, text_batches

#: A-Z to lower case, everything that is in no word to a space: words are ASCII letters, digits and all beyond ASCII.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Thresholds that one count job tries.
THRESHOLDS = 15


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def feature_buckets(text: bytes, buckets: int, runs: int = 1) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``runs`` of them:
    the crc32 of the words joined by a space, modulo ``buckets``."""
    found = words(text)
    sizes = [found, *([b" ".join(found[i : i + n]) for i in range(len(found) - n + 1)] for n in range(2, runs + 1))]
    hashed = np.concatenate([np.fromiter(map(crc32, part), np.uint32, len(part)) for part in sizes])
    return len(found), (hashed % np.uint32(buckets)).astype(np.int64)


def _body(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def bucket_counts(texts: DataFrame, text: str, buckets: int, runs: int = 1) -> DataFrame:
    """Features per bucket over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for body in batch.column(0):
                sums += np.bincount(feature_buckets(body.as_buffer().to_pybytes(), buckets, runs)[1], minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["bucket", "n"])

    return texts.select(_body(text).alias("body")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text: str = "text", buckets: int = 10_000, runs: int = 1) -> list[int]:
    """``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))`` per bucket, by bucket."""
    spark = corpus.sparkSession
    s = bucket_counts(corpus, text, buckets, runs).withColumnRenamed("n", "s")
    t = bucket_counts(target, text, buckets, runs).withColumnRenamed("n", "t")
    rows = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left")
    found = {r.bucket: (r.s or 0, r.t or 0) for r in rows.collect()}  # one row a bucket
    in_s, in_t = (float(sum(pair[i] for pair in found.values())) for i in (0, 1))

    def gain(s: float, t: float) -> int:
        return math.floor(1000.0 * math.log((t + 1.0) * (in_s + float(buckets)) / ((s + 1.0) * (in_t + float(buckets)))))

    return [gain(*map(float, found[b])) for b in range(buckets)]


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandfold Gumbel noise, floored, from a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_scores(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = 10_000,
    runs: int = 1,
    seed: int = 2024,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document: id, ``n_words``, ``n_features``, ``weight``, ``score`` and the columns in ``keep``."""
    ship(docs.sparkSession)
    table = np.array(gains(docs, target, text, buckets, runs), np.int64)
    given = docs.select(F.col(doc_id).alias("doc_id"), *keep, _body(text).alias("_body"))
    carried = given.drop("_body").schema.fields
    schema = T.StructType([*carried, *[T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = np.zeros((batch.num_rows, 3), np.int64)
            for i, body in enumerate(batch.column(len(carried))):
                n, found = feature_buckets(body.as_buffer().to_pybytes(), buckets, runs)
                rows[i] = n, len(found), table[found].sum() // len(found) if len(found) else 0
            yield pa.record_batch([*batch.columns[: len(carried)], *(pa.array(rows[:, i]) for i in range(3))], names=schema.names)

    return given.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def threshold(rows: DataFrame, key: Column, want: int) -> tuple[int, int, int]:
    """The smallest value with at least ``want`` rows at or below it, with the
    numbers of rows below it and at it, by bisection over exact counts."""
    at = rows.select(key.cast("long").alias("k"))
    span = at.agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n")).first()
    if want < 1 or span.n < want:
        raise ValueError(f"{want} of {span.n} rows asked for")
    low, high = span.lo, span.hi  # the answer lies in low..high
    below, upto = 0, span.n  # rows below low, rows up to high
    while low < high:
        parts = min(THRESHOLDS + 1, high - low + 1)
        cuts = sorted({low + (high - low) * i // parts for i in range(1, parts)} - {high} | {low})
        counts = at.agg(*[F.count_if(F.col("k") <= c).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        for c, n in zip(cuts, counts, strict=True):
            if n >= want:
                high, upto = c, n
                break
            low, below = c + 1, n
    return low, below, upto - below


def draw(scored: DataFrame, count: int) -> Column:
    """True for the ``count`` highest scores of ``scored`` (columns ``doc_id``,
    ``score`` and ``_row``, distinct), ties to smaller ids."""
    if count <= 0:
        return F.lit(False)
    # Each key decides among the rows that tie in those before it.
    keys = [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("_row")]
    taken, tied, left = F.lit(False), F.lit(True), count
    for key in keys:
        cut, below, at = threshold(scored.filter(tied), key, left)
        taken = taken | (tied & (key < cut))
        tied, left = tied & (key == cut), left - below
        if at == left:
            break
    return taken | tied


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    buckets: int = 10_000,
    runs: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every document with its weight, score and ``rank`` (null: not drawn).

    Of the documents with at least ``least_words`` words the ``percent``
    highest scores are drawn; rank 1 is the highest, ties go to smaller ids.
    Columns named in ``keep`` are carried along (the text itself, say)."""
    spark = docs.sparkSession
    names = ["doc_id", *keep, "n_features", "weight", "score"]
    scored = importance_scores(docs, target, doc_id, text, buckets, runs, seed, keep)
    scored = staged(scored.withColumn("_row", F.monotonically_increasing_id()), "importance-scores")
    able = F.col("n_words") >= least_words
    drawn = draw(scored.filter(able), percent * scored.filter(able).count() // 100)
    chosen, rest = scored.filter(able & drawn), scored.filter(~(able & drawn))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    parts = chosen.repartitionByRange(parallelism(spark), *order).withColumn("_part", F.spark_partition_id())
    parts = staged(parts, "importance-drawn")
    sizes = sorted((r["_part"], r["count"]) for r in parts.groupBy("_part").count().collect())  # one row a partition
    starts, before = [(-1, 0)], 0
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offset = F.broadcast(spark.createDataFrame(starts, "_part int, _before long"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = parts.join(offset, "_part").select(*names, rank.alias("rank"))
    return ranked.unionByName(rest.select(*names, F.lit(None).cast("long").alias("rank")))


__all__ = ["bucket_counts", "draw", "feature_buckets", "gains", "importance_resample", "importance_scores", "threshold"]
