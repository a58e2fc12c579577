"""Daily call quota: which calls a capped day admits, and the day ledger
(W4, A4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the default number of calls allowed per UTC day.
DEFAULT_MAX_CALLS_PER_DAY = 100


# Parts that the calls of one day are ranked in before the day as a whole.
DAY_PARTS = 64


def _order(ts: str, call_id: str) -> Column:
    """Comparable form of "time, then id, nulls last"."""
    return F.struct(F.col(ts).isNull().alias("no_ts"), F.col(ts).alias("ts"), F.col(call_id).isNull().alias("no_id"), F.col(call_id).alias("id"))


def admitted_calls(calls: DataFrame, ts: str, call_id: str, cap: int = DEFAULT_MAX_CALLS_PER_DAY) -> DataFrame:
    """The calls each UTC day admits: the first ``cap`` by (time, id), with
    ``call_date`` and ``call_number``.

    Ranked twice, so that no task ever meets a whole day whatever the cap: a
    day's calls are dealt by hash to ``DAY_PARTS`` parts, each keeps its first
    ``cap``, and the day is ranked among what the parts kept (at most cap x
    DAY_PARTS rows).  Calls that tie on time and id are ordered by a hash of
    the whole row."""
    day = calls.withColumn("call_date", F.to_date(F.col(ts))).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in calls.columns]))
    day = day.withColumn("_part", F.pmod(F.xxhash64(F.col(call_id), F.col(ts), "_tie"), F.lit(DAY_PARTS)))
    order = [F.col(ts).asc_nulls_last(), F.col(call_id).asc_nulls_last(), F.col("_tie")]
    kept = day.withColumn("_rank", F.row_number().over(Window.partitionBy("call_date", "_part").orderBy(*order)))
    kept = kept.filter(F.col("_rank") <= cap)
    number = F.row_number().over(Window.partitionBy("call_date").orderBy(*order))
    return kept.withColumn("call_number", number).filter(F.col("call_number") <= cap).drop("_part", "_rank", "_tie")


def admit_calls(calls: DataFrame, ts: str, call_id: str, cap: int = DEFAULT_MAX_CALLS_PER_DAY) -> DataFrame:
    """Every call with ``admitted`` and its ``call_number`` (null when
    skipped).

    No join by id, which may repeat or be null: each day has a cut-off, the
    (time, id) of the last admitted call.  Calls up to it are numbered, which
    is the cap and those that tie with its last; all others are skipped."""
    last = admitted_calls(calls.select(call_id, ts), ts, call_id, cap)
    last = last.groupBy(F.col("call_date").alias("_day")).agg(F.max(_order(ts, call_id)).alias("_last"))
    day = calls.withColumn("call_date", F.to_date(F.col(ts)))
    placed = day.join(last, F.col("call_date").eqNullSafe(F.col("_day"))).drop("_day")
    early = F.coalesce(_order(ts, call_id) <= F.col("_last"), F.lit(False))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in calls.columns])
    window = Window.partitionBy("call_date").orderBy(F.col(ts).asc_nulls_last(), F.col(call_id).asc_nulls_last(), tie)
    numbered = placed.filter(early).drop("_last").withColumn("_n", F.row_number().over(window))
    numbered = numbered.withColumn("call_number", F.when(F.col("_n") <= cap, F.col("_n"))).drop("_n")
    skipped = placed.filter(~early).drop("_last").withColumn("call_number", F.lit(None).cast("int"))
    return numbered.unionByName(skipped).withColumn("admitted", F.col("call_number").isNotNull())


def call_ledger(
    calls: DataFrame,
    ts: str,
    call_id: str,
    completed: Column,
    cap: int = DEFAULT_MAX_CALLS_PER_DAY,
) -> DataFrame:
    """A4: one ledger row per UTC day -- calls made (admitted, at most
    ``cap``), the cap, when the last admitted call started and completed.
    Reads only the admitted set: no join back to all calls."""
    admitted = admitted_calls(calls.withColumn("_completed", completed), ts, call_id, cap)
    return (
        admitted.groupBy("call_date")
        .agg(
            F.count(F.lit(1)).cast("int").alias("CallsMade"),
            F.max(F.col(ts)).alias("LastCallStartedAtUtc"),
            F.max("_completed").alias("LastCallCompletedAtUtc"),
        )
        .select(
            F.date_format("call_date", "yyyy-MM-dd").alias("DateUtc"),
            "CallsMade",
            F.lit(cap).cast("int").alias("MaxCallsPerDay"),
            "LastCallStartedAtUtc",
            "LastCallCompletedAtUtc",
        )
    )
