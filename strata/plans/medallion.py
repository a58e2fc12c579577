"""The layer jobs: Bronze ingest, Silver and Gold rebuilds and increments,
replay (R1-R3, K8).

Layers talk only through tables.  Each job returns the rows it wrote, counted
during the write.

Bronze keeps two small tables beside its outputs:

* the offset log -- what is stored, as disjoint ranges of offsets per
  topic-partition: a row per gap, merged after every run;
* the record of runs -- per run and topic-partition the offsets it read, as
  ``started`` before the first append and ``committed`` after the last.

An offset's message never changes, so its verdict never does: an offset stored
in either sink is done, and one log serves both.  The log only ever repeats
what the tables hold.  Where it is missing or empty, or the record of runs is
missing, it is made anew from the tables.

A run that ends between its appends leaves ``started`` alone.  The next run
first logs what such a run did store, then reads again from the last committed
offsets: what was stored is skipped, what was not is appended.

A run may write one sink only, as each of the two Bronze streams does.  Its
state names the sink, and offsets count as committed once both sinks have them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import offsets
from strata.operators.bronze import accepted_records, first_arrival, quarantine_records
from strata.operators.envelope import prepare
from strata.operators.gold import GOLD_KEY, GOLD_ORDER, current_status, merged_status
from strata.operators.latest import latest_by, newest_first
from strata.operators.silver import SILVER_KEY, silver_events
from strata.session import configure, drop_folder, in_pieces, run_dir, staged
from strata.sinks.tables import FILE_FORMATS, append, create_database, create_table, overwrite, overwrite_partitions, overwrite_swap

STARTED, COMMITTED, RECOVERED = "started", "committed", "recovered"
#: Rows of the record of runs from which on it is compacted.
PROGRESS_ROWS = 10_000
SINKS = ("accepted", "quarantine")


@dataclass
class BronzeRun:
    accepted_rows: int
    quarantine_rows: int


def create_layer_tables(spark: SparkSession, layout: schemas.Layout, root: str | None = None, swap: bool = False) -> None:
    """K7 for every layer (schemas, then tables), optionally under ``root``.
    With ``swap`` Silver and Gold are views that the first rebuild makes, so
    their names stay free."""
    for schema in {layout.bronze_schema, layout.silver_schema, layout.gold_schema}:
        db = f"{layout.catalog}.{schema}" if layout.catalog else schema
        create_database(spark, db, f"{root}/{schema}" if root else None)
    tables = [(layout.accepted, schemas.BRONZE_ACCEPTED), (layout.quarantine, schemas.BRONZE_QUARANTINE)]
    if not swap:
        tables += [(layout.silver, schemas.SILVER), (layout.gold, schemas.GOLD)]
    for name, schema in tables:
        create_table(spark, name, schema, fmt=layout.fmt)
    create_run_tables(spark, layout)


def create_run_tables(spark: SparkSession, layout: schemas.Layout) -> None:
    """The offset log and the record of runs.  The log is made from the tables
    where it cannot be trusted: it or the record is missing, or it is empty.
    The record is created after that, so a fill that was cut short is done again."""
    trusted = spark.catalog.tableExists(layout.progress)
    create_table(spark, layout.offsets, schemas.STORED_OFFSETS, (), fmt=layout.fmt)
    spark.catalog.refreshTable(layout.offsets)  # a session keeps file lists, and a stream writes in a session of its own
    if not trusted or spark.table(layout.offsets).isEmpty():
        stored = [spark.table(t).select(*schemas.TRANSPORT_KEY) for t in _sinks(spark, layout).values()]
        if any(not t.isEmpty() for t in stored):
            keys = stored[0]
            for more in stored[1:]:
                keys = keys.unionAll(more)
            _store(spark, layout, offsets.islands(keys), keys.count(), anew=True)
    create_table(spark, layout.progress, schemas.INGEST_PROGRESS, (), fmt=layout.fmt)
    spark.catalog.refreshTable(layout.progress)


def _sinks(spark: SparkSession, layout: schemas.Layout) -> dict[str, str]:
    """The sink tables that there are, as they are now."""
    tables = {name: table for name, table in zip(SINKS, (layout.accepted, layout.quarantine), strict=True) if spark.catalog.tableExists(table)}
    for table in tables.values():
        spark.catalog.refreshTable(table)
    return tables


def _store(spark: SparkSession, layout: schemas.Layout, ranges: DataFrame, rows: int, anew: bool = False) -> None:
    """Merge ranges made from ``rows`` rows into the log (or make it of them alone).

    The log is a row per gap, written aside and put in place whole.  A run
    that ends while the old one is gone leaves it empty, and an empty log is
    made anew from the tables."""
    folder = run_dir(spark, "offsets")
    try:
        old = spark.table(layout.offsets).select(*offsets.RANGE)
        with in_pieces(spark, rows + (0 if anew else old.count())):
            offsets.merged(ranges if anew else old.unionByName(ranges)).write.parquet(folder)
        new = spark.read.schema(schemas.STORED_OFFSETS).parquet(folder)
        new.write.format(layout.fmt).mode("overwrite").saveAsTable(layout.offsets)
    finally:
        drop_folder(spark, folder)


def _record(spark: SparkSession, layout: schemas.Layout, run_id: str, state: str, ends: DataFrame) -> None:
    rows = ends.select(F.lit(run_id).alias("run_id"), F.lit(state).alias("state"), "kafka_topic", "kafka_partition", "low_offset", "next_offset")
    append(rows.coalesce(1), layout.progress, (), fmt=layout.fmt)


def _state(state: str, sinks: Iterable[str]) -> str:
    """The state of a run that writes ``sinks``: one that writes a single sink names it."""
    return state if tuple(sinks) == SINKS else "-".join([state, *sinks])


def recover(spark: SparkSession, layout: schemas.Layout, sinks: Iterable[str] = SINKS) -> None:
    """Log the offsets that runs without a commit have stored.

    Reads the stored tables only inside the offsets those runs had read; in
    the usual case there is no such run and nothing is read.  A run over one
    sink looks at earlier runs over that sink or both: the other stream's run
    may be going on."""
    runs = spark.table(layout.progress)
    states = runs.select("run_id", "state").distinct().collect()  # kept under PROGRESS_ROWS
    begun = {_state(STARTED, x) for x in (SINKS, tuple(sinks), *((s,) for s in sinks))}
    ended = {r.run_id for r in states if not r.state.startswith(STARTED)}
    for run_id in sorted({r.run_id for r in states if r.state in begun} - ended):
        ends = runs.filter((F.col("run_id") == run_id) & F.col("state").isin(*begun))
        span = ends.select(*offsets.PLACE, "low_offset", "next_offset")
        for table in _sinks(spark, layout).values():
            rows = spark.table(table).join(span, list(offsets.PLACE))
            rows = rows.filter((F.col("kafka_offset") >= F.col("low_offset")) & (F.col("kafka_offset") < F.col("next_offset")))
            _store(spark, layout, offsets.islands(rows), rows.count())
            spark.catalog.refreshTable(layout.offsets)
        _record(spark, layout, run_id, RECOVERED, ends)
    if len(states) >= PROGRESS_ROWS:
        compact_runs(spark, layout)


def compact_runs(spark: SparkSession, layout: schemas.Layout) -> int:
    """Rewrite the record of runs: per topic-partition and state the furthest
    of the ended runs, and every run that has not ended; returns its rows.  If
    this is cut short the record is missing, and the next run starts at the
    earliest offset and skips what is stored."""
    runs = spark.table(layout.progress)
    over = runs.filter(~F.col("state").startswith(STARTED))
    left = runs.filter(F.col("state").startswith(STARTED)).join(over.select("run_id").distinct(), "run_id", "left_anti")
    furthest = over.groupBy("state", *offsets.PLACE).agg(
        F.max_by("run_id", "next_offset").alias("run_id"), F.min("low_offset").alias("low_offset"), F.max("next_offset").alias("next_offset"))
    folder = run_dir(spark, "runs")
    try:
        furthest.select(*runs.columns).unionByName(left.select(*runs.columns)).coalesce(1).write.parquet(folder)
        kept = spark.read.schema(schemas.INGEST_PROGRESS).parquet(folder)
        kept.write.format(layout.fmt).mode("overwrite").saveAsTable(layout.progress)
        return kept.count()
    finally:
        spark.catalog.refreshTable(layout.progress)
        drop_folder(spark, folder)


def batch_ends(batch: DataFrame) -> DataFrame:
    """The span of offsets a staged batch covers, a row a topic-partition."""
    rows = batch.groupBy(*offsets.PLACE).agg(F.min("kafka_offset").alias("low_offset"), (F.max("kafka_offset") + 1).alias("next_offset")).collect()
    return batch.sparkSession.createDataFrame(rows, schemas.STORED_OFFSETS)


def stored_within(spark: SparkSession, layout: schemas.Layout, batch: DataFrame) -> DataFrame:
    """The stored offsets inside the spans of a staged batch, as ranges.  What
    a run that never committed has stored is logged first."""
    create_run_tables(spark, layout)
    recover(spark, layout)
    return offsets.clipped(spark.table(layout.offsets), batch_ends(batch))


def bronze_ingest(
    spark: SparkSession,
    transport: DataFrame,
    layout: schemas.Layout,
    clock: Column | None = None,
    passthrough: Iterable[str] = (),
    dedupe_in_batch: bool = True,
) -> BronzeRun:
    """Bronze batch job (R1, R3): parse and validate once, drop keys already
    stored, append to both sinks.  See ``bronze_write`` for the options."""
    configure(spark)
    return bronze_write(spark, prepare(transport, clock, passthrough), layout, dedupe_in_batch)


def bronze_write(
    spark: SparkSession,
    validated: DataFrame,
    layout: schemas.Layout,
    dedupe_in_batch: bool = True,
    sinks: Iterable[str] = SINKS,
) -> BronzeRun:
    """Append a validated batch to the accepted and quarantine tables, or to
    those of them in ``sinks``.

    * The batch is written once to shared storage and both sinks read that
      copy: the topic is parsed once, and input, offsets and clock are the
      same for both whatever happens to an executor.  The copy goes at the end.
      Its files are small, so no task sorts or hashes more than a few of them,
      in however few pieces the batch comes.
    * ``dedupe_in_batch``: first arrival per transport key before J1 (A3),
      for inputs that can repeat a key (file topics, redeliveries), read from
      a copy of its own.  A Kafka offset range never does; pass False there
      and save the copy and the shuffle.
    * J1 compares with the offset log, inside the offsets of the batch; a
      batch of new offsets alone meets no range and is not joined at all.
    * Re-running the same batch appends nothing, so a replayed micro-batch
      or a retried job is idempotent."""
    create_run_tables(spark, layout)
    recover(spark, layout, sinks)
    folder = run_dir(spark, "batch")
    try:
        batch = staged(spark, validated, f"{folder}/parsed")
        rows = batch.count()  # of the files' footers
        if dedupe_in_batch:
            with in_pieces(spark, rows):
                batch = staged(spark, first_arrival(batch), f"{folder}/first")
        run_id = uuid.uuid4().hex
        ends = batch_ends(batch)
        _record(spark, layout, run_id, _state(STARTED, sinks), ends)
        met = offsets.clipped(spark.table(layout.offsets), ends)
        known = met.count()
        new = offsets.outside(batch, met) if known else batch
        counts = dict.fromkeys(SINKS, 0)
        made = {"accepted": accepted_records, "quarantine": quarantine_records}
        verdict = {"accepted": F.col("validation_reason").isNull(), "quarantine": F.col("validation_reason").isNotNull()}
        tables = {"accepted": layout.accepted, "quarantine": layout.quarantine}
        stored = F.lit(False)
        for sink in sinks:
            with in_pieces(spark, rows + known):
                counts[sink] = append(made[sink](new), tables[sink], fmt=layout.fmt)
            stored = stored | verdict[sink]
        if sum(counts.values()):
            _store(spark, layout, offsets.islands(batch.filter(stored)), rows)
        _record(spark, layout, run_id, _state(COMMITTED, sinks), ends)
    finally:
        drop_folder(spark, folder)
    return BronzeRun(counts["accepted"], counts["quarantine"])


def resume_offsets(
    spark: SparkSession, layout: schemas.Layout, topic: str, partitions: Iterable[int] = ()
) -> dict[str, dict[str, int]] | None:
    """Starting offsets of the next run over ``topic``: where the committed
    runs ended, ``{topic: {partition: offset}}``, the Kafka
    ``startingOffsets`` form; None before the first commit.

    A run counts only once both its appends are done, and offsets of runs over
    one sink only as far as both sinks have them, so nothing that was read but
    not stored is skipped.  The Kafka connector wants every
    partition named once offsets are specific: those in ``partitions``
    without a commit start at -2, earliest.  One row per partition."""
    if not spark.catalog.tableExists(layout.progress):
        return None
    spark.catalog.refreshTable(layout.progress)
    done = spark.table(layout.progress).filter(F.col("kafka_topic") == topic)
    ends = []  # per sink: where the runs that wrote it ended
    for sink in SINKS:
        wrote = done.filter(F.col("state").isin(COMMITTED, _state(COMMITTED, [sink])))
        ends.append(wrote.groupBy("kafka_partition").agg(F.max("next_offset").alias(sink)))
    rows = ends[0].join(ends[1], "kafka_partition").select("kafka_partition", F.least(*SINKS).alias("next")).collect()
    if not rows:
        return None
    return {topic: {**{str(p): -2 for p in partitions}, **{str(r.kafka_partition): int(r.next) for r in rows}}}


def date_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Partition filter on ``event_date`` (inclusive bounds)."""
    if start is not None:
        df = df.filter(F.col(schemas.PARTITION_COLUMN) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(schemas.PARTITION_COLUMN) <= F.lit(end).cast("date"))
    return df


def _rebuild(df: DataFrame, name: str, layout: schemas.Layout, swap: bool) -> int:
    return overwrite_swap(df, name, fmt=layout.fmt) if swap else overwrite(df, name, fmt=layout.fmt)


def _replace(spark: SparkSession, df: DataFrame, name: str, layout: schemas.Layout, swap: bool) -> int:
    """Rebuild a table from a frame that reads the table itself: written
    aside first, so that the old rows are whole until the new ones are."""
    if swap:
        return overwrite_swap(df, name, fmt=layout.fmt)
    folder = run_dir(spark, "replace")
    try:
        df.write.parquet(folder)
        return overwrite(spark.read.schema(df.schema).parquet(folder), name, fmt=layout.fmt)
    finally:
        drop_folder(spark, folder)


def _replace_touched(
    spark: SparkSession, name: str, key: Iterable[str], new: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]
) -> int:
    """Bring a table forward by ``new`` rows and rewrite only the dates this
    touches: where new rows lie, and where the rows lie that they may replace.

    ``merged(old, new)`` is given the old rows of those dates.  All old rows of
    a new row's key are among them, so it sees each key whole.  Of all other
    dates the key columns are read, to find the keys' places, and no file is
    written.  The dates are collected: a value a day."""
    folder = run_dir(spark, "touched")
    try:
        new.write.parquet(f"{folder}/new")
        new = spark.read.schema(new.schema).parquet(f"{folder}/new")
        old, date = spark.table(name), schemas.PARTITION_COLUMN
        keys = new.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
        places = old.join(keys, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key], "left_semi").select(date)
        touched = [r[0] for r in places.unionAll(new.select(date)).distinct().collect()]
        rows = merged(old.filter(F.col(date).isin(touched)), new)
        rows.write.parquet(f"{folder}/rows")
        return overwrite_partitions(spark.read.schema(rows.schema).parquet(f"{folder}/rows"), name, touched)
    finally:
        drop_folder(spark, folder)


def silver_rebuild(
    spark: SparkSession, layout: schemas.Layout, start: str | None = None, end: str | None = None, swap: bool = False
) -> int:
    """Silver job: full rebuild from Bronze, or of a range of ingest dates.

    A range rebuild replaces every key that has a Bronze row or a Silver row
    in the range, from all of that key's Bronze rows; all other Silver rows
    stay as they are.  A key whose newest row lies outside the range, or
    moves between dates, thus ends as in a full rebuild.  ``swap`` writes a
    new version and repoints a view (see ``overwrite_swap``)."""
    configure(spark)
    bronze = spark.table(layout.accepted)
    if start is None and end is None:
        with in_pieces(spark, bronze.count()):
            return _rebuild(silver_events(bronze), layout.silver, layout, swap)
    old, key = spark.table(layout.silver), list(SILVER_KEY)
    touched = date_range(bronze, start, end).select(*key).union(date_range(old, start, end).select(*key)).distinct()
    again = silver_events(bronze.join(touched, key, "left_semi"))
    kept = old.join(touched, key, "left_anti").select(*again.columns)
    with in_pieces(spark, bronze.count() + old.count()):
        return _replace(spark, kept.unionByName(again), layout.silver, layout, swap)


def silver_increment(spark: SparkSession, layout: schemas.Layout, since: str, swap: bool = False, by_date: bool = False) -> int:
    """Silver after new Bronze rows with ingest dates from ``since`` on: the
    newest per key among old Silver and the new rows.  Reads only those dates
    of Bronze; equals the full rebuild, since a key's offset and partition
    never change and the ingest time decides.

    ``by_date`` rewrites only the dates that change (file tables; not with
    ``swap``) and returns the rows of those."""
    configure(spark)
    _check_by_date(layout, swap, by_date)
    old, late = spark.table(layout.silver), date_range(spark.table(layout.accepted), since)
    new = silver_events(late)

    def merged(old: DataFrame, new: DataFrame) -> DataFrame:
        return latest_by(old.select(*new.columns).unionByName(new), SILVER_KEY, newest_first("ingested_at_utc"))

    with in_pieces(spark, old.count() + late.count()):
        if by_date:
            return _replace_touched(spark, layout.silver, SILVER_KEY, new, merged)
        return _replace(spark, merged(old, new), layout.silver, layout, swap)


def _check_by_date(layout: schemas.Layout, swap: bool, by_date: bool) -> None:
    if by_date and (swap or layout.fmt not in FILE_FORMATS):
        raise ValueError("only the dates of a plain file table can be replaced")


def gold_rebuild(spark: SparkSession, layout: schemas.Layout, swap: bool = False) -> int:
    """Gold job: full rebuild from Silver.  A per-date overwrite would be
    wrong: when a key's newest row moves to another date, the old row would
    stay behind in its old partition."""
    configure(spark)
    silver = spark.table(layout.silver)
    with in_pieces(spark, silver.count()):
        return _rebuild(current_status(silver), layout.gold, layout, swap)


def gold_increment(spark: SparkSession, layout: schemas.Layout, since: str, swap: bool = False, by_date: bool = False) -> int:
    """Gold after new Silver rows with ingest dates from ``since`` on: the
    newest per key among old Gold and those rows.  Equals the full rebuild.
    ``by_date`` as in ``silver_increment``."""
    configure(spark)
    _check_by_date(layout, swap, by_date)
    old, new = spark.table(layout.gold), date_range(spark.table(layout.silver), since)
    with in_pieces(spark, old.count() + new.count()):
        if by_date:
            return _replace_touched(spark, layout.gold, GOLD_KEY, latest_by(new, GOLD_KEY, newest_first(*GOLD_ORDER)), merged_status)
        return _replace(spark, merged_status(old, new), layout.gold, layout, swap)


def replay(
    spark: SparkSession, layout: schemas.Layout, start: str | None = None, end: str | None = None, swap: bool = False
) -> tuple[int, int]:
    """R2: rebuild Silver and Gold from stored Bronze only.  Bounds limit the
    rebuild to what those ingest dates touch (see ``silver_rebuild``); Gold
    is always made from all of Silver."""
    return silver_rebuild(spark, layout, start, end, swap), gold_rebuild(spark, layout, swap=swap)
