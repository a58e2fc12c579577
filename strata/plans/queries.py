"""The registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input
tables.  Results are passed through ``wall_clock`` (UTC timestamps without
zone, text arrays joined with '; ') so they compare directly with the
oracle SQL in ``strata.plans.oracles``.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.columns import wall_clock
from strata.operators import bronze, envelope, gold, publish, quota, serving, silver
from strata.operators.latest import latest_by, newest_first
from strata.plans import inputs, medallion, runs
from strata.session import run_dir
from strata.sinks import jsonl
from strata.sources import messages, transport
from strata.streaming import arrival_stream, bronze_stream, quota_stream
from strata.streaming.metrics import SinkRows

Query = Callable[[SparkSession, str], DataFrame]


# The offset bounds of the bounded scan, by partition.
BOUNDED_START = {"0": 100, "2": 40}
BOUNDED_END = {"0": 700, "1": 500}


def transport_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic stored Kafka-shaped, read back earliest -> latest."""
    path = f"{run_dir(spark, 'topic')}/topic"
    inputs.topic(spark, sf_dir).write.parquet(path)
    return wall_clock(transport.read_topic(spark, messages.TOPIC, "parquet", path))


def transport_scan_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored topic between per-partition offsets (start inclusive,
    end exclusive); partitions not named are unbounded."""
    path = f"{run_dir(spark, 'topic')}/topic"
    inputs.topic(spark, sf_dir).write.parquet(path)
    start, end = ({messages.TOPIC: b} for b in (BOUNDED_START, BOUNDED_END))
    return wall_clock(transport.read_topic(spark, messages.TOPIC, "parquet", path, start, end))


def transport_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1."""
    return wall_clock(envelope.transport_columns(inputs.topic(spark, sf_dir)))


def envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed fields, plus whether the text was corrupt or empty."""
    parsed = envelope.parse_envelope(envelope.transport_columns(inputs.topic(spark, sf_dir)))
    e = F.col("envelope")
    return wall_clock(
        parsed.select(
            *schemas.TRANSPORT_KEY,
            *[e[f.name].alias(f.name) for f in schemas.ENVELOPE.fields],
            e[schemas.CORRUPT_FIELD].isNotNull().alias("corrupt_record"),
            e.isNull().alias("envelope_is_null"),
        )
    )


def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 over every delivery (clock = delivery time)."""
    v = inputs.validated_all(spark, sf_dir)
    return wall_clock(v.select(*schemas.TRANSPORT_KEY, "ingested_at_utc", schemas.PARTITION_COLUMN, "idempotency_key"))


def business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4."""
    parsed = envelope.parse_envelope(envelope.transport_columns(inputs.topic(spark, sf_dir)))
    return envelope.business_key(parsed).select(*schemas.TRANSPORT_KEY, "business_key")


def bronze_row_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8."""
    return wall_clock(bronze.flat_rows(inputs.validated_first(spark, sf_dir)))


def bronze_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + F5."""
    return wall_clock(bronze.accepted_records(inputs.validated_first(spark, sf_dir)))


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + F5."""
    return wall_clock(bronze.quarantine_records(inputs.validated_first(spark, sf_dir)))


def validation_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """first failing rule per message (null when valid)."""
    return inputs.validated_first(spark, sf_dir).select(*schemas.TRANSPORT_KEY, "validation_reason")


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every failing rule per message."""
    v = inputs.validated_first(spark, sf_dir)
    return wall_clock(
        v.select(*schemas.TRANSPORT_KEY, "validation_errors", F.size("validation_errors").alias("error_count"))
    )


def split_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1."""
    return bronze.split_conservation(inputs.validated_first(spark, sf_dir))


def silver_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 over Bronze rows of every delivery."""
    return wall_clock(silver.eligible(inputs.bronze_raw(spark, sf_dir)))


def silver_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9."""
    parsed = silver.with_payload(silver.eligible(inputs.bronze_raw(spark, sf_dir)))
    return wall_clock(
        parsed.select("idempotency_key", "ingested_at_utc", "kafka_offset", "api_status", "api_response_length", "api_warning")
    )


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 -> P9 -> W1 -> P10."""
    return wall_clock(silver.silver_events(inputs.bronze_raw(spark, sf_dir)))


def status_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 on every Silver event."""
    s = gold.with_status_category(silver.silver_events(inputs.bronze_raw(spark, sf_dir)))
    return s.select("idempotency_key", "api_status", "api_warning", "status_category")


def gold_current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 -> P12 -> P11 (window form).  The flagship query."""
    return wall_clock(gold.current_status(silver.silver_events(inputs.bronze_raw(spark, sf_dir))))


def gold_via_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 as a partial aggregate (max_by); must equal gold_current_status."""
    return wall_clock(gold.current_status(silver.silver_events(inputs.bronze_raw(spark, sf_dir)), method="max_by"))


def first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 (batch): one row per transport key over every delivery; the
    earliest ingest wins."""
    first = bronze.first_arrival(inputs.validated_all(spark, sf_dir))
    return wall_clock(
        first.select(
            *schemas.TRANSPORT_KEY, "idempotency_key", "ingested_at_utc", "kafka_timestamp_utc", "validation_reason"
        )
    )


def message_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """outcome of every delivery, redeliveries included."""
    return wall_clock(bronze.message_outcome(inputs.validated_all(spark, sf_dir)))


# The serving filters used by the registered queries.
SERVE_LEAGUE = 3
SERVE_SEASON = 2021


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.current_status(silver.silver_events(inputs.bronze_raw(spark, sf_dir)))


def serving_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 (no filter) + P13."""
    return wall_clock(serving.current_statuses(_gold(spark, sf_dir)))


def serving_by_league(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 (league) + P13."""
    return wall_clock(serving.current_statuses(_gold(spark, sf_dir), league_id=SERVE_LEAGUE))


def serving_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 (season) + P13."""
    return wall_clock(serving.current_statuses(_gold(spark, sf_dir), season=SERVE_SEASON))


def serving_by_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 (league AND season) + P13."""
    return wall_clock(serving.current_statuses(_gold(spark, sf_dir), league_id=SERVE_LEAGUE, season=SERVE_SEASON))


def serving_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served null policy."""
    return wall_clock(serving.served_rows(serving.current_statuses(_gold(spark, sf_dir))))


RECENT_ROWS = 5


def recent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows of each Bronze output (a top-k report)."""
    v = inputs.validated_first(spark, sf_dir)
    key = list(schemas.TRANSPORT_KEY)
    acc = serving.most_recent(bronze.accepted_records(v), RECENT_ROWS, ["ingested_at_utc"], key).select(
        F.lit("accepted").alias("output"), *key, F.col("ingested_at_utc").alias("at_utc"), "raw_message_json"
    )
    qua = serving.most_recent(bronze.quarantine_records(v), RECENT_ROWS, ["quarantined_at_utc"], key).select(
        F.lit("quarantine").alias("output"), *key, F.col("quarantined_at_utc").alias("at_utc"), "raw_message_json"
    )
    return wall_clock(acc.unionByName(qua))


def recent_rows_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over the Bronze tables: only the newest dates are read."""
    layout, root = runs.fresh_layout(spark, "recent")
    _ingest_first(spark, sf_dir, layout)
    key = list(schemas.TRANSPORT_KEY)
    parts = []
    for output, table, at in (("accepted", layout.accepted, "ingested_at_utc"), ("quarantine", layout.quarantine, "quarantined_at_utc")):
        newest = serving.most_recent_stored(spark, table, RECENT_ROWS, [at], key)
        parts.append(newest.select(F.lit(output).alias("output"), *key, F.col(at).alias("at_utc"), "raw_message_json"))
    return wall_clock(runs.result(spark, layout, root, parts[0].unionByName(parts[1])))


def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 at scale: newest order per customer (order date, then key)."""
    orders = inputs.table(spark, sf_dir, "orders")
    return wall_clock(latest_by(orders, ["o_custkey"], newest_first("o_orderdate", "o_orderkey")))


def _built_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = inputs.events(spark, sf_dir)
    # An error event stands for a call made without a configured key: no
    # payload, so the synthetic warning payload is used.
    payload = F.when(
        F.col("event_type") != "error",
        F.to_json(F.struct(F.col("event_type").alias("status"),
                           F.get_json_object("props", "$.k").cast("int").alias("response_length"))),
    )
    env = envelope.build_envelope(
        F.col("user_id") % messages.LEAGUES + 1,
        F.lit(messages.FIRST_SEASON) + F.col("user_id") % messages.SEASONS,
        payload,
        correlation_id=F.concat(F.lit("c-"), F.col("event_id").cast("string")),
        fetched_at=F.col("ts").cast("timestamp"),
    )
    return ev.select("event_id", env.alias("envelope"))


def envelope_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 + P16: envelopes built from (league, season, payload)."""
    built = _built_envelopes(spark, sf_dir)
    return wall_clock(built.select("event_id", "envelope.*"))


def envelope_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: envelopes serialised for the topic (null key, JSON value)."""
    built = _built_envelopes(spark, sf_dir)
    return wall_clock(envelope.to_transport(built, "envelope", messages.TOPIC, passthrough=("event_id",)))


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")


def quota_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 calls of each UTC day are admitted."""
    admitted = quota.admit_calls(_calls(spark, sf_dir), "ts", "event_id")
    return admitted.select("event_id", "call_date", "call_number", "admitted")


def _completed() -> Column:
    # A call completes ``value`` seconds after it starts (fixture rule).
    return F.timestamp_micros(F.unix_micros(F.col("ts")) + F.round(F.col("value") * 1_000_000).cast("long"))


def quota_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: one ledger row per UTC day."""
    return wall_clock(quota.call_ledger(_calls(spark, sf_dir), "ts", "event_id", _completed()))


# --- queries that run the layer jobs against tables ---------------------------


def _ingest_first(spark: SparkSession, sf_dir: str, layout) -> medallion.BronzeRun:
    """Bronze job over the topic (first deliveries; ingest time = ``ts``)."""
    return medallion.bronze_ingest(
        spark, inputs.topic(spark, sf_dir, with_clock=True), layout,
        clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,),
    )


def _ingest_raw(spark: SparkSession, sf_dir: str, layout) -> medallion.BronzeRun:
    """Every delivery appended as it came (no A3): the Bronze history that
    Silver must de-duplicate."""
    return medallion.bronze_ingest(
        spark, messages.deliveries(inputs.events(spark, sf_dir)), layout,
        clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,), dedupe_in_batch=False,
    )


def bronze_append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 + K1 + J1 + R3: create the tables, ingest the topic, then ingest
    every delivery again (the whole topic plus redeliveries).  The second
    run appends nothing; the accepted table is returned."""
    layout, root = runs.fresh_layout(spark, "append")
    _ingest_first(spark, sf_dir, layout)
    again = medallion.bronze_ingest(
        spark, messages.deliveries(inputs.events(spark, sf_dir)), layout,
        clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,),
    )
    if again.accepted_rows or again.quarantine_rows:
        raise AssertionError(f"re-run appended rows: {again}")
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.accepted)))


def bronze_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + R3: a first run over half the offsets commits; the next one ends
    between its two appends; a third resumes from the first one's commit.  Both
    outputs hold every record once."""
    layout, root = runs.fresh_layout(spark, "resume")
    path = f"{root}/topic"
    topic = inputs.topic(spark, sf_dir, with_clock=True)
    topic.write.parquet(path)
    stored = spark.read.schema(topic.schema).parquet(path)
    middle = stored.groupBy("partition").agg(F.expr("(min(offset) + max(offset)) div 2").alias("at")).collect()  # a row a partition
    half = {messages.TOPIC: {str(r.partition): int(r.at) for r in middle}}
    # A view takes no rows: the second append to it fails.
    broken = dataclasses.replace(layout, quarantine_object="no_quarantine")
    spark.sql(f"CREATE VIEW {broken.quarantine} AS SELECT * FROM {layout.quarantine}")

    def ingest(target: schemas.Layout, ending: dict | str = "latest") -> None:
        starting = medallion.resume_offsets(spark, layout, messages.TOPIC) or "earliest"
        records = transport.read_topic(spark, messages.TOPIC, "parquet", path, starting, ending, schema=topic.schema)
        medallion.bronze_ingest(spark, records, target, clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,))

    ingest(layout, half)
    committed = medallion.resume_offsets(spark, layout, messages.TOPIC)
    try:
        ingest(broken)
    except AnalysisException:
        pass
    else:
        raise AssertionError("the broken run ended well")
    if medallion.resume_offsets(spark, layout, messages.TOPIC) != committed:
        raise AssertionError("the broken run moved the committed offsets")
    ingest(layout)
    key = list(schemas.TRANSPORT_KEY)
    accepted = spark.table(layout.accepted).select(F.lit("accepted").alias("output"), *key, F.lit(None).cast("string").alias("reason"))
    quarantine = spark.table(layout.quarantine).select(F.lit("quarantine").alias("output"), *key, "reason")
    return runs.result(spark, layout, root, accepted.unionByName(quarantine))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 + A1: rows written per sink, counted during each write."""
    layout, root = runs.fresh_layout(spark, "metrics")
    b = _ingest_first(spark, sf_dir, layout)
    n_silver = medallion.silver_rebuild(spark, layout)
    n_gold = medallion.gold_rebuild(spark, layout)
    rows = [("bronze_accepted", b.accepted_rows), ("bronze_quarantine", b.quarantine_rows),
            ("silver", n_silver), ("gold", n_gold)]
    return runs.result(spark, layout, root, spark.createDataFrame(rows, "sink string, rows_written long"))


def silver_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: Silver rebuilt from the Bronze table, twice (overwrite is
    idempotent); the stored table is returned."""
    layout, root = runs.fresh_layout(spark, "silver")
    _ingest_raw(spark, sf_dir, layout)
    medallion.silver_rebuild(spark, layout)
    medallion.silver_rebuild(spark, layout)
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.silver)))


def gold_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: Gold rebuilt from the Silver table; the stored table is returned."""
    layout, root = runs.fresh_layout(spark, "gold")
    _ingest_raw(spark, sf_dir, layout)
    medallion.silver_rebuild(spark, layout)
    medallion.gold_rebuild(spark, layout)
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.gold)))


def replay_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: Silver and Gold rebuilt from stored Bronze only, the whole range."""
    layout, root = runs.fresh_layout(spark, "replay")
    _ingest_raw(spark, sf_dir, layout)
    medallion.replay(spark, layout)
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.gold)))


def _middle_day(spark: SparkSession, sf_dir: str) -> str:
    """The day halfway between the first and the last event."""
    days = inputs.events(spark, sf_dir).agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    return days.select(F.expr("date_add(lo, CAST(datediff(hi, lo) div 2 AS INT))").cast("string")).first()[0]


def replay_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 with bounds: after a full rebuild, the range from the middle day on
    is replayed; Silver must be what the full rebuild made."""
    layout, root = runs.fresh_layout(spark, "bounded")
    _ingest_raw(spark, sf_dir, layout)
    medallion.silver_rebuild(spark, layout)
    medallion.replay(spark, layout, start=_middle_day(spark, sf_dir))
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.silver)))


def _two_ingests(spark: SparkSession, sf_dir: str, layout, by_date: bool = False) -> None:
    """Bronze in two runs, split at the middle day; Silver and Gold rebuilt
    after the first and brought forward after the second."""
    middle = _middle_day(spark, sf_dir)
    every = messages.deliveries(inputs.events(spark, sf_dir))
    late = F.to_date(messages.DELIVERY_CLOCK) >= F.lit(middle).cast("date")
    for part, rows in enumerate((every.filter(~late), every.filter(late))):
        medallion.bronze_ingest(spark, rows, layout, clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,), dedupe_in_batch=False)
        if part == 0:
            medallion.silver_rebuild(spark, layout)
            medallion.gold_rebuild(spark, layout)
    medallion.silver_increment(spark, layout, since=middle, by_date=by_date)
    medallion.gold_increment(spark, layout, since=middle, by_date=by_date)


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 as an increment: redeliveries that come in the second run are
    dropped by J1 there, so the first arrivals make up Silver."""
    layout, root = runs.fresh_layout(spark, "silver_inc")
    _two_ingests(spark, sf_dir, layout)
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.silver)))


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 as an increment over old Gold and new Silver."""
    layout, root = runs.fresh_layout(spark, "gold_inc")
    _two_ingests(spark, sf_dir, layout)
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.gold)))


def silver_incremental_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + K3: the increment that rewrites only the dates it touches."""
    layout, root = runs.fresh_layout(spark, "silver_dates")
    _two_ingests(spark, sf_dir, layout, by_date=True)
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.silver)))


def gold_incremental_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + K3: old places of keys that moved to another date are emptied."""
    layout, root = runs.fresh_layout(spark, "gold_dates")
    _two_ingests(spark, sf_dir, layout, by_date=True)
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.gold)))


def _published(spark: SparkSession, sf_dir: str):
    layout, root = runs.fresh_layout(spark, "publish")
    _ingest_raw(spark, sf_dir, layout)
    medallion.silver_rebuild(spark, layout)
    medallion.gold_rebuild(spark, layout)
    target = f"{root}/published/current_league_status"
    written = publish.publish_snapshot(spark.table(layout.gold), "parquet", {"path": target})
    copy = spark.read.parquet(target)
    if written != copy.count():
        raise AssertionError(f"{written} rows counted")
    return runs.result(spark, layout, root, spark.table(layout.gold)), copy


def publish_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + P17: full-refresh copy of Gold in the published shape."""
    _, target = _published(spark, sf_dir)
    return target


def publish_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + X2: source and published copy agree on count and rows."""
    source, target = _published(spark, sf_dir)
    return publish.reconcile(source, target)


def publish_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + X2 by checksum buckets, over every Bronze record and a copy with
    planted faults: some records lost, some stored twice, some texts changed."""
    records = inputs.validated_first(spark, sf_dir).select(*schemas.TRANSPORT_KEY, "kafka_timestamp_utc", "raw_message_json")
    path = f"{run_dir(spark, 'differences')}/copy"
    at = F.col("kafka_offset")
    faulty = records.filter(at % 97 != 0).withColumn("raw_message_json", F.when(at % 101 == 0, F.lit(None)).otherwise(F.col("raw_message_json")))
    copies = F.when(at % 89 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    publish.publish_snapshot(faulty.withColumn("_copy", F.explode(copies)).drop("_copy"), "parquet", {"path": path})
    return publish.reconcile_buckets(records, spark.read.parquet(path))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + S5: quarantine rows written as JSON lines and read back."""
    root = run_dir(spark, "jsonl")
    lines = jsonl.quarantine_lines(bronze.quarantine_records(inputs.validated_first(spark, sf_dir)))
    jsonl.append_jsonl(lines, f"{root}/quarantine")
    return wall_clock(transport.read_quarantine_jsonl(spark, f"{root}/quarantine"))


def jsonl_accepted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + S5: accepted rows (18 fields) written as JSON lines and read back."""
    root = run_dir(spark, "jsonl")
    jsonl.append_jsonl(bronze.flat_rows(inputs.validated_first(spark, sf_dir)), f"{root}/accepted")
    return wall_clock(transport.read_bronze_jsonl(spark, f"{root}/accepted"))


def envelope_default_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fn new GUID: envelopes built without a correlation id get one each;
    how many have the shape of a GUID and how many differ."""
    ev = inputs.events(spark, sf_dir)
    env = envelope.build_envelope(F.col("user_id") % messages.LEAGUES + 1, F.lit(messages.FIRST_SEASON), F.lit("{}"), fetched_at=F.col("ts").cast("timestamp"))
    ids = ev.select(env["CorrelationId"].alias("id"))
    return ids.agg(
        F.count("id").alias("envelopes"),
        F.count_if(F.col("id").rlike("^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$")).alias("guids"),
        F.countDistinct("id").alias("distinct_ids"),
    )


def stream_topic_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream by pattern over a folder with two topics whose names
    begin alike; the pattern must match the whole name."""
    root = run_dir(spark, "pattern")
    topic = inputs.topic(spark, sf_dir)
    topic.write.parquet(f"{root}/topic")
    topic.withColumn("topic", F.concat("topic", F.lit(".backup"))).write.mode("append").parquet(f"{root}/topic")
    stream = transport.read_topic_stream(spark, "raw[.]ingestion[.]dev", "parquet", f"{root}/topic", schema=topic.schema)
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out")
    q.awaitTermination()
    return wall_clock(spark.read.parquet(f"{root}/out"))


def stream_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 from the latest offsets: the topic holds the first half of all
    partitions but the last one when the stream is set up; the rest and the new
    partition come in two slices, with a restart between them.  Nothing stored
    before the start is read."""
    root = run_dir(spark, "latest")
    topic = inputs.topic(spark, sf_dir)
    topic.write.parquet(f"{root}/all")
    every = spark.read.schema(topic.schema).parquet(f"{root}/all")
    spans = every.groupBy("partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    middle = F.expr("(low + high) div 2")
    fresh = F.col("partition") == F.lit(messages.PARTITIONS - 1)
    placed = every.join(F.broadcast(spans), "partition")  # a row a partition
    slices = placed.withColumn("_slice", F.when((F.col("offset") < middle) & ~fresh, 0).when(F.col("offset") % 2 == 0, 1).otherwise(2))
    for number in range(3):
        slices.filter(F.col("_slice") == number).select(*topic.columns).write.mode("append").parquet(f"{root}/topic")
        stream = transport.read_topic_stream(
            spark, "raw[.]ingestion[.]dev", "parquet", f"{root}/topic", "latest", {"maxFilesPerTrigger": "1000"}, topic.schema, f"{root}/start")
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(
            f"{root}/out").awaitTermination()
    return wall_clock(spark.read.schema(topic.schema).parquet(f"{root}/out"))


def stream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 + K2: both streams into the layer tables."""
    layout, root = runs.fresh_layout(spark, "tables")
    stream = _stream_source(spark, sf_dir, root, redeliver=False)
    for q in bronze_stream.bronze_stream_tables(stream, layout, f"{root}/checkpoints", clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,)):
        q.awaitTermination()
    key = list(schemas.TRANSPORT_KEY)
    both = spark.table(layout.accepted).select(*key, F.lit(None).cast("string").alias("reason"))
    return runs.result(spark, layout, root, both.unionByName(spark.table(layout.quarantine).select(*key, "reason")))


def _stream_source(spark: SparkSession, sf_dir: str, root: str, redeliver: bool) -> DataFrame:
    """Write the topic as files (first deliveries, then redeliveries) and
    open a file stream over them."""
    topic = inputs.topic(spark, sf_dir, with_clock=True)
    path = f"{root}/topic"
    topic.write.mode("append").parquet(path)
    if redeliver:
        messages.redeliveries(topic).write.mode("append").parquet(path)
    schema = topic.schema
    return transport.read_topic_stream(
        spark, messages.TOPIC.replace(".", "[.]"), "parquet", path, options={"maxFilesPerTrigger": "8"}, schema=schema
    )


def stream_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: rows that each stream wrote, summed over its micro-batches."""
    listener = SinkRows()
    spark.streams.addListener(listener)
    try:
        _bronze_streams(spark, sf_dir, listener)
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame(sorted(listener.totals().items()), "sink string, rows_written long")


def quota_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 as calls arrive: four slices of the day's calls in order of time, the
    stream stopped after two of them and started again on its checkpoint."""
    root = run_dir(spark, "quota")
    calls = _calls(spark, sf_dir).select("event_id", "ts")
    cuts = [c for c in calls.select(F.unix_micros("ts").alias("t")).approxQuantile("t", [0.25, 0.5, 0.75], 0.01)]
    place = sum((F.when(F.unix_micros("ts") > F.lit(int(c)), 1).otherwise(0) for c in cuts), F.lit(0))
    for slice_ in range(4):
        calls.filter(place == slice_).write.mode("append").parquet(f"{root}/calls")
        if slice_ in (1, 3):
            stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1_000).parquet(f"{root}/calls")
            answered = quota_stream.reserve_calls(stream, "ts", "event_id")
            answered.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoint").trigger(
                availableNow=True).start(f"{root}/answers").awaitTermination()
    out = spark.read.schema("event_id long, ts timestamp, call_date date, call_number int, admitted boolean").parquet(f"{root}/answers")
    return out.select("event_id", "call_date", "call_number", "admitted")


def _bronze_streams(spark: SparkSession, sf_dir: str, listener: SinkRows | None = None) -> tuple[str, str]:
    root = run_dir(spark, "stream")
    stream = _stream_source(spark, sf_dir, root, redeliver=False)
    accepted, quarantine = f"{root}/accepted", f"{root}/quarantine"
    queries = bronze_stream.bronze_streams(
        stream, accepted, quarantine, f"{root}/checkpoints",
        clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,),
    )
    for q in queries:
        q.awaitTermination()
    if listener is not None:
        listener.wait(queries)
    return accepted, quarantine


def stream_bronze_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2/S3 + K2 + ST1 (+ P6): the accepted stream; league and season stay
    integers in the streaming design."""
    accepted, _ = _bronze_streams(spark, sf_dir)
    return wall_clock(spark.read.parquet(accepted))


def stream_bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 + K2: the quarantine stream (same rule column as batch)."""
    _, quarantine = _bronze_streams(spark, sf_dir)
    return wall_clock(spark.read.parquet(quarantine))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: a stream with redeliveries; every key lands once."""
    layout, root = runs.fresh_layout(spark, "dedup")
    stream = _stream_source(spark, sf_dir, root, redeliver=True)
    q = bronze_stream.dedup_stream(
        stream, layout, f"{root}/checkpoints/dedup",
        clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,),
    )
    q.awaitTermination()
    return wall_clock(runs.result(spark, layout, root, spark.table(layout.accepted)))


def stream_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 in a stream: half of the messages, then, after a restart, the other
    half and all redeliveries."""
    layout, root = runs.fresh_layout(spark, "outcomes")
    topic = inputs.topic(spark, sf_dir, with_clock=True)
    later = messages.redeliveries(topic).unionByName(topic.filter(F.col("offset") % 2 == 1))
    for slice_ in (topic.filter(F.col("offset") % 2 == 0), later):
        slice_.write.mode("append").parquet(f"{root}/topic")
        stream = transport.read_topic_stream(spark, messages.TOPIC.replace(".", "[.]"), "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1000"}, schema=topic.schema)
        bronze_stream.outcome_stream(
            stream, layout, f"{root}/outcomes", f"{root}/checkpoint",
            clock=F.col(messages.DELIVERY_CLOCK), passthrough=(messages.DELIVERY_CLOCK,),
        ).awaitTermination()
    return wall_clock(runs.result(spark, layout, root, spark.read.parquet(f"{root}/outcomes").drop("batch_id")))


def stream_first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + ST2 with keyed state: a third of the first deliveries comes after
    all others and after their redeliveries; every offset is kept once."""
    root = run_dir(spark, "arrivals")
    topic = inputs.topic(spark, sf_dir, with_clock=True)
    again, late = messages.redeliveries(topic), F.col("offset") % 3 == 0
    slices = (topic.filter(~late), again.filter(~late), topic.filter(late), again.filter(late))
    for number, slice_ in enumerate(slices):
        slice_.write.mode("append").parquet(f"{root}/topic")
        if number % 2:
            stream = transport.read_topic_stream(spark, messages.TOPIC.replace(".", "[.]"), "parquet", f"{root}/topic", options={"maxFilesPerTrigger": "1000"}, schema=topic.schema)
            first = arrival_stream.first_deliveries(stream, (messages.DELIVERY_CLOCK, "timestamp", "value"))
            validated = envelope.prepare(first, F.col(messages.DELIVERY_CLOCK), (messages.DELIVERY_CLOCK,))
            kept = validated.select(*schemas.TRANSPORT_KEY, "idempotency_key", "ingested_at_utc", "kafka_timestamp_utc", "validation_reason")
            kept.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoint").trigger(
                availableNow=True).start(f"{root}/out").awaitTermination()
    return wall_clock(spark.read.schema(kept.schema).parquet(f"{root}/out"))


QUERIES: dict[str, Query] = {
    "transport_scan": transport_scan,
    "transport_scan_bounded": transport_scan_bounded,
    "transport_projection": transport_projection,
    "envelope_parse": envelope_parse,
    "derived_columns": derived_columns,
    "business_key": business_key,
    "bronze_row_flat": bronze_row_flat,
    "bronze_accepted": bronze_accepted,
    "bronze_quarantine": bronze_quarantine,
    "validation_reason": validation_reason,
    "validation_errors": validation_errors,
    "split_conservation": split_conservation,
    "silver_eligible": silver_eligible,
    "silver_payload": silver_payload,
    "silver_events": silver_events,
    "status_category": status_category,
    "gold_current_status": gold_current_status,
    "gold_via_max_by": gold_via_max_by,
    "first_arrival": first_arrival,
    "message_outcome": message_outcome,
    "serving_all": serving_all,
    "serving_by_league": serving_by_league,
    "serving_by_season": serving_by_season,
    "serving_by_both": serving_by_both,
    "serving_nulls": serving_nulls,
    "recent_rows": recent_rows,
    "recent_rows_stored": recent_rows_stored,
    "latest_order_per_customer": latest_order_per_customer,
    "envelope_build": envelope_build,
    "envelope_publish": envelope_publish,
    "quota_admission": quota_admission,
    "quota_ledger": quota_ledger,
    "bronze_append_idempotent": bronze_append_idempotent,
    "bronze_resume": bronze_resume,
    "run_metrics": run_metrics,
    "stream_run_metrics": stream_run_metrics,
    "quota_online": quota_online,
    "silver_rebuild": silver_rebuild,
    "gold_rebuild": gold_rebuild,
    "replay_range": replay_range,
    "replay_bounded": replay_bounded,
    "silver_incremental": silver_incremental,
    "gold_incremental": gold_incremental,
    "silver_incremental_by_date": silver_incremental_by_date,
    "gold_incremental_by_date": gold_incremental_by_date,
    "publish_snapshot": publish_snapshot,
    "publish_reconcile": publish_reconcile,
    "publish_differences": publish_differences,
    "jsonl_roundtrip": jsonl_roundtrip,
    "jsonl_accepted_roundtrip": jsonl_accepted_roundtrip,
    "envelope_default_id": envelope_default_id,
    "stream_bronze_accepted": stream_bronze_accepted,
    "stream_bronze_quarantine": stream_bronze_quarantine,
    "stream_dedup": stream_dedup,
    "stream_outcome": stream_outcome,
    "stream_first_arrival": stream_first_arrival,
    "stream_topic_pattern": stream_topic_pattern,
    "stream_from_latest": stream_from_latest,
    "stream_tables": stream_tables,
}
