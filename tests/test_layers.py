"""Tables, idempotent re-runs, Silver and Gold semantics, replay."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import TOPIC, records, text
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import bronze, gold, offsets, silver
from strata.operators.envelope import prepare
from strata.plans import medallion, runs


def bronze_rows(spark, values, clock_shift_days=0, start=0):
    v = prepare(records(spark, values, start=start),
                clock=F.col("kafka_timestamp_utc") + F.expr(f"INTERVAL {clock_shift_days} DAY"))
    return bronze.accepted_records(v)


def test_ddl_matches_schema():
    ddl = schemas.create_table_ddl("bronze.raw_ingestion_events", schemas.BRONZE_ACCEPTED)
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS bronze.raw_ingestion_events (")
    assert "`validation_errors`" not in ddl and "PARTITIONED BY (event_date)" in ddl
    assert ddl.index("`quarantined` BOOLEAN") < ddl.index("`event_date` DATE")
    q = schemas.create_table_ddl("b.q", schemas.BRONZE_QUARANTINE)
    assert "`validation_errors` ARRAY<STRING>" in q


def test_layout_names():
    assert schemas.Layout().accepted == "bronze.raw_ingestion_events"
    assert schemas.Layout(catalog="dev").gold == "dev.gold.current_league_status"


def test_bronze_job_second_run_adds_nothing(spark):
    layout, _ = runs.fresh_layout(spark, "t-rerun")
    topic = records(spark, [text(), "garbage", text(Source=""), text()])
    first = medallion.bronze_ingest(spark, topic, layout, clock=F.col("kafka_timestamp_utc"))
    assert (first.accepted_rows, first.quarantine_rows) == (2, 2)
    again = medallion.bronze_ingest(spark, topic, layout, clock=F.col("kafka_timestamp_utc") + F.expr("INTERVAL 1 DAY"))
    assert (again.accepted_rows, again.quarantine_rows) == (0, 0)
    assert spark.table(layout.accepted).count() == 2
    assert spark.table(layout.quarantine).count() == 2
    # A batch that extends the topic appends only the new offset.
    extended = topic.union(records(spark, [text()], start=4))
    third = medallion.bronze_ingest(spark, extended, layout, clock=F.col("kafka_timestamp_utc"))
    assert (third.accepted_rows, third.quarantine_rows) == (1, 0)


def test_in_batch_duplicate_first_arrival_wins(spark):
    layout, _ = runs.fresh_layout(spark, "t-dup")
    one = records(spark, [text(CorrelationId="first")])
    two = records(spark, [text(CorrelationId="second")])
    v = prepare(one, clock=F.col("kafka_timestamp_utc")).unionByName(
        prepare(two, clock=F.col("kafka_timestamp_utc") + F.expr("INTERVAL 1 HOUR")))
    run = medallion.bronze_write(spark, v, layout)
    assert run.accepted_rows == 1
    assert spark.table(layout.accepted).first().correlation_id == "first"


def test_empty_input(spark):
    layout, _ = runs.fresh_layout(spark, "t-empty")
    empty = records(spark, [])
    assert medallion.bronze_ingest(spark, empty, layout, clock=F.col("kafka_timestamp_utc")) == medallion.BronzeRun(0, 0)
    assert medallion.silver_rebuild(spark, layout) == 0
    assert medallion.gold_rebuild(spark, layout) == 0


def test_missing_key_columns_raise_unless_opted_in(spark):
    df = bronze_rows(spark, [text()])
    smoke = spark.createDataFrame([("x",)], "payload_json string")
    with pytest.raises(ValueError):
        bronze.remove_existing_offsets(df, smoke)
    assert bronze.remove_existing_offsets(df, smoke, allow_missing_key=True).count() == 1


def test_offset_log_is_a_row_per_gap_whatever_the_history(spark):
    layout, _ = runs.fresh_layout(spark, "t-ranges")
    clock = F.col("kafka_timestamp_utc")
    for start in (0, 10, 20, 40):
        medallion.bronze_ingest(spark, records(spark, [text()] * 9 + ["garbage"], start=start), layout, clock=clock)
    log = sorted((r.low_offset, r.next_offset) for r in spark.table(layout.offsets).collect())
    assert log == [(0, 30), (40, 50)]
    run = medallion.bronze_ingest(spark, records(spark, [text()] * 14, start=28), layout, clock=clock)
    assert run == medallion.BronzeRun(10, 0)
    spark.catalog.refreshTable(layout.offsets)
    assert [(r.low_offset, r.next_offset) for r in spark.table(layout.offsets).collect()] == [(0, 50)]


@pytest.mark.parametrize("lost", [["offsets"], ["progress"], ["offsets", "progress"]])
def test_a_lost_log_is_made_from_what_is_stored(spark, lost):
    layout, _ = runs.fresh_layout(spark, "t-oldlog")
    topic = records(spark, [text(), "garbage", text()])
    medallion.bronze_ingest(spark, topic, layout, clock=F.col("kafka_timestamp_utc"))
    for name in lost:
        spark.sql(f"DROP TABLE {getattr(layout, name)}")
    assert medallion.bronze_ingest(spark, topic, layout, clock=F.col("kafka_timestamp_utc")) == medallion.BronzeRun(0, 0)
    assert spark.table(layout.offsets).count() == 1


def test_compacted_runs_resume_at_the_same_offsets(spark, monkeypatch):
    layout, _ = runs.fresh_layout(spark, "t-compact")
    clock = F.col("kafka_timestamp_utc")
    for start in (0, 5, 10):
        medallion.bronze_ingest(spark, records(spark, [text()] * 5, start=start), layout, clock=clock)
    before = medallion.resume_offsets(spark, layout, TOPIC)
    assert medallion.compact_runs(spark, layout) == 1
    assert medallion.resume_offsets(spark, layout, TOPIC) == before == {TOPIC: {"0": 15}}
    monkeypatch.setattr(medallion, "PROGRESS_ROWS", 1)
    assert medallion.bronze_ingest(spark, records(spark, [text()] * 5, start=13), layout, clock=clock) == medallion.BronzeRun(3, 0)


def test_ranges_equal_sets_of_offsets(spark, monkeypatch):
    monkeypatch.setattr(offsets, "OFFSETS_PER_BUCKET", 7)
    monkeypatch.setattr(offsets, "OFFSETS_PER_PIECE", 5)
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), rnd.randrange(2), rnd.randrange(60)) for _ in range(150)] + [("a", 0, None)]
    keys = spark.createDataFrame(rows, "kafka_topic string, kafka_partition int, kafka_offset long")
    ranges = offsets.merged(offsets.islands(keys)).collect()
    held = sorted((r.kafka_topic, r.kafka_partition, o) for r in ranges for o in range(r.low_offset, r.next_offset))
    assert held == sorted({r for r in rows if r[2] is not None})
    starts = {(r.kafka_topic, r.kafka_partition, r.low_offset) for r in ranges}
    assert not starts & {(r.kafka_topic, r.kafka_partition, r.next_offset) for r in ranges}  # none touch
    batch = spark.createDataFrame([(t, p, o) for t in "abc" for p in (0, 1) for o in range(-3, 70)] + [("a", 0, None)], keys.schema)
    left = offsets.outside(batch, offsets.merged(offsets.islands(keys))).collect()
    want = [r for r in batch.collect() if tuple(r) not in set(held)]
    assert sorted(map(str, left)) == sorted(map(str, want))


def test_ranges_merge_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(offsets, "OFFSETS_PER_BUCKET", 7)
    rnd = random.Random(6)
    rows = []
    for _ in range(60):
        low = rnd.randrange(300)
        rows.append((rnd.choice("ab"), rnd.randrange(2), low, low + rnd.choice((1, 1, 2, 7, 30))))
    ranges = spark.createDataFrame(rows, schemas.STORED_OFFSETS)
    held = {(t, p, o) for t, p, low, end in rows for o in range(low, end)}
    want = [(t, p, o) for t, p, o in held if (t, p, o - 1) not in held]
    got = offsets.merged(ranges).collect()
    assert sorted((r.kafka_topic, r.kafka_partition, r.low_offset) for r in got) == sorted(want)
    assert {(r.kafka_topic, r.kafka_partition, o) for r in got for o in range(r.low_offset, r.next_offset)} == held


def test_the_offset_log_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(offsets, "OFFSETS_PER_BUCKET", 64)
    layout, _ = runs.fresh_layout(spark, "t-log")
    ranges = spark.range(0, 4000, 2).selectExpr("'t' AS kafka_topic", "0 AS kafka_partition", "id AS low_offset", "id + 1 AS next_offset")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        medallion._store(spark, layout, ranges, anew=True)
    finally:
        spark.conf.set(setting, before)
    spark.catalog.refreshTable(layout.offsets)
    assert spark.table(layout.offsets).count() == 2000
    assert len(spark.table(layout.offsets).inputFiles()) > 1  # one partition of the topic, yet not one task


def test_silver_redelivery_wins_and_key_is_unique(spark):
    first = bronze_rows(spark, [text(CorrelationId="a"), text(CorrelationId="b")])
    later = bronze_rows(spark, [text(CorrelationId="a2")], clock_shift_days=1)
    s = silver.silver_events(first.unionByName(later))
    rows = {r.idempotency_key: r for r in s.collect()}
    assert len(rows) == 2
    assert rows["raw.ingestion.test|0|0"].correlation_id == "a2"
    assert rows["raw.ingestion.test|0|0"].event_date == dt.date(2026, 4, 11)


def test_silver_eligibility_and_payload(spark):
    b = bronze_rows(spark, [
        text(EntityType="fixtures"),
        text(PayloadJson="not json"),
        text(PayloadJson='{"warning":"API key not configured"}'),
        text(PayloadJson='{"status":"ok","response_length":"abc"}'),
    ])
    rows = silver.silver_events(b).orderBy("idempotency_key").collect()
    assert len(rows) == 3  # the fixtures row is not eligible
    by_payload = {r.payload_json: r for r in rows}
    assert by_payload["not json"].api_status is None
    w = by_payload['{"warning":"API key not configured"}']
    assert (w.api_status, w.api_warning) == (None, "API key not configured")
    assert by_payload['{"status":"ok","response_length":"abc"}'].api_response_length is None
    assert [f.name for f in silver.silver_events(b).schema.fields] == [f.name for f in schemas.SILVER.fields]


def test_status_category(spark):
    b = bronze_rows(spark, [
        text(LeagueId=1, PayloadJson='{"warning":"API key not configured"}'),
        text(LeagueId=2, PayloadJson='{"status":"ok"}'),
        text(LeagueId=3, PayloadJson='{"status":" ","warning":"\\t"}'),
        text(LeagueId=4, PayloadJson='{"status":"ok","warning":""}'),
    ])
    g = {r.league_id: r.status_category for r in gold.current_status(silver.silver_events(b)).collect()}
    assert g == {1: "warning", 2: "ok", 3: "unknown", 4: "ok"}


def test_gold_latest_per_key_both_forms(spark):
    b = bronze_rows(spark, [
        text(LeagueId=1, CorrelationId="old", FetchedAtUtc="2026-04-10T10:00:00Z"),
        text(LeagueId=1, CorrelationId="new", FetchedAtUtc="2026-04-10T11:00:00Z"),
        text(LeagueId=2, CorrelationId="x"),
        text(LeagueId=1, LeagueName="Renamed", CorrelationId="renamed"),
    ])
    s = silver.silver_events(b)
    window = gold.current_status(s)
    by_max = gold.current_status(s, method="max_by")
    assert sorted(window.collect()) == sorted(by_max.collect())
    rows = {(r.league_id, r.league_name): r.latest_correlation_id for r in window.collect()}
    # Ingest times differ by one second per offset: the later offset wins.
    assert rows == {(1, "Serie A"): "new", (2, "Serie A"): "x", (1, "Renamed"): "renamed"}
    assert window.groupBy(*gold.GOLD_KEY).count().filter("count > 1").count() == 0


def test_gold_ties_on_ingest_time_break_on_fetch_time_then_key(spark):
    same = F.lit("2026-04-10 00:00:00").cast("timestamp")
    v = prepare(records(spark, [
        text(CorrelationId="a", FetchedAtUtc="2026-04-10T09:00:00Z"),
        text(CorrelationId="b", FetchedAtUtc="2026-04-10T09:00:00Z"),
        text(CorrelationId="c", FetchedAtUtc="2026-04-10T08:00:00Z"),
    ]), clock=same)
    s = silver.silver_events(bronze.accepted_records(v))
    for method in ("window", "max_by"):
        r = gold.current_status(s, method=method).first()
        assert r.latest_correlation_id == "b", method  # equal times: larger key wins


def test_null_order_keys_sort_last(spark):
    v = prepare(records(spark, [text(CorrelationId="has-time"), text(CorrelationId="no-time", FetchedAtUtc=None)]),
                clock=F.lit("2026-04-10 00:00:00").cast("timestamp"))
    s = silver.silver_events(bronze.accepted_records(v))
    for method in ("window", "max_by"):
        assert gold.current_status(s, method=method).first().latest_correlation_id == "has-time"


def test_shuffled_input_same_result(spark):
    b = bronze_rows(spark, [text(LeagueId=i % 3 + 1, CorrelationId=f"c{i}") for i in range(30)])
    a = gold.current_status(silver.silver_events(b)).collect()
    shuffled = b.repartition(7).orderBy(F.rand(seed=3))
    assert sorted(a) == sorted(gold.current_status(silver.silver_events(shuffled)).collect())


def test_layers_and_bounded_replay(spark):
    layout, _ = runs.fresh_layout(spark, "t-replay")
    day1 = records(spark, [text(LeagueId=1, CorrelationId="d1"), text(LeagueId=2, CorrelationId="d1b")])
    medallion.bronze_ingest(spark, day1, layout, clock=F.col("kafka_timestamp_utc"))
    day2 = records(spark, [text(LeagueId=1, CorrelationId="d2")], start=2)
    medallion.bronze_ingest(spark, day2, layout, clock=F.col("kafka_timestamp_utc") + F.expr("INTERVAL 1 DAY"))
    assert medallion.replay(spark, layout) == (3, 2)
    g = {r.league_id: r.latest_correlation_id for r in spark.table(layout.gold).collect()}
    assert g == {1: "d2", 2: "d1b"}
    # A replay of the first day leaves the other dates, and keys whose newest row lies there, whole.
    before = sorted(map(str, spark.table(layout.silver).collect()))
    assert medallion.replay(spark, layout, start="2026-04-10", end="2026-04-10") == (3, 2)
    assert sorted(map(str, spark.table(layout.silver).collect())) == before
    g = {r.league_id: r.latest_correlation_id for r in spark.table(layout.gold).collect()}
    assert g == {1: "d2", 2: "d1b"}
    plan = medallion.date_range(spark.table(layout.accepted), "2026-04-10", "2026-04-10")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_job_entry_runs_the_layers(spark):
    from strata import jobs
    from strata.session import run_dir

    root = run_dir(spark, "t-jobs")
    records(spark, [text(LeagueId=7), "garbage"]).write.parquet(f"{root}/topic")
    tag = root.rsplit("-", 1)[1][:8]
    base = ["--bronze_schema", f"jb_{tag}", "--silver_schema", f"js_{tag}", "--gold_schema", f"jg_{tag}"]
    for schema in base[1::2]:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root}/{schema}'")
    out = jobs.run(spark, jobs.parser().parse_args(
        ["bronze", *base, "--topic_name", "raw.ingestion.test", "--source_format", "parquet",
         "--source_path", f"{root}/topic"]))
    assert out == {"accepted_rows": 1, "quarantine_rows": 1}
    assert jobs.run(spark, jobs.parser().parse_args(["silver", *base])) == {"silver_rows": 1}
    assert jobs.run(spark, jobs.parser().parse_args(["gold", *base])) == {"gold_rows": 1}
    rec = jobs.run(spark, jobs.parser().parse_args(["publish", *base, "--option", f"path={root}/published"]))
    assert rec["matched"] and rec["source_rows"] == rec["published_rows"] == 1
    resumed = jobs.run(spark, jobs.parser().parse_args(
        ["bronze", *base, "--topic_name", "raw.ingestion.test", "--source_format", "parquet",
         "--source_path", f"{root}/topic", "--starting_offsets", "resume"]))
    assert resumed == {"accepted_rows": 0, "quarantine_rows": 0}


def test_hot_key_holding_a_third_of_rows(spark):
    """One message redelivered as often as all others together: results stay
    whole and the rank-1 windows are limited before the shuffle."""
    n = 60
    base = records(spark, [text(LeagueId=i % 4 + 1, CorrelationId=f"c{i}") for i in range(n)])
    hot = records(spark, [text(LeagueId=1, CorrelationId="hot")], start=1000)
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("copy"))
    # Each copy is ingested one second after the previous one.
    hot_deliveries = prepare(
        copies, clock=F.col("kafka_timestamp_utc") + F.make_dt_interval(secs=F.col("copy")), passthrough=("copy",)
    ).drop("copy")
    v = prepare(base, clock=F.col("kafka_timestamp_utc")).unionByName(hot_deliveries)
    first = bronze.first_arrival(v)
    assert first.count() == n + 1
    hot_ts = hot.first().timestamp
    assert first.filter("kafka_offset = 1000").first().ingested_at_utc == hot_ts + dt.timedelta(seconds=1)
    s = silver.silver_events(bronze.accepted_records(v))
    assert s.count() == n + 1
    latest_hot = s.filter("idempotency_key = 'raw.ingestion.test|0|1000'").first()
    assert latest_hot.ingested_at_utc == hot_ts + dt.timedelta(seconds=n // 2)
    g = gold.current_status(s)
    assert g.count() == 4 and sorted(g.collect()) == sorted(gold.current_status(s, method="max_by").collect())
    for df in (first, s, g):
        assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_swap_rebuild_keeps_readers_on_the_last_good_version(spark):
    from strata.sinks.tables import overwrite_swap

    layout, _ = runs.fresh_layout(spark, "t-swap", swap=True)
    medallion.bronze_ingest(spark, records(spark, [text(LeagueId=1), text(LeagueId=2)]), layout,
                            clock=F.col("kafka_timestamp_utc"))
    assert medallion.silver_rebuild(spark, layout, swap=True) == 2
    assert medallion.gold_rebuild(spark, layout, swap=True) == 2
    assert spark.catalog.getTable(layout.gold).tableType == "VIEW"
    # A rebuild that fails while writing leaves the previous version in place.
    broken = spark.table(layout.silver).withColumn("league_id", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception):
        overwrite_swap(broken, layout.silver)
    assert spark.table(layout.silver).count() == 2
    # Later rebuilds keep one previous version and drop older ones.
    medallion.silver_rebuild(spark, layout, swap=True)
    medallion.silver_rebuild(spark, layout, swap=True)
    db, obj = layout.silver.split(".")
    versions = [t.name for t in spark.catalog.listTables(db) if t.name.startswith(obj + "__v")]
    assert len(versions) <= 3  # current, previous, and the failed attempt's leftover
    served = spark.table(layout.gold).filter("league_id = 1")
    explain = spark._jvm.PythonSQLUtils.explainString(served._jdf.queryExecution(), "formatted")
    assert "EqualTo(league_id,1)" in explain
    with pytest.raises(ValueError):
        overwrite_swap(spark.table(layout.silver), layout.accepted)


def test_resume_offsets_read_only_new_records(spark, tmp_path):
    from strata.sources.transport import read_topic

    layout, root = runs.fresh_layout(spark, "t-resume")
    topic = "raw.ingestion.test"
    assert medallion.resume_offsets(spark, layout, topic) is None
    path = f"{root}/topic"
    records(spark, [text(), "garbage", text()], partition=0).union(
        records(spark, [text()], partition=1)).write.parquet(path)
    other = records(spark, [text()], partition=5).withColumn("topic", F.lit("another.topic"))
    medallion.bronze_ingest(spark, other, layout, clock=F.col("kafka_timestamp_utc"))
    medallion.bronze_ingest(spark, read_topic(spark, topic, path=path), layout, clock=F.col("kafka_timestamp_utc"))
    resume = medallion.resume_offsets(spark, layout, topic)
    assert resume == {topic: {"0": 3, "1": 1}}  # the garbage offset counts too, the other topic does not
    assert medallion.resume_offsets(spark, layout, topic, range(3)) == {topic: {"0": 3, "1": 1, "2": -2}}
    records(spark, [text()], partition=0, start=3).write.mode("append").parquet(path)
    fresh = read_topic(spark, topic, path=path, starting_offsets=resume)
    assert [(r.partition, r.offset) for r in fresh.collect()] == [(0, 3)]
    run = medallion.bronze_ingest(spark, fresh, layout, clock=F.col("kafka_timestamp_utc"))
    assert (run.accepted_rows, run.quarantine_rows) == (1, 0)


def test_a_run_that_ends_between_the_appends_loses_nothing(spark, monkeypatch):
    layout, _ = runs.fresh_layout(spark, "t-crash")
    topic = records(spark, [text(), "garbage", text()])
    real = medallion.append

    def failing(df, table, *args, **kwargs):
        if table == layout.quarantine:
            raise RuntimeError("lost")
        return real(df, table, *args, **kwargs)

    monkeypatch.setattr(medallion, "append", failing)
    with pytest.raises(RuntimeError):
        medallion.bronze_ingest(spark, topic, layout, clock=F.col("kafka_timestamp_utc"))
    monkeypatch.setattr(medallion, "append", real)
    assert spark.table(layout.accepted).count() == 2 and spark.table(layout.quarantine).count() == 0
    assert medallion.resume_offsets(spark, layout, "raw.ingestion.test") is None
    run = medallion.bronze_ingest(spark, topic, layout, clock=F.col("kafka_timestamp_utc"))
    assert run == medallion.BronzeRun(0, 1)
    assert medallion.resume_offsets(spark, layout, "raw.ingestion.test") == {"raw.ingestion.test": {"0": 3}}


def test_increments_equal_the_rebuild(spark):
    layout, _ = runs.fresh_layout(spark, "t-inc")
    clock = F.col("kafka_timestamp_utc")
    medallion.bronze_ingest(spark, records(spark, [text(LeagueId=i % 3 + 1, CorrelationId=f"a{i}") for i in range(6)]), layout, clock=clock)
    medallion.replay(spark, layout)
    late = records(spark, [text(LeagueId=i % 4 + 1, CorrelationId=f"b{i}") for i in range(5)], start=6)
    medallion.bronze_ingest(spark, late, layout, clock=clock + F.expr("INTERVAL 2 DAYS"))
    assert medallion.silver_increment(spark, layout, "2026-04-12") == 11
    assert medallion.gold_increment(spark, layout, "2026-04-12") == 4
    got = [sorted(map(str, spark.table(t).collect())) for t in (layout.silver, layout.gold)]
    medallion.replay(spark, layout)
    assert got == [sorted(map(str, spark.table(t).collect())) for t in (layout.silver, layout.gold)]


def test_tables_in_another_format(spark):
    import dataclasses

    layout, root = runs.fresh_layout(spark, "t-orc", swap=True)
    layout = dataclasses.replace(layout, fmt="orc", accepted_object="a_orc", quarantine_object="q_orc", offsets_object="k_orc", progress_object="p_orc")
    medallion.create_layer_tables(spark, layout, root)
    medallion.bronze_ingest(spark, records(spark, [text(), "garbage"]), layout, clock=F.col("kafka_timestamp_utc"))
    assert medallion.replay(spark, layout) == (1, 1)
    for table in (layout.accepted, layout.quarantine, layout.silver, layout.gold, layout.offsets):
        assert "Provider" in {r.col_name for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        provider = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect() if r.col_name == "Provider"]
        assert provider == ["orc"]
    assert set(schemas.SILVER.names) == set(spark.table(layout.silver).columns)


def test_layer_tables_exist_before_the_first_rebuild(spark):
    layout, _ = runs.fresh_layout(spark, "t-ddl")
    assert spark.table(layout.silver).count() == spark.table(layout.gold).count() == 0
    assert set(spark.table(layout.gold).columns) == set(schemas.GOLD.names)


def _files(spark, table):
    rows = spark.table(table).select("event_date", F.col("_metadata.file_path").alias("file")).distinct().collect()
    return {str(day): {r.file for r in rows if r.event_date == day} for day in {r.event_date for r in rows}}


def test_increments_by_date_leave_other_dates_alone(spark):
    """Keys a0 to a5 on the 10th; a second history day on the 11th; then a
    redelivery of one key a day moves it and empties its old date."""
    layout, _ = runs.fresh_layout(spark, "t-dates")
    clock = F.col("kafka_timestamp_utc")

    def ingest(values, start, days):
        medallion.bronze_ingest(spark, records(spark, values, start=start), layout, clock=clock + F.make_dt_interval(F.lit(days)))

    ingest([text(LeagueId=i % 3 + 1, CorrelationId=f"a{i}") for i in range(6)], 0, 0)
    ingest([text(LeagueId=9, CorrelationId="b0", RequestKey="moves")], 6, 1)
    medallion.replay(spark, layout)
    before = {t: _files(spark, t) for t in (layout.silver, layout.gold)}
    # The same event again under a new offset, and the same league under another event.
    ingest([text(LeagueId=9, CorrelationId="b0", RequestKey="moves"), text(LeagueId=7, CorrelationId="c0")], 7, 3)
    silver_rows = medallion.silver_increment(spark, layout, "2026-04-13", by_date=True)
    gold_rows = medallion.gold_increment(spark, layout, "2026-04-13", by_date=True)
    after = {t: _files(spark, t) for t in (layout.silver, layout.gold)}
    for table in (layout.silver, layout.gold):
        assert before[table]["2026-04-10"] == after[table]["2026-04-10"]
    got = [sorted(map(str, spark.table(t).collect())) for t in (layout.silver, layout.gold)]
    medallion.replay(spark, layout)
    assert got == [sorted(map(str, spark.table(t).collect())) for t in (layout.silver, layout.gold)]
    assert set(after[layout.gold]) == {"2026-04-10", "2026-04-13"}  # league 9 left the 11th
    assert gold_rows == 2 and silver_rows >= 2
    # Nothing new: the same dates are written again, to the same rows.
    assert medallion.gold_increment(spark, layout, "2026-04-20", by_date=True) == 0
    assert got[1] == sorted(map(str, spark.table(layout.gold).collect()))
    with pytest.raises(ValueError):
        medallion.silver_increment(spark, layout, "2026-04-13", swap=True, by_date=True)


def test_increment_by_date_meets_a_null_in_the_key(spark):
    layout, _ = runs.fresh_layout(spark, "t-nullkey")
    clock = F.col("kafka_timestamp_utc")
    for start, days in ((0, 0), (1, 2)):
        medallion.bronze_ingest(spark, records(spark, [text(LeagueName=None, CorrelationId=f"n{start}")], start=start), layout, clock=clock + F.make_dt_interval(F.lit(days)))
        if start == 0:
            medallion.replay(spark, layout)
    medallion.silver_increment(spark, layout, "2026-04-12", by_date=True)
    medallion.gold_increment(spark, layout, "2026-04-12", by_date=True)
    rows = spark.table(layout.gold).collect()
    assert [(r.league_name, str(r.event_date), r.latest_correlation_id) for r in rows] == [(None, "2026-04-12", "n1")]
