"""Topic reads between offsets, JSON lines, envelope build and publish,
snapshot publish and reconciliation."""

from __future__ import annotations

import json

import pytest

from conftest import TOPIC, records, text
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import bronze, envelope, publish
from strata.operators.envelope import prepare
from strata.session import run_dir
from strata.sinks import jsonl
from strata.sources import transport


def test_read_topic_between_offsets(spark, tmp_path):
    path = str(tmp_path / "topic")
    records(spark, [text()] * 6, partition=0).union(records(spark, [text()] * 6, partition=1)).union(
        records(spark, [text()] * 2, topic="other")).write.parquet(path)
    all_rows = transport.read_topic(spark, TOPIC, path=path)
    assert all_rows.count() == 12
    bounded = transport.read_topic(spark, TOPIC, path=path, starting_offsets={TOPIC: {"0": 2, "1": -2}},
                                   ending_offsets=json.dumps({TOPIC: {"0": 5}}))
    got = sorted((r.partition, r.offset) for r in bounded.collect())
    brute = sorted((p, o) for p in (0, 1) for o in range(6) if p == 1 or 2 <= o < 5)
    assert got == brute
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(topic), EqualTo(topic,raw.ingestion.test)" in plan


def test_quarantine_jsonl_roundtrip_and_older_rows(spark):
    root = run_dir(spark, "t-jsonl")
    v = prepare(records(spark, ["garbage", text(Source="", LeagueId=0)]), clock=F.col("kafka_timestamp_utc"))
    lines = jsonl.quarantine_lines(bronze.quarantine_records(v))
    jsonl.append_jsonl(lines, f"{root}/q")
    # An older line written without ValidationErrors.
    old = ('{"Reason":"JSON deserialization failure","KafkaTopic":"t","KafkaPartition":0,"KafkaOffset":34,'
           '"KafkaTimestampUtc":"2026-04-10T20:16:42.431Z","QuarantinedAtUtc":"2026-04-10T20:16:42.7969421Z",'
           '"RawMessageJson":"this is not valid json"}')
    spark.createDataFrame([(old,)], "value string").write.mode("append").text(f"{root}/q")
    back = {r.KafkaOffset: r for r in transport.read_quarantine_jsonl(spark, f"{root}/q").collect()}
    assert back[34].ValidationErrors == [] and back[34].QuarantinedAtUtc.microsecond == 796942
    assert back[1].ValidationErrors == ["Source is required", "LeagueId must be greater than zero"]
    src = {r.KafkaOffset: r for r in lines.collect()}
    assert back[0] == src[0] and back[1] == src[1]


def test_envelope_build_publish_and_parse_back(spark):
    df = spark.createDataFrame([(135, 2025, '{"status":"ok"}'), (39, 2024, None)], "league int, season int, payload string")
    clock = F.lit("2026-04-10 20:16:42.796942").cast("timestamp")
    built = df.select(
        envelope.build_envelope(F.col("league"), F.col("season"), F.col("payload"), fetched_at=clock).alias("envelope")
    )
    rows = {r.envelope.LeagueId: r.envelope for r in built.collect()}
    assert rows[135].RequestKey == "status-135-2025" and rows[135].LeagueName == "League-135"
    assert rows[39].PayloadJson == envelope.MISSING_PAYLOAD_JSON
    assert rows[39].SourceEntityId == "39" and len(rows[39].CorrelationId) == 36  # a uuid
    out = envelope.to_transport(built, "envelope", TOPIC)
    assert out.columns == ["key", "value", "topic"]
    assert out.filter(F.col("key").isNotNull()).count() == 0
    # What is published parses back into the same envelope, micro-seconds included.
    kafka = out.select("topic", F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
                       F.current_timestamp().alias("timestamp"), "value")
    v = prepare(kafka)
    assert v.filter("validation_reason IS NOT NULL").count() == 0
    back = {r.envelope.LeagueId: r.envelope for r in v.select("envelope").collect()}
    assert back[135].FetchedAtUtc == rows[135].FetchedAtUtc
    assert back[135].FetchedAtUtc.microsecond == 796942
    assert back[39].PayloadJson == rows[39].PayloadJson


def test_publish_shape_and_reconcile(spark):
    gold = spark.createDataFrame(
        [(1, "A", 2025, "2026-04-10 12:00:00"), (2, None, 2025, "2026-04-10 13:00:00")],
        "league_id int, league_name string, season int, ts string",
    ).withColumn("latest_fetched_at_utc", F.col("ts").cast("timestamp")).drop("ts")
    shaped = publish.published_shape(gold)
    assert shaped.columns == ["LEAGUE_ID", "LEAGUE_NAME", "SEASON", "LATEST_FETCHED_AT_UTC"]
    assert dict(shaped.dtypes)["LATEST_FETCHED_AT_UTC"] == "timestamp_ntz"
    root = run_dir(spark, "t-publish")
    publish.publish_snapshot(gold, "parquet", {"path": f"{root}/out"})
    target = spark.read.parquet(f"{root}/out")
    r = publish.reconcile(gold, target).first()
    assert (r.source_rows, r.target_rows, r.missing_in_target, r.extra_in_target, r.matched) == (2, 2, 0, 0, True)
    # A row lost and a duplicate added: both directions are counted.
    broken = target.filter("LEAGUE_ID = 1").unionByName(target.filter("LEAGUE_ID = 1"))
    r = publish.reconcile(gold, broken).first()
    assert (r.source_rows, r.target_rows, r.missing_in_target, r.extra_in_target, r.matched) == (2, 2, 1, 1, False)
    # Overwrite replaces the copy.
    publish.publish_snapshot(gold.filter("league_id = 1"), "parquet", {"path": f"{root}/out"})
    assert spark.read.parquet(f"{root}/out").count() == 1


def test_table_schemas_round_trip_through_ddl(spark):
    from strata.plans import runs

    layout, _ = runs.fresh_layout(spark, "t-ddl")
    stored = spark.table(layout.accepted)
    assert {f.name: f.dataType for f in stored.schema.fields} == {f.name: f.dataType for f in schemas.BRONZE_ACCEPTED.fields}
    assert spark.table(layout.quarantine).schema["validation_errors"].dataType == schemas.BRONZE_QUARANTINE["validation_errors"].dataType


def test_accepted_jsonl_roundtrip(spark):
    root = run_dir(spark, "t-jsonl-acc")
    v = prepare(records(spark, [text(), text(LeagueId=7, FetchedAtUtc="2026-04-10T20:16:42.796942Z")]),
                clock=F.col("kafka_timestamp_utc"))
    rows = bronze.flat_rows(v)
    jsonl.append_jsonl(rows, f"{root}/bronze")
    back = transport.read_bronze_jsonl(spark, f"{root}/bronze")
    assert sorted(back.collect()) == sorted(rows.collect())


def test_stored_topics_refuse_bounds_they_cannot_keep(spark, tmp_path):
    path = str(tmp_path / "topic")
    records(spark, [text()]).write.parquet(path)
    for start, end in (("latest", "latest"), ("earliest", "earliest"), ({TOPIC: {"0": -1}}, "latest")):
        with pytest.raises(ValueError):
            transport.read_topic(spark, TOPIC, path=path, starting_offsets=start, ending_offsets=end)
    with pytest.raises(ValueError):
        transport.read_topic_stream(spark, TOPIC, "parquet", path, starting_offsets="latest")


def test_publish_counts_what_it_writes(spark, tmp_path):
    df = spark.range(7).toDF("n")
    assert publish.publish_snapshot(df, "parquet", {"path": str(tmp_path / "copy")}) == 7


@pytest.mark.parametrize("planted", ["none", "lost", "twice", "changed", "nulls swapped", "empty target", "empty source"])
def test_reconcile_by_buckets_equals_the_exact_form(spark, planted):
    rows = [(i, None if i % 5 == 0 else f"v{i % 4}", None if i % 3 == 0 else f"v{i % 4}") for i in range(200)] * 2
    copy = {
        "none": rows, "lost": rows[3:], "twice": rows + rows[:7], "changed": [(i, "x" if i == 9 else a, b) for i, a, b in rows],
        "nulls swapped": [(i, b, a) for i, a, b in rows], "empty target": [], "empty source": rows,
    }[planted]
    schema = "id int, a string, b string"
    source = spark.createDataFrame([] if planted == "empty source" else rows, schema)
    target = publish.published_shape(spark.createDataFrame(copy, schema)).repartition(3)
    exact = publish.reconcile(source, target).first()
    assert publish.reconcile_buckets(source, target, buckets=16).first() == exact
    assert exact.matched == (planted == "none")


def test_buckets_that_agree_move_no_rows(spark, tmp_path):
    rows = spark.range(2_000).select("id", F.concat(F.lit("text "), F.col("id")).alias("body"))
    publish.publish_snapshot(rows, "parquet", {"path": str(tmp_path / "copy")})
    report = publish.reconcile_buckets(rows, spark.read.parquet(str(tmp_path / "copy")))
    assert report.collect()[0].matched
    final = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BODY#" not in "".join(line for line in final.splitlines() if "Exchange" in line)


def test_start_of_a_stream_is_decided_once(spark, tmp_path):
    path, folder = str(tmp_path / "topic"), str(tmp_path / "start")
    records(spark, [text()] * 4, partition=0).write.parquet(path)
    stored = transport.read_topic(spark, TOPIC, path=path)
    assert transport.decided_start(stored, "latest", folder) == {TOPIC: {"0": 4}}
    records(spark, [text()] * 2, partition=0, start=4).write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert transport.decided_start(stored, "latest", folder) == {TOPIC: {"0": 4}}
    assert transport.decided_start(stored, json.dumps({TOPIC: {"0": -1, "1": -1, "2": 7}}), folder) == {TOPIC: {"0": 4, "1": -2, "2": 7}}
    assert transport.decided_start(stored.limit(0), "latest", str(tmp_path / "none")) == {}
    with pytest.raises(ValueError):
        transport.read_topic_stream(spark, TOPIC, path=path, starting_offsets="latest")


def test_stream_from_latest_over_restarts_and_a_new_partition(spark, tmp_path):
    path, out = str(tmp_path / "topic"), str(tmp_path / "out")

    def run():
        stream = transport.read_topic_stream(
            spark, "raw[.]ingestion[.].*", path=path, starting_offsets="latest", start_folder=str(tmp_path / "start"), options={"maxFilesPerTrigger": "1"})
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out)
        query.awaitTermination()
        return sorted((r.topic, r.partition, r.offset) for r in spark.read.schema(schemas.TRANSPORT).parquet(out).collect())

    records(spark, [text()] * 3).write.parquet(path)
    assert run() == []
    records(spark, [text()] * 2, start=3).write.mode("append").parquet(path)  # came while the stream was down
    assert run() == [(TOPIC, 0, 3), (TOPIC, 0, 4)]
    new = records(spark, [text()], partition=1).union(records(spark, [text()], topic="raw.ingestion.new"))
    new.union(records(spark, [text()], start=5)).write.mode("append").parquet(path)
    assert run() == [("raw.ingestion.new", 0, 0), (TOPIC, 0, 3), (TOPIC, 0, 4), (TOPIC, 0, 5), (TOPIC, 1, 0)]
