"""Envelope parse and validation: the reference's cases and the edge cases
where its two Bronze forms disagree (SURVEY 4.3, 4.4)."""

from __future__ import annotations

import pytest
from conftest import records, text
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.rules import PARSE_EMPTY, PARSE_INVALID_JSON, PARSE_NULL, RULES
from strata.operators import bronze
from strata.operators.envelope import prepare


def validated(spark, values):
    return prepare(records(spark, values), clock=F.col("kafka_timestamp_utc"))


def outcome(spark, value):
    row = validated(spark, [value]).select("validation_reason", "validation_errors").first()
    return row.validation_reason, list(row.validation_errors)


def test_garbage_is_quarantined_not_accepted(spark):
    v = validated(spark, ["not valid json"])
    assert bronze.accepted_records(v).count() == 0
    q = bronze.quarantine_records(v).collect()
    assert len(q) == 1 and q[0].reason == PARSE_INVALID_JSON


def test_valid_envelope_is_accepted(spark):
    v = validated(spark, [text()])
    rows = bronze.accepted_records(v).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.league_id, r.season, r.payload_json) == ("135", "2025", '{"ok":true}')
    assert r.ingestion_status == "accepted" and r.quarantined is False
    assert r.idempotency_key == "raw.ingestion.test|0|0"
    assert bronze.quarantine_records(v).count() == 0


def test_five_errors_at_once_in_rule_order(spark):
    reason, errors = outcome(spark, text(Source="", RequestKey="", SourceEntityId="", PayloadJson="", LeagueId=0))
    assert errors == [
        "Source is required",
        "LeagueId must be greater than zero",
        "RequestKey is required",
        "SourceEntityId is required",
        "PayloadJson is required",
    ]
    assert reason == errors[0]


def test_recorded_quarantine_cases(spark):
    truncated = '{"SchemaVersion":"1.0","Source":"api-football","EntityType":"league-status",'
    bad = text(Source="", LeagueId=0, RequestKey="", LeagueName="Bad League", CorrelationId="corr-bad-1",
               SourceEntityId="0", PayloadJson='{"warning":"bad semantic payload"}')
    v = validated(spark, ["this is not valid json", truncated, truncated, bad])
    got = {r.kafka_offset: (r.reason, list(r.validation_errors)) for r in bronze.quarantine_records(v).collect()}
    assert got[0][0] == got[1][0] == got[2][0] == PARSE_INVALID_JSON
    assert got[3] == ("Source is required",
                      ["Source is required", "LeagueId must be greater than zero", "RequestKey is required"])
    assert bronze.accepted_records(v).count() == 0


@pytest.mark.parametrize(
    "value, reason",
    [
        (None, PARSE_EMPTY),
        ("", PARSE_EMPTY),
        ("   ", PARSE_EMPTY),
        ("null", PARSE_NULL),
        ("[1,2]", PARSE_INVALID_JSON),
        (text(LeagueId="135"), PARSE_INVALID_JSON),
        (text(LeagueId=135.0), PARSE_INVALID_JSON),
        (text(LeagueId=99999999999), PARSE_INVALID_JSON),
        (text(FetchedAtUtc="not a time"), PARSE_INVALID_JSON),
        (text(Source="\t"), "Source is required"),
        (text(Endpoint="  "), "Endpoint is required"),
        (text(SchemaVersion=...), "SchemaVersion is required"),
        (text(Season=None), "Season must be greater than zero"),
        (text(Season=-1), "Season must be greater than zero"),
        (text(CorrelationId=None), "CorrelationId is required"),
    ],
)
def test_edge_cases(spark, value, reason):
    assert outcome(spark, value)[0] == reason


def test_seven_digit_fraction_parses_to_micros(spark):
    v = validated(spark, [text(FetchedAtUtc="2026-04-10T20:16:42.7969421Z")])
    row = bronze.accepted_records(v).select(F.col("fetched_at_utc").cast("string").alias("t")).first()
    assert row.t == "2026-04-10 20:16:42.796942"


def test_null_season_alone_lands_in_exactly_one_output(spark):
    # The reference's streaming form put this row in neither output.
    v = validated(spark, [text(Season=None), text()])
    assert bronze.accepted_records(v).count() + bronze.quarantine_records(v).count() == 2
    row = bronze.split_conservation(v).first()
    assert row.conserved and row.rows_in_neither == 0 and row.rows_in_both == 0


def test_rule_list_is_the_reference_order():
    assert [r.field for r in RULES] == [
        "SchemaVersion", "Source", "EntityType", "LeagueId", "Season", "CorrelationId",
        "Endpoint", "RequestKey", "SourceEntityId", "PayloadJson",
    ]


def test_flat_row_carries_eighteen_columns(spark):
    v = validated(spark, [text()])
    flat = bronze.flat_rows(v)
    assert flat.columns == [f.name for f in schemas.BRONZE_ROW.fields]
    r = flat.first()
    assert (r.LeagueId, r.Season, r.KafkaTopic, r.KafkaOffset) == (135, 2025, "raw.ingestion.test", 0)
    assert r.RawMessageJson == text()


def test_message_outcomes(spark):
    from strata.operators.bronze import DUPLICATE_SKIPPED, VALIDATION_FAILURE

    first = prepare(records(spark, [text(), "garbage", text(Source="")]), clock=F.col("kafka_timestamp_utc"))
    again = prepare(records(spark, [text(), "garbage"]), clock=F.col("kafka_timestamp_utc") + F.expr("INTERVAL 1 DAY"))
    out = [(r.kafka_offset, r.written_to_bronze, r.written_to_quarantine, r.outcome)
           for r in bronze.message_outcome(first.unionByName(again)).collect()]
    assert out.count((0, True, False, "Consumed offset 0 from raw.ingestion.test and wrote Bronze row.")) == 1
    assert out.count((0, False, False, DUPLICATE_SKIPPED)) == 1
    # A redelivered bad message is quarantined again.
    assert len([o for o in out if o[0] == 1 and o[2]]) == len([o for o in out if o[0] == 1]) == 2
    assert out.count((2, False, True, f"{VALIDATION_FAILURE}: Source is required")) == 1


def test_outcomes_do_not_depend_on_the_order_of_reads(spark):
    """A source that gives its rows in another order on every read."""
    same = F.lit("2026-04-10 00:00:00").cast("timestamp")
    v = prepare(records(spark, [text(CorrelationId=f"c{i}") for i in range(40)]), clock=same).orderBy(F.rand())
    out = [r.written_to_bronze for r in bronze.message_outcome(v.unionByName(v)).collect()]
    assert len(out) == 80 and sum(out) == 40


def test_a_broken_sink_shows_in_the_split(spark):
    v = validated(spark, [text(), "garbage", text()])
    assert bronze.split_conservation(v).first().conserved
    lost = bronze.split_conservation(v, quarantine=lambda d: bronze.quarantine_records(d).limit(0)).first()
    assert (lost.conserved, lost.rows_in_neither, lost.rows_in_both) == (False, 1, 0)
    twice = bronze.split_conservation(v, accepted=lambda d: bronze.accepted_records(d.union(d))).first()
    assert (twice.conserved, twice.rows_in_neither, twice.rows_in_both) == (False, 0, 2)


def test_business_key_skips_nulls(spark):
    from strata.operators.envelope import business_key, parse_envelope, transport_columns

    df = business_key(parse_envelope(transport_columns(records(spark, [text(), text(RequestKey=None)]))))
    keys = [r.business_key for r in df.orderBy("kafka_offset").collect()]
    assert keys == ["api-football|league-status|status-135-2025", "api-football|league-status"]


def test_identical_copies_in_one_batch_write_once(spark):
    from strata.operators.bronze import DUPLICATE_SKIPPED

    same = F.lit("2026-04-10 00:00:00").cast("timestamp")
    v = prepare(records(spark, [text()]).union(records(spark, [text()])).union(records(spark, [text()])), clock=same)
    out = [r.outcome for r in bronze.message_outcome(v).collect()]
    assert sorted(out) == sorted(["Consumed offset 0 from raw.ingestion.test and wrote Bronze row.",
                                  DUPLICATE_SKIPPED, DUPLICATE_SKIPPED])
