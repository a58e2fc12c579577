"""Oracle SQL (DuckDB) for the registered queries.

The oracles never parse the message JSON: they compute every expected value
from ``events`` columns and the fault rules of FIXTURES.md section 4, so they
check the Spark pipeline independently.  Only the expected message text is
assembled here, by string concatenation, to compare the raw column.
"""

from __future__ import annotations

# Fixed values of the fixture (FIXTURES.md section 4) and of the rule texts.
_EV = """
ev AS (
  SELECT event_id,
         CAST(ts AS TIMESTAMP) AS ts,
         user_id, event_type, value,
         CAST(event_id % 40 AS INTEGER) AS fault,
         CAST(user_id % 4 AS INTEGER) AS kafka_partition,
         CAST(user_id % 7 + 1 AS INTEGER) AS league,
         CAST(2020 + user_id % 3 AS INTEGER) AS season_v,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events
),
f AS (
  SELECT ev.*,
    'raw.ingestion.dev' AS kafka_topic,
    event_id AS kafka_offset,
    fault IN (0, 1) AS unparsed,
    CASE WHEN fault = 2 THEN ' ' ELSE '1.0' END AS SchemaVersion,
    CASE WHEN fault IN (3, 12) THEN '' ELSE 'api-football' END AS Source,
    CASE WHEN fault = 4 THEN '' WHEN fault = 13 THEN 'fixtures' ELSE 'league-status' END AS EntityType,
    CASE WHEN fault IN (5, 12) THEN 0 ELSE league END AS LeagueId,
    'League-' || CAST(league AS VARCHAR) AS LeagueName,
    CASE WHEN fault = 6 THEN -1 ELSE season_v END AS Season,
    CASE WHEN fault = 7 THEN NULL ELSE 'c-' || CAST(event_id AS VARCHAR) END AS CorrelationId,
    ts AS FetchedAtUtc,
    CASE WHEN fault = 8 THEN '  ' ELSE '/status' END AS Endpoint,
    CASE WHEN fault IN (9, 12) THEN NULL
         ELSE 'status-' || CAST(league AS VARCHAR) || '-' || CAST(season_v AS VARCHAR) END AS RequestKey,
    CASE WHEN fault = 10 THEN '' ELSE CAST(league AS VARCHAR) END AS SourceEntityId,
    CASE WHEN fault = 11 THEN ''
         ELSE '{"status":"' || event_type || '","response_length":' || CAST(k AS VARCHAR)
              || CASE WHEN event_type = 'error' THEN ',"warning":"w"' ELSE '' END || '}' END AS PayloadJson,
    CASE fault
      WHEN 0 THEN 'JSON deserialization failure'
      WHEN 1 THEN 'Envelope parse failure'
      WHEN 2 THEN 'SchemaVersion is required'
      WHEN 3 THEN 'Source is required'
      WHEN 4 THEN 'EntityType is required'
      WHEN 5 THEN 'LeagueId must be greater than zero'
      WHEN 6 THEN 'Season must be greater than zero'
      WHEN 7 THEN 'CorrelationId is required'
      WHEN 8 THEN 'Endpoint is required'
      WHEN 9 THEN 'RequestKey is required'
      WHEN 10 THEN 'SourceEntityId is required'
      WHEN 11 THEN 'PayloadJson is required'
      WHEN 12 THEN 'Source is required'
      ELSE NULL END AS reason,
    CASE WHEN fault = 12
         THEN 'Source is required; LeagueId must be greater than zero; RequestKey is required'
         WHEN fault < 12 THEN NULL ELSE '' END AS errors12
  FROM ev
),
m AS (
  SELECT f.*,
    COALESCE(errors12, reason) AS errors_text,
    CASE WHEN fault = 0 THEN 'not valid json'
         WHEN fault = 1 THEN ''
         ELSE '{' || concat_ws(',',
            '"SchemaVersion":"' || SchemaVersion || '"',
            '"Source":"' || Source || '"',
            '"EntityType":"' || EntityType || '"',
            '"LeagueId":' || CAST(LeagueId AS VARCHAR),
            '"LeagueName":"' || LeagueName || '"',
            '"Season":' || CAST(Season AS VARCHAR),
            '"CorrelationId":"' || CorrelationId || '"',
            '"FetchedAtUtc":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"',
            '"Endpoint":"' || Endpoint || '"',
            '"RequestKey":"' || RequestKey || '"',
            '"SourceEntityId":"' || SourceEntityId || '"',
            '"PayloadJson":"' || replace(PayloadJson, '"', '\\"') || '"') || '}'
    END AS raw_message_json,
    'raw.ingestion.dev|' || CAST(kafka_partition AS VARCHAR) || '|' || CAST(event_id AS VARCHAR) AS idempotency_key
  FROM f
),
d AS (
  SELECT m.*, ts AS ingested_at_utc FROM m
  UNION ALL
  SELECT m.*, ts + INTERVAL 1 DAY AS ingested_at_utc FROM m WHERE event_id % 10 = 0
)"""


def _with(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return "WITH" + _EV + extra + "\n"


_ACCEPTED_COLS = """
    SchemaVersion AS schema_version, Source AS source, EntityType AS entity_type,
    RequestKey AS request_key, CorrelationId AS correlation_id, SourceEntityId AS source_entity_id,
    CAST(LeagueId AS VARCHAR) AS league_id, LeagueName AS league_name, CAST(Season AS VARCHAR) AS season,
    Endpoint AS endpoint, FetchedAtUtc AS fetched_at_utc, ts AS kafka_timestamp_utc,
    ingested_at_utc, CAST(ingested_at_utc AS DATE) AS event_date,
    kafka_topic, kafka_partition, kafka_offset, PayloadJson AS payload_json, raw_message_json,
    idempotency_key, 'accepted' AS ingestion_status, false AS quarantined"""

_QUARANTINE_COLS = """
    reason, errors_text AS validation_errors, kafka_topic, kafka_partition, kafka_offset,
    ts AS kafka_timestamp_utc, ingested_at_utc AS quarantined_at_utc,
    CAST(ingested_at_utc AS DATE) AS event_date, raw_message_json"""

# Bronze accepted rows of every delivery (no de-duplication), as Silver reads them.
_BRONZE_RAW = f"b AS (SELECT {_ACCEPTED_COLS} FROM d WHERE reason IS NULL)"

_ELIGIBLE = """e AS (
  SELECT * FROM b
  WHERE entity_type = 'league-status' AND quarantined = false AND ingestion_status = 'accepted'
    AND idempotency_key IS NOT NULL AND payload_json IS NOT NULL AND ingested_at_utc IS NOT NULL
    AND event_date IS NOT NULL AND league_id IS NOT NULL AND season IS NOT NULL)"""

_SILVER = """s AS (
  SELECT idempotency_key, schema_version, source, entity_type, request_key, correlation_id,
    source_entity_id, TRY_CAST(league_id AS INTEGER) AS league_id, league_name,
    TRY_CAST(season AS INTEGER) AS season, endpoint,
    json_extract_string(payload_json, '$.status') AS api_status,
    TRY_CAST(json_extract(payload_json, '$.response_length') AS INTEGER) AS api_response_length,
    json_extract_string(payload_json, '$.warning') AS api_warning,
    fetched_at_utc, kafka_timestamp_utc, ingested_at_utc, event_date, payload_json, raw_message_json
  FROM (
    SELECT e.*, row_number() OVER (PARTITION BY idempotency_key
        ORDER BY ingested_at_utc DESC NULLS LAST, kafka_offset DESC NULLS LAST, kafka_partition DESC NULLS LAST) AS rn
    FROM e) WHERE rn = 1)"""

_GOLD = """g AS (
  SELECT league_id, league_name, season, api_status, api_response_length, api_warning,
    CASE WHEN api_warning IS NOT NULL AND trim(api_warning) <> '' THEN 'warning'
         WHEN api_status IS NOT NULL AND trim(api_status) <> '' THEN 'ok'
         ELSE 'unknown' END AS status_category,
    idempotency_key AS latest_idempotency_key, request_key AS latest_request_key,
    correlation_id AS latest_correlation_id, fetched_at_utc AS latest_fetched_at_utc,
    ingested_at_utc AS latest_ingested_at_utc, event_date, payload_json AS latest_payload_json
  FROM (
    SELECT s.*, row_number() OVER (PARTITION BY league_id, league_name, season
        ORDER BY ingested_at_utc DESC NULLS LAST, fetched_at_utc DESC NULLS LAST,
                 idempotency_key DESC NULLS LAST) AS rn
    FROM s) WHERE rn = 1)"""

_SERVED = """league_id, league_name, season, status_category, api_status, api_warning,
  latest_fetched_at_utc, latest_ingested_at_utc"""

_FIRST = "d1 AS (SELECT * FROM d WHERE ingested_at_utc = ts)"

# Envelopes built from events: an error event has no payload.
_BUILT = """bev AS (
  SELECT ev.*, CASE WHEN event_type <> 'error'
    THEN '{"status":"' || event_type || '","response_length":' || CAST(k AS VARCHAR) || '}'
    ELSE '{"warning":"API key not configured"}' END AS payload
  FROM ev)"""

GOLD_SQL = _with(_BRONZE_RAW, _ELIGIBLE, _SILVER, _GOLD) + "SELECT * FROM g"
SILVER_SQL = _with(_BRONZE_RAW, _ELIGIBLE, _SILVER) + "SELECT * FROM s"


def oracle_sql() -> dict[str, str]:
    envelope_cols = """
      CASE WHEN unparsed THEN NULL ELSE SchemaVersion END AS SchemaVersion,
      CASE WHEN unparsed THEN NULL ELSE Source END AS Source,
      CASE WHEN unparsed THEN NULL ELSE EntityType END AS EntityType,
      CASE WHEN unparsed THEN NULL ELSE LeagueId END AS LeagueId,
      CASE WHEN unparsed THEN NULL ELSE LeagueName END AS LeagueName,
      CASE WHEN unparsed THEN NULL ELSE Season END AS Season,
      CASE WHEN unparsed THEN NULL ELSE CorrelationId END AS CorrelationId,
      CASE WHEN unparsed THEN NULL ELSE FetchedAtUtc END AS FetchedAtUtc,
      CASE WHEN unparsed THEN NULL ELSE Endpoint END AS Endpoint,
      CASE WHEN unparsed THEN NULL ELSE RequestKey END AS RequestKey,
      CASE WHEN unparsed THEN NULL ELSE SourceEntityId END AS SourceEntityId,
      CASE WHEN unparsed THEN NULL ELSE PayloadJson END AS PayloadJson"""
    q: dict[str, str] = {}
    q["transport_scan"] = _with() + (
        "SELECT kafka_topic AS topic, kafka_partition AS partition, kafka_offset AS \"offset\", "
        "ts AS timestamp, raw_message_json AS value FROM m"
    )
    q["transport_projection"] = _with() + (
        "SELECT kafka_topic, kafka_partition, kafka_offset, ts AS kafka_timestamp_utc, raw_message_json FROM m"
    )
    q["envelope_parse"] = _with() + (
        f"SELECT kafka_topic, kafka_partition, kafka_offset, {envelope_cols},\n"
        "  fault = 0 AS corrupt_record, fault = 1 AS envelope_is_null FROM m"
    )
    q["derived_columns"] = _with() + (
        "SELECT kafka_topic, kafka_partition, kafka_offset, ingested_at_utc, "
        "CAST(ingested_at_utc AS DATE) AS event_date, idempotency_key FROM d"
    )
    q["business_key"] = _with() + (
        "SELECT kafka_topic, kafka_partition, kafka_offset,\n"
        "  CASE WHEN unparsed THEN '' ELSE concat_ws('|', Source, EntityType, RequestKey) END AS business_key FROM m"
    )
    q["bronze_row_flat"] = _with() + (
        "SELECT SchemaVersion, Source, EntityType, LeagueId, LeagueName, Season, CorrelationId, FetchedAtUtc,\n"
        "  Endpoint, RequestKey, SourceEntityId, PayloadJson, kafka_topic AS KafkaTopic,\n"
        "  kafka_partition AS KafkaPartition, kafka_offset AS KafkaOffset, ts AS KafkaTimestampUtc,\n"
        "  ts AS IngestedAtUtc, raw_message_json AS RawMessageJson FROM m WHERE reason IS NULL"
    )
    q["bronze_accepted"] = _with(_FIRST) + f"SELECT {_ACCEPTED_COLS} FROM d1 WHERE reason IS NULL"
    q["bronze_quarantine"] = _with(_FIRST) + f"SELECT {_QUARANTINE_COLS} FROM d1 WHERE reason IS NOT NULL"
    q["validation_reason"] = _with() + "SELECT kafka_topic, kafka_partition, kafka_offset, reason AS validation_reason FROM m"
    q["validation_errors"] = _with() + (
        "SELECT kafka_topic, kafka_partition, kafka_offset, errors_text AS validation_errors,\n"
        "  CAST(CASE WHEN fault = 12 THEN 3 WHEN fault < 12 THEN 1 ELSE 0 END AS INTEGER) AS error_count FROM m"
    )
    q["split_conservation"] = _with() + (
        "SELECT count(*) AS input_rows, count(*) FILTER (WHERE reason IS NULL) AS accepted_rows,\n"
        "  count(*) FILTER (WHERE reason IS NOT NULL) AS quarantine_rows, CAST(0 AS BIGINT) AS rows_in_both,\n"
        "  CAST(0 AS BIGINT) AS rows_in_neither, true AS conserved FROM m"
    )
    q["silver_eligible"] = _with(_BRONZE_RAW, _ELIGIBLE) + "SELECT * FROM e"
    q["silver_payload"] = _with(_BRONZE_RAW, _ELIGIBLE) + (
        "SELECT idempotency_key, ingested_at_utc, kafka_offset,\n"
        "  json_extract_string(payload_json, '$.status') AS api_status,\n"
        "  TRY_CAST(json_extract(payload_json, '$.response_length') AS INTEGER) AS api_response_length,\n"
        "  json_extract_string(payload_json, '$.warning') AS api_warning FROM e"
    )
    q["silver_events"] = SILVER_SQL
    q["status_category"] = _with(_BRONZE_RAW, _ELIGIBLE, _SILVER) + (
        "SELECT idempotency_key, api_status, api_warning,\n"
        "  CASE WHEN api_warning IS NOT NULL AND trim(api_warning) <> '' THEN 'warning'\n"
        "       WHEN api_status IS NOT NULL AND trim(api_status) <> '' THEN 'ok' ELSE 'unknown' END AS status_category\n"
        "FROM s"
    )
    q["gold_current_status"] = GOLD_SQL
    q["gold_via_max_by"] = GOLD_SQL
    q["first_arrival"] = _with() + (
        "SELECT kafka_topic, kafka_partition, kafka_offset, idempotency_key, ts AS ingested_at_utc,\n"
        "  ts AS kafka_timestamp_utc, reason AS validation_reason FROM m"
    )
    q["message_outcome"] = _with() + (
        "SELECT kafka_topic, kafka_partition, kafka_offset, ingested_at_utc,\n"
        "  reason IS NULL AND ingested_at_utc = ts AS written_to_bronze,\n"
        "  reason IS NOT NULL AS written_to_quarantine,\n"
        "  CASE WHEN fault IN (0, 1) THEN reason\n"
        "       WHEN reason IS NOT NULL THEN 'Envelope validation failure: ' || errors_text\n"
        "       WHEN ingested_at_utc > ts THEN 'Duplicate skipped'\n"
        "       ELSE 'Consumed offset ' || CAST(kafka_offset AS VARCHAR) || ' from ' || kafka_topic || ' and wrote Bronze row.'\n"
        "  END AS outcome FROM d"
    )
    gold_from = _with(_BRONZE_RAW, _ELIGIBLE, _SILVER, _GOLD)
    q["serving_all"] = gold_from + f"SELECT {_SERVED} FROM g"
    q["serving_by_league"] = gold_from + f"SELECT {_SERVED} FROM g WHERE league_id = 3"
    q["serving_by_season"] = gold_from + f"SELECT {_SERVED} FROM g WHERE season = 2021"
    q["serving_by_both"] = gold_from + f"SELECT {_SERVED} FROM g WHERE league_id = 3 AND season = 2021"
    q["serving_nulls"] = gold_from + (
        "SELECT COALESCE(league_id, 0) AS league_id, COALESCE(league_name, '') AS league_name,\n"
        "  COALESCE(season, 0) AS season, COALESCE(status_category, '') AS status_category,\n"
        "  api_status, api_warning, latest_fetched_at_utc, latest_ingested_at_utc FROM g"
    )
    q["recent_rows"] = _with() + (
        "SELECT * FROM (SELECT 'accepted' AS output, kafka_topic, kafka_partition, kafka_offset, ts AS at_utc,\n"
        "    raw_message_json FROM m WHERE reason IS NULL\n"
        "    ORDER BY ts DESC, kafka_topic DESC, kafka_partition DESC, kafka_offset DESC LIMIT 5)\n"
        "UNION ALL\n"
        "SELECT * FROM (SELECT 'quarantine' AS output, kafka_topic, kafka_partition, kafka_offset, ts AS at_utc,\n"
        "    raw_message_json FROM m WHERE reason IS NOT NULL\n"
        "    ORDER BY ts DESC, kafka_topic DESC, kafka_partition DESC, kafka_offset DESC LIMIT 5)"
    )
    q["latest_order_per_customer"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (\n"
        "  SELECT *, row_number() OVER (PARTITION BY o_custkey\n"
        "    ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn FROM orders) WHERE rn = 1"
    )
    built = _with(_BUILT)
    q["envelope_build"] = built + (
        "SELECT event_id, '1.0' AS SchemaVersion, 'api-football' AS Source, 'league-status' AS EntityType,\n"
        "  league AS LeagueId, 'League-' || CAST(league AS VARCHAR) AS LeagueName, season_v AS Season,\n"
        "  'c-' || CAST(event_id AS VARCHAR) AS CorrelationId, ts AS FetchedAtUtc, '/status' AS Endpoint,\n"
        "  'status-' || CAST(league AS VARCHAR) || '-' || CAST(season_v AS VARCHAR) AS RequestKey,\n"
        "  CAST(league AS VARCHAR) AS SourceEntityId, payload AS PayloadJson FROM bev"
    )
    q["envelope_publish"] = built + (
        "SELECT event_id, CAST(NULL AS VARCHAR) AS key, 'raw.ingestion.dev' AS topic,\n"
        "  '{\"SchemaVersion\":\"1.0\",\"Source\":\"api-football\",\"EntityType\":\"league-status\",\"LeagueId\":'\n"
        "  || CAST(league AS VARCHAR) || ',\"LeagueName\":\"League-' || CAST(league AS VARCHAR)\n"
        "  || '\",\"Season\":' || CAST(season_v AS VARCHAR) || ',\"CorrelationId\":\"c-' || CAST(event_id AS VARCHAR)\n"
        "  || '\",\"FetchedAtUtc\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')\n"
        "  || '\",\"Endpoint\":\"/status\",\"RequestKey\":\"status-' || CAST(league AS VARCHAR) || '-'\n"
        "  || CAST(season_v AS VARCHAR) || '\",\"SourceEntityId\":\"' || CAST(league AS VARCHAR)\n"
        "  || '\",\"PayloadJson\":\"' || replace(payload, '\"', '\\\"') || '\"}' AS value FROM bev"
    )
    q["quota_admission"] = (
        "SELECT event_id, call_date, CASE WHEN rn <= 100 THEN rn END AS call_number, rn <= 100 AS admitted\n"
        "FROM (SELECT event_id, CAST(CAST(ts AS TIMESTAMP) AS DATE) AS call_date,\n"
        "  CAST(row_number() OVER (PARTITION BY CAST(CAST(ts AS TIMESTAMP) AS DATE)\n"
        "    ORDER BY ts, event_id) AS INTEGER) AS rn FROM events)"
    )
    q["quota_ledger"] = (
        "SELECT strftime(call_date, '%Y-%m-%d') AS DateUtc, CAST(count(*) AS INTEGER) AS CallsMade,\n"
        "  CAST(100 AS INTEGER) AS MaxCallsPerDay, max(ts) AS LastCallStartedAtUtc,\n"
        "  max(make_timestamp(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT))) AS LastCallCompletedAtUtc\n"
        "FROM (SELECT CAST(ts AS TIMESTAMP) AS ts, value, CAST(CAST(ts AS TIMESTAMP) AS DATE) AS call_date,\n"
        "  row_number() OVER (PARTITION BY CAST(CAST(ts AS TIMESTAMP) AS DATE) ORDER BY ts, event_id) AS rn\n"
        "  FROM events) WHERE rn <= 100 GROUP BY call_date"
    )
    q["bronze_append_idempotent"] = q["bronze_accepted"]
    q["run_metrics"] = _with(_FIRST) + (
        "SELECT 'bronze_accepted' AS sink, count(*) AS rows_written FROM d1 WHERE reason IS NULL\n"
        "UNION ALL SELECT 'bronze_quarantine', count(*) FROM d1 WHERE reason IS NOT NULL\n"
        "UNION ALL SELECT 'silver', count(*) FROM d1 WHERE reason IS NULL AND fault <> 13\n"
        "UNION ALL SELECT 'gold', count(DISTINCT (LeagueId, LeagueName, Season)) FROM d1\n"
        "  WHERE reason IS NULL AND fault <> 13"
    )
    q["silver_rebuild"] = SILVER_SQL
    q["gold_rebuild"] = GOLD_SQL
    q["replay_range"] = GOLD_SQL
    q["publish_snapshot"] = gold_from + (
        "SELECT league_id AS LEAGUE_ID, league_name AS LEAGUE_NAME, season AS SEASON,\n"
        "  api_status AS API_STATUS, api_response_length AS API_RESPONSE_LENGTH, api_warning AS API_WARNING,\n"
        "  status_category AS STATUS_CATEGORY, latest_idempotency_key AS LATEST_IDEMPOTENCY_KEY,\n"
        "  latest_request_key AS LATEST_REQUEST_KEY, latest_correlation_id AS LATEST_CORRELATION_ID,\n"
        "  latest_fetched_at_utc AS LATEST_FETCHED_AT_UTC, latest_ingested_at_utc AS LATEST_INGESTED_AT_UTC,\n"
        "  event_date AS EVENT_DATE, latest_payload_json AS LATEST_PAYLOAD_JSON FROM g"
    )
    q["publish_reconcile"] = gold_from + (
        "SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS missing_in_target,\n"
        "  CAST(0 AS BIGINT) AS extra_in_target, true AS matched FROM g"
    )
    q["jsonl_roundtrip"] = _with(_FIRST) + (
        "SELECT reason AS Reason, errors_text AS ValidationErrors, kafka_topic AS KafkaTopic,\n"
        "  kafka_partition AS KafkaPartition, kafka_offset AS KafkaOffset, ts AS KafkaTimestampUtc,\n"
        "  ingested_at_utc AS QuarantinedAtUtc, raw_message_json AS RawMessageJson\n"
        "FROM d1 WHERE reason IS NOT NULL"
    )
    q["stream_bronze_accepted"] = _with(_FIRST) + (
        f"SELECT * REPLACE (CAST(league_id AS INTEGER) AS league_id, CAST(season AS INTEGER) AS season)\n"
        f"FROM (SELECT {_ACCEPTED_COLS} FROM d1 WHERE reason IS NULL)"
    )
    q["stream_bronze_quarantine"] = q["bronze_quarantine"]
    q["stream_run_metrics"] = (
        f"SELECT 'accepted' AS sink, count(*) AS rows_written FROM ({q['stream_bronze_accepted']})\n"
        f"UNION ALL SELECT 'quarantine', count(*) FROM ({q['stream_bronze_quarantine']})"
    )
    q["quota_online"] = q["quota_admission"]
    q["stream_dedup"] = q["bronze_accepted"]
    q["stream_outcome"] = q["message_outcome"]
    q["stream_first_arrival"] = q["first_arrival"]
    q["recent_rows_stored"] = q["recent_rows"]
    outputs = (
        "SELECT 'accepted' AS output, kafka_topic, kafka_partition, kafka_offset, CAST(NULL AS VARCHAR) AS reason\n"
        "FROM m WHERE reason IS NULL UNION ALL\n"
        "SELECT 'quarantine', kafka_topic, kafka_partition, kafka_offset, reason FROM m WHERE reason IS NOT NULL"
    )
    q["transport_scan_bounded"] = q["transport_scan"] + (
        "\nWHERE NOT (kafka_partition = 0 AND (kafka_offset < 100 OR kafka_offset >= 700))\n"
        "  AND NOT (kafka_partition = 1 AND kafka_offset >= 500) AND NOT (kafka_partition = 2 AND kafka_offset < 40)"
    )
    q["stream_topic_pattern"] = q["transport_scan"]
    q["stream_from_latest"] = q["transport_scan"] + (
        "\nJOIN (SELECT kafka_partition, (min(kafka_offset) + max(kafka_offset)) // 2 AS middle FROM m GROUP BY 1) USING (kafka_partition)\n"
        "WHERE kafka_offset >= middle OR kafka_partition = 3"
    )
    kept = "kafka_offset % 97 <> 0"
    changed = f"{kept} AND kafka_offset % 101 = 0 AND raw_message_json IS NOT NULL"
    twice = f"{kept} AND kafka_offset % 89 = 0"
    q["publish_differences"] = _with() + (
        f"SELECT count(*) AS source_rows, count(*) FILTER (WHERE {kept}) + count(*) FILTER (WHERE {twice}) AS target_rows,\n"
        f"  count(*) FILTER (WHERE NOT ({kept})) + count(*) FILTER (WHERE {changed}) AS missing_in_target,\n"
        f"  count(*) FILTER (WHERE {twice}) + count(*) FILTER (WHERE {changed}) AS extra_in_target, false AS matched FROM m"
    )
    q["bronze_resume"] = _with() + outputs
    q["stream_tables"] = _with(f"o AS ({outputs})") + "SELECT kafka_topic, kafka_partition, kafka_offset, reason FROM o"
    q["jsonl_accepted_roundtrip"] = q["bronze_row_flat"]
    q["envelope_default_id"] = "SELECT count(*) AS envelopes, count(*) AS guids, count(*) AS distinct_ids FROM events"
    q["replay_bounded"] = SILVER_SQL
    # Two runs split at the middle day: the second drops redeliveries of what the first stored.
    middle = (
        "mid AS (SELECT min(CAST(ts AS DATE)) + CAST((max(CAST(ts AS DATE)) - min(CAST(ts AS DATE))) // 2 AS INTEGER) AS day FROM ev),\n"
        f"b AS (SELECT {_ACCEPTED_COLS} FROM d, mid WHERE reason IS NULL\n"
        "  AND NOT (ingested_at_utc > ts AND CAST(ts AS DATE) < mid.day AND CAST(ingested_at_utc AS DATE) >= mid.day))"
    )
    q["silver_incremental"] = _with(middle, _ELIGIBLE, _SILVER) + "SELECT * FROM s"
    q["gold_incremental"] = _with(middle, _ELIGIBLE, _SILVER, _GOLD) + "SELECT * FROM g"
    q["silver_incremental_by_date"] = q["silver_incremental"]
    q["gold_incremental_by_date"] = q["gold_incremental"]
    return q
