"""Serving reads of Gold: optional filters and the served null policy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata import schemas
from strata.operators import serving

T = dt.datetime(2026, 4, 10, 12, 0, 0)


def gold_rows(spark):
    rows = [
        (135, "Serie A", 2025, "ok", 10, None, "ok", "k1", "r1", "c1", T, T, T.date(), "{}"),
        (135, "Serie A", 2024, None, None, "API key not configured", "warning", "k2", "r2", "c2", T, T, T.date(), "{}"),
        (39, None, 2025, None, None, None, None, "k3", "r3", "c3", None, None, T.date(), "{}"),
    ]
    return spark.createDataFrame(rows, schemas.GOLD)


def test_filters_none_league_season_both(spark):
    g = gold_rows(spark)
    key = lambda df: sorted((r.league_id, r.season) for r in df.collect())
    assert key(serving.current_statuses(g)) == [(39, 2025), (135, 2024), (135, 2025)]
    assert key(serving.current_statuses(g, league_id=135)) == [(135, 2024), (135, 2025)]
    assert key(serving.current_statuses(g, season=2025)) == [(39, 2025), (135, 2025)]
    assert key(serving.current_statuses(g, league_id=135, season=2025)) == [(135, 2025)]
    assert serving.current_statuses(g).columns == list(schemas.SERVED_COLUMNS)


def test_served_null_policy_keeps_status_and_warning_null(spark):
    served = {r.league_id: r for r in serving.served_rows(serving.current_statuses(gold_rows(spark))).collect()}
    assert served[39].league_name == "" and served[39].status_category == ""
    assert served[39].api_status is None and served[39].api_warning is None
    assert served[39].latest_fetched_at_utc is None
    ok = [r for r in serving.served_rows(serving.current_statuses(gold_rows(spark), season=2025)).collect()
          if r.league_id == 135][0]
    assert ok.api_warning is None and ok.api_status == "ok" and ok.latest_ingested_at_utc == T


def test_most_recent_breaks_ties_on_the_key(spark):
    df = spark.createDataFrame([(1, T), (2, T), (3, T - dt.timedelta(seconds=1))], "k int, t timestamp")
    assert [r.k for r in serving.most_recent(df, 2, ["t"], ["k"]).collect()] == [2, 1]


def _dated(spark, name, days, per_day=3, undated=0):
    rows = [(10 * d + i, T - dt.timedelta(days=d, seconds=i)) for d in days for i in range(per_day)] + [(-1 - i, None) for i in range(undated)]
    df = spark.createDataFrame(rows, "k long, t timestamp").withColumn("event_date", F.to_date("t"))
    df.write.partitionBy("event_date").mode("overwrite").saveAsTable(name)
    return df


def test_most_recent_stored_reads_only_the_newest_dates(spark):
    name = "default.t_recent_dates"
    df = _dated(spark, name, range(40))
    try:
        for n in (1, 3, 4, 10, 119, 500):
            got = serving.most_recent_stored(spark, name, n, ["t"], ["k"])
            assert [r.k for r in got.collect()] == [r.k for r in serving.most_recent(df, n, ["t"], ["k"]).collect()]
        few = serving.most_recent_stored(spark, name, 4, ["t"], ["k"])
        scan = next(line for line in few._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
        assert "PartitionFilters: [isnotnull(event_date" in scan
        # one date, then two more
        assert "event_date#" in scan and f">= {(T - dt.timedelta(days=2)).date()}" in scan
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_most_recent_stored_takes_undated_rows_last(spark):
    name = "default.t_recent_nulls"
    df = _dated(spark, name, [0, 400], per_day=2, undated=2)
    try:
        for n in (2, 4, 5, 9):
            got = serving.most_recent_stored(spark, name, n, ["t"], ["k"])
            assert [r.k for r in got.collect()] == [r.k for r in serving.most_recent(df, n, ["t"], ["k"]).collect()]
        spark.sql("CREATE TABLE default.t_recent_none (k LONG, t TIMESTAMP, event_date DATE) USING parquet PARTITIONED BY (event_date)")
        assert serving.most_recent_stored(spark, "default.t_recent_none", 3, ["t"], ["k"]).collect() == []
    finally:
        spark.sql(f"DROP TABLE {name}")
        spark.sql("DROP TABLE IF EXISTS default.t_recent_none")
