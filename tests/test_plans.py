"""The physical plans we rely on at scale."""

from __future__ import annotations

from conftest import SF_SMALL, records, text
from pyspark.sql import functions as F

from strata.operators import bronze, gold, offsets, serving, silver
from strata.operators.envelope import prepare
from strata.plans import medallion, runs
from strata.plans.queries import QUERIES


def plan(df) -> str:
    """The formatted explain text (untruncated pushed filters)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_envelope_parsed_once_and_filters_stay_above(spark):
    v = prepare(records(spark, [text(), "x"]), clock=F.col("kafka_timestamp_utc"))
    for df in (bronze.accepted_records(v), bronze.quarantine_records(v)):
        text_plan = optimized(df)
        assert text_plan.count("from_json(") == 1
        assert text_plan.index("Filter") < text_plan.index("Generate")


def test_rank_one_windows_are_limited_before_the_shuffle(spark):
    for name in ("silver_events", "gold_current_status", "latest_order_per_customer", "first_arrival"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in p, name


def test_max_by_form_aggregates_partially_and_sorts(spark):
    """A struct buffer is not mutable, so this form sorts: a cross-check, not a faster plan."""
    p = plan(QUERIES["gold_via_max_by"](spark, SF_SMALL))
    assert p.count("SortAggregate") >= 2 and "partial_max_by" in p


def test_table_reads_push_filters_and_prune_partitions(spark):
    layout, _ = runs.fresh_layout(spark, "t-plan")
    medallion.bronze_ingest(spark, records(spark, [text()]), layout, clock=F.col("kafka_timestamp_utc"))
    medallion.silver_rebuild(spark, layout)
    medallion.gold_rebuild(spark, layout)
    served = plan(serving.current_statuses(spark.table(layout.gold), league_id=135, season=2025))
    assert "EqualTo(league_id,135)" in served and "EqualTo(season,2025)" in served
    assert "ReadSchema: struct<league_id:int,league_name:string,season:int,api_status:string" in served
    elig = plan(silver.eligible(spark.table(layout.accepted)))
    assert "EqualTo(entity_type,league-status)" in elig and "PartitionFilters: [isnotnull(event_date" in elig
    ranged = plan(medallion.date_range(spark.table(layout.silver), "2026-04-10", None))
    assert "PartitionFilters: [isnotnull(event_date" in ranged and "(event_date" in ranged


def test_range_anti_join_meets_ranges_by_piece(spark):
    layout, _ = runs.fresh_layout(spark, "t-anti")
    medallion.bronze_ingest(spark, records(spark, [text()] * 3), layout, clock=F.col("kafka_timestamp_utc"))
    batch = prepare(records(spark, [text()] * 5), clock=F.col("kafka_timestamp_utc"))
    p = plan(offsets.outside(batch, spark.table(layout.offsets)))
    assert "LeftAnti" in p and "NestedLoop" not in p and "Cartesian" not in p


def test_gold_reads_only_needed_silver_columns(spark):
    layout, _ = runs.fresh_layout(spark, "t-prune")
    medallion.bronze_ingest(spark, records(spark, [text()]), layout, clock=F.col("kafka_timestamp_utc"))
    medallion.silver_rebuild(spark, layout)
    p = plan(gold.current_status(spark.table(layout.silver)))
    assert "raw_message_json" not in p.split("ReadSchema:")[1].split("\n")[0]
