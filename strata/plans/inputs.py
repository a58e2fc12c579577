"""Inputs of the registered queries, all derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bronze import accepted_records
from strata.operators.envelope import prepare
from strata.session import configure
from strata.sources.messages import DELIVERY_CLOCK, deliveries, fixture_topic


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return table(spark, sf_dir, "events")


def topic(spark: SparkSession, sf_dir: str, with_clock: bool = False) -> DataFrame:
    """The transport topic: one record per event."""
    return fixture_topic(events(spark, sf_dir), with_clock=with_clock)


def validated_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries, parsed, derived and validated; ingest time = ``ts``."""
    return prepare(topic(spark, sf_dir, True), F.col(DELIVERY_CLOCK), passthrough=(DELIVERY_CLOCK,))


def validated_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries and redeliveries, validated, nothing de-duplicated."""
    return prepare(deliveries(events(spark, sf_dir)), F.col(DELIVERY_CLOCK), passthrough=(DELIVERY_CLOCK,))


def bronze_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze accepted rows of every delivery, appended without A3 or J1:
    the input that makes Silver's de-duplication matter."""
    return accepted_records(validated_all(spark, sf_dir))
