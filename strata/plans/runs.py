"""Fresh, isolated table sets for jobs run by the registered queries.

Each run gets its own schemas (databases) located under the shared
checkpoint folder, so repeated runs never see each other's rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata import schemas
from strata.plans.medallion import create_layer_tables
from strata.session import configure, run_dir


def fresh_layout(spark: SparkSession, label: str, swap: bool = False) -> tuple[schemas.Layout, str]:
    configure(spark)
    root = run_dir(spark, label)
    tag = uuid.uuid4().hex[:10]
    layout = schemas.Layout(
        bronze_schema=f"bronze_{tag}", silver_schema=f"silver_{tag}", gold_schema=f"gold_{tag}"
    )
    create_layer_tables(spark, layout, root, swap)
    return layout, root


def result(spark: SparkSession, layout: schemas.Layout, root: str, df: DataFrame) -> DataFrame:
    """``df`` as a plain folder under ``root``; the run's databases are dropped."""
    path = f"{root}/result"
    df.write.parquet(path)
    for db in (layout.gold_schema, layout.silver_schema, layout.bronze_schema):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return spark.read.schema(df.schema).parquet(path)
