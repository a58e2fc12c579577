"""Table sinks (K1, K3, K7) and the write-time row count (K8)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas
from strata.session import drop_folder, folder_names


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: tuple[str, ...] = (schemas.PARTITION_COLUMN,),
    location: str | None = None,
    fmt: str = "parquet",
) -> None:
    """K7: ``CREATE TABLE IF NOT EXISTS`` from the table's StructType."""
    spark.sql(schemas.create_table_ddl(name, schema, partition_by, fmt, location))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    text = f"CREATE DATABASE IF NOT EXISTS {name}"
    if location:
        text += f" LOCATION '{location}'"
    spark.sql(text)


def observed(df: DataFrame, label: str = "rows") -> tuple[DataFrame, Observation]:
    """K8: count rows as they pass into the sink, in the same job as the
    write (no second read of the source)."""
    obs = Observation(label)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def rows_written(obs: Observation) -> int:
    return int(obs.get.get("rows", 0) or 0)


def rebalanced(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Group rows by the table's partition columns before a partitioned
    write.  Without it every task writes one file per date it holds (tasks x
    dates small files; a full Silver rebuild over years of dates would write
    millions).  The ``rebalance`` hint is an AQE shuffle that also splits a
    hot date into advisory-size pieces, so no task receives a whole skewed
    partition."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(
    df: DataFrame, table: str, partition_by: tuple[str, ...] = (schemas.PARTITION_COLUMN,), rebalance: bool = True,
    fmt: str = "parquet",
) -> int:
    """K1: append to a partitioned table; returns rows written.  A file
    table needs ``partitionBy`` on every append."""
    watched, obs = observed(rebalanced(df, partition_by) if rebalance else df)
    writer = watched.write.format(fmt).mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
    return rows_written(obs)


def overwrite(
    df: DataFrame, table: str, partition_by: tuple[str, ...] = (schemas.PARTITION_COLUMN,), rebalance: bool = True,
    fmt: str = "parquet",
) -> int:
    """K3: full rebuild of a partitioned table; returns rows written."""
    watched, obs = observed(rebalanced(df, partition_by) if rebalance else df)
    (
        watched.write.format(fmt).mode("overwrite")
        .option("overwriteSchema", "true")
        .partitionBy(*partition_by)
        .saveAsTable(table)
    )
    return rows_written(obs)


#: Formats whose partitions are folders of files; others replace rows their own way.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def overwrite_partitions(df: DataFrame, table: str, values: Iterable[object], column: str = schemas.PARTITION_COLUMN) -> int:
    """K3, only what changed: ``df`` becomes the content of the partitions
    ``values`` of a file table, every other partition keeps its files; returns
    rows written.

    ``df`` must not read the table and holds no rows of other partitions.  A
    dynamic overwrite puts each partition in place when all of it is written;
    partitions of ``values`` that have no rows any more are dropped after that,
    so a run cut short leaves old rows behind and never takes any away."""
    spark = df.sparkSession
    watched, obs = observed(rebalanced(df.select(*spark.table(table).columns), (column,)))
    mode = "spark.sql.sources.partitionOverwriteMode"  # an insert into a table takes no write options
    usual = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        watched.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, usual)
    spark.catalog.refreshTable(table)
    kept = {r[0] for r in df.select(column).distinct().collect()}  # a row a partition that was written
    drop_partitions(spark, table, set(values) - kept, column)
    return rows_written(obs)


def partition_values(spark: SparkSession, table: str, column: str = schemas.PARTITION_COLUMN) -> list[str | None]:
    """The values a stored table is partitioned by, as text, the greatest first
    and null last: from the catalog where it keeps the table's partitions, else
    from the names of the table's folders.  No data file is opened."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if about.get("Partition Provider") == "Catalog":
        names = [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]  # a row a partition
    else:
        names = folder_names(spark, about["Location"])
    values = {n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")}
    empty = {"__HIVE_DEFAULT_PARTITION__", "null"} & values
    return [*sorted(values - empty, reverse=True), *([None] if empty else [])]


def drop_partitions(spark: SparkSession, table: str, values: Iterable[object], column: str = schemas.PARTITION_COLUMN) -> None:
    """Drop partitions of a file table: through the catalog where it keeps the
    table's partitions, else their folders."""
    gone = sorted(values)
    if not gone:
        return
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if about.get("Partition Provider") == "Catalog":
        spec = ", ".join(f"PARTITION ({column} = '{v}')" for v in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
    else:
        for value in gone:
            drop_folder(spark, f"{about['Location']}/{column}={value}")
    spark.catalog.refreshTable(table)


def overwrite_swap(
    df: DataFrame,
    name: str,
    partition_by: tuple[str, ...] = (schemas.PARTITION_COLUMN,),
    keep_previous: int = 1,
    fmt: str = "parquet",
) -> int:
    """K3, durable form: write the rebuild as a new version table, then
    repoint the view ``name`` at it in one catalog statement.

    A plain overwrite of a parquet table deletes the old files before the
    new ones are written, so a failed rebuild leaves readers an empty table.
    Here readers keep seeing the previous version until the new one is
    complete; ``keep_previous`` older versions stay for queries still
    reading them, older ones are dropped.  Filters and column pruning pass
    through the view to the version table's scan."""
    spark = df.sparkSession
    db, obj = name.rsplit(".", 1)
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind != "VIEW":
            raise ValueError(f"{name} is a {kind} table; swap mode needs the name free or a view")
    prefix = f"{obj}__v"
    version = f"{prefix}{int(time.time() * 1000):015d}_{uuid.uuid4().hex[:6]}"
    rows = overwrite(df, f"{db}.{version}", partition_by, fmt=fmt)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {db}.{version}")
    versions = sorted(t.name for t in spark.catalog.listTables(db) if t.name.startswith(prefix))
    for old in versions[: max(len(versions) - keep_previous - 1, 0)]:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{old}")
    return rows
