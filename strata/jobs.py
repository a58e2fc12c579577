"""spark-submit entry for the layer jobs.

    spark-submit strata/jobs.py bronze --bronze_schema bronze --topic_name raw.ingestion.dev \\
        --source_format kafka --option kafka.bootstrap.servers=host:9092
    spark-submit strata/jobs.py silver --bronze_schema bronze --silver_schema silver
    spark-submit strata/jobs.py gold   --silver_schema silver --gold_schema gold
    spark-submit strata/jobs.py replay --start 2026-04-01 --end 2026-04-30
    spark-submit strata/jobs.py publish --target_format parquet --option path=/warehouse/published

Every job prints the rows it wrote (counted during the write).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata import schemas  # noqa: E402
from strata.operators.publish import publish_snapshot, reconcile  # noqa: E402
from strata.plans import medallion  # noqa: E402
from strata.session import configure  # noqa: E402
from strata.sources.transport import read_topic  # noqa: E402


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for pair in pairs:
        key, _, value = pair.partition("=")
        out[key] = value
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata.jobs")
    p.add_argument("job", choices=["bronze", "silver", "gold", "replay", "publish"])
    p.add_argument("--catalog", default=None)
    p.add_argument("--bronze_schema", default="bronze")
    p.add_argument("--silver_schema", default="silver")
    p.add_argument("--gold_schema", default="gold")
    p.add_argument("--topic_name", default=None, help="the topic; the bronze job needs it")
    p.add_argument("--partitions", type=int, default=0, help="the topic's partitions, for --starting_offsets resume with Kafka")
    p.add_argument("--table_format", default="parquet")
    p.add_argument("--since", default=None, help="silver, gold: only what ingest dates from here on add")
    p.add_argument("--source_format", default="kafka")
    p.add_argument("--source_path", default=None)
    p.add_argument("--starting_offsets", default="earliest")
    p.add_argument("--ending_offsets", default="latest")
    p.add_argument("--start", default=None)
    p.add_argument("--end", default=None)
    p.add_argument("--target_format", default="parquet")
    p.add_argument("--option", action="append", default=[], help="key=value, repeatable")
    p.add_argument("--swap", action="store_true", help="rebuild as a new version behind a view")
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    configure(spark)
    layout = schemas.Layout(args.catalog, args.bronze_schema, args.silver_schema, args.gold_schema, fmt=args.table_format)
    options = _options(args.option)
    if args.job == "bronze":
        if not args.topic_name:
            raise SystemExit("the bronze job needs --topic_name")
        medallion.create_layer_tables(spark, layout, swap=args.swap)
        starting = args.starting_offsets
        if starting == "resume":  # where the last committed run ended, else from the beginning
            starting = medallion.resume_offsets(spark, layout, args.topic_name, range(args.partitions)) or "earliest"
        topic = read_topic(spark, args.topic_name, args.source_format, args.source_path,
                           starting, args.ending_offsets, options)
        result = medallion.bronze_ingest(spark, topic, layout, dedupe_in_batch=args.source_format != "kafka")
        return {"accepted_rows": result.accepted_rows, "quarantine_rows": result.quarantine_rows}
    if args.job == "silver":
        if args.since:
            return {"silver_rows": medallion.silver_increment(spark, layout, args.since, args.swap)}
        return {"silver_rows": medallion.silver_rebuild(spark, layout, args.start, args.end, args.swap)}
    if args.job == "gold":
        if args.since:
            return {"gold_rows": medallion.gold_increment(spark, layout, args.since, args.swap)}
        return {"gold_rows": medallion.gold_rebuild(spark, layout, args.swap)}
    if args.job == "replay":
        silver_rows, gold_rows = medallion.replay(spark, layout, args.start, args.end, args.swap)
        return {"silver_rows": silver_rows, "gold_rows": gold_rows}
    source = spark.table(layout.gold)
    written = publish_snapshot(source, args.target_format, options)
    target = spark.read.format(args.target_format).options(**options).load()
    return {"published_rows": written, **reconcile(source, target).first().asDict()}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"strata-{args.job}").getOrCreate()
    print(json.dumps(run(spark, args), default=str))


if __name__ == "__main__":
    main()
