"""Write an ``events`` table k times larger (plus ``orders`` as is) for scale
probes:  python tools/make_scaled.py SRC_SF_DIR OUT_DIR K

Copy j of event e gets id ``e * K + j`` and the same other columns, so the
fixture rules (fault by id % 40, redelivery by id % 10) spread over the
copies.  Built with explode over a sequence, no cross join."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main() -> None:
    src, out, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    ev = spark.read.parquet(f"{src}/events.parquet")
    scaled = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_j")).select(
        (F.col("event_id") * k + F.col("_j")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("_j") / 1000)).alias("ts"),
        "user_id", "event_type", "value", "props",
    )
    scaled.write.mode("overwrite").parquet(f"{out}/events.parquet")
    spark.read.parquet(f"{src}/orders.parquet").write.mode("overwrite").parquet(f"{out}/orders.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
