from __future__ import annotations

import datetime as dt
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata import schemas  # noqa: E402
from strata.session import configure  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
TOPIC = "raw.ingestion.test"
T0 = dt.datetime(2026, 4, 10, 20, 16, 42, 431000)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder (a cluster names a shared one).
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    configure(session)
    yield session
    session.stop()


def envelope(**overrides) -> dict:
    """A valid envelope as the producer serialises it; ``None`` values are
    written as JSON null, ``...`` removes the field."""
    body = {
        "SchemaVersion": "1.0",
        "Source": "api-football",
        "EntityType": "league-status",
        "LeagueId": 135,
        "LeagueName": "Serie A",
        "Season": 2025,
        "CorrelationId": "corr-1",
        "FetchedAtUtc": "2026-04-10T12:00:00Z",
        "Endpoint": "/status",
        "RequestKey": "status-135-2025",
        "SourceEntityId": "135",
        "PayloadJson": '{"ok":true}',
    }
    body.update(overrides)
    return {k: v for k, v in body.items() if v is not ...}


def text(**overrides) -> str:
    return json.dumps(envelope(**overrides), separators=(",", ":"))


def records(spark, values, topic=TOPIC, partition=0, start=0, ts=T0):
    """Kafka-shaped rows: one per value (str, or None), consecutive offsets."""
    rows = [
        (topic, partition, start + i, ts + dt.timedelta(seconds=i), None if v is None else bytearray(v.encode()))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, schemas.TRANSPORT)
