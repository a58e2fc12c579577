"""A batch that comes in one piece is worked on in pieces of bounded size."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import records, text
from pyspark.sql import functions as F

from strata import session
from strata.plans import medallion, runs


@pytest.mark.parametrize(("dedupe", "copies"), [(True, 2), (False, 1)])
def test_a_batch_in_one_piece_is_staged_in_small_files(spark, monkeypatch, dedupe, copies):
    monkeypatch.setattr(session, "ROWS_PER_FILE", 10, raising=False)
    found = []

    def look(spark, folder, drop=medallion.drop_folder):
        if "/batch-" in folder:
            rows = spark.read.option("recursiveFileLookup", "true").parquet(folder)
            found.extend(r["count"] for r in rows.groupBy(F.input_file_name()).count().collect())
        drop(spark, folder)

    monkeypatch.setattr(medallion, "drop_folder", look)
    layout, _ = runs.fresh_layout(spark, "t-pieces")
    batch = records(spark, [text(), "garbage"] * 20).coalesce(1)
    ran = medallion.bronze_ingest(spark, batch, layout, clock=F.col("kafka_timestamp_utc"), dedupe_in_batch=dedupe)
    assert (ran.accepted_rows, ran.quarantine_rows) == (20, 20)
    assert sum(found) == 40 * copies
    assert max(found) <= 10


def test_shuffles_of_jobs_are_cut_by_rows_not_by_the_session(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_FILE", 10)
    planned = {}

    def pieces(df):
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            df.explain()
        return [int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\), ENSURE_REQUIREMENTS", shown.getvalue())]

    def watched(name, at, frame):
        made = getattr(medallion, name)

        def look(*args, **more):
            planned.setdefault(name, []).extend(pieces(args[frame]))
            return made(*args, **more)

        monkeypatch.setattr(at, name, look)

    watched("staged", medallion, 1)
    watched("_rebuild", medallion, 0)
    watched("_replace", medallion, 1)
    layout, _ = runs.fresh_layout(spark, "t-cut")
    batch = records(spark, [text() for _ in range(200)]).coalesce(1)
    assert medallion.bronze_ingest(spark, batch, layout, clock=F.col("kafka_timestamp_utc")).accepted_rows == 200
    assert medallion.silver_rebuild(spark, layout) == 200
    assert medallion.gold_rebuild(spark, layout) == 1
    assert medallion.silver_increment(spark, layout, "2026-04-10") == 200
    for name in ("staged", "_rebuild", "_replace"):
        assert planned[name] and min(planned[name]) >= 20, planned
    assert spark.conf.get(session.PIECES, None) is None


def test_a_join_with_the_log_is_cut_by_its_ranges_too(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_FILE", 10)
    layout, _ = runs.fresh_layout(spark, "t-ranges")
    clock = F.col("kafka_timestamp_utc")
    batch = records(spark, [text() for _ in range(401)]).coalesce(1)
    even = F.col("offset") % 2 == 0
    medallion.bronze_ingest(spark, batch.filter(even), layout, clock=clock)
    cut, made = [], medallion.append

    def look(df, table, *args, **more):
        if table == layout.accepted:
            cut.append(int(spark.conf.get(session.PIECES)))
        return made(df, table, *args, **more)

    monkeypatch.setattr(medallion, "append", look)
    ends = batch.filter(F.col("offset").isin(0, 400) | (F.col("offset") == 201))
    assert medallion.bronze_ingest(spark, ends, layout, clock=clock).accepted_rows == 1
    assert cut and min(cut) >= 20
