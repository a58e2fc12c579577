"""Daily call quota against a brute-force count."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import quota


def calls(spark, n=400, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400)), rnd.random() * 10) for i in range(n)]
    # Ties on time are broken by id.
    rows.append((n, rows[0][1], 1.0))
    return rows, spark.createDataFrame(rows, "id long, ts timestamp, secs double")


def test_admission_matches_brute_force(spark):
    rows, df = calls(spark)
    cap = 50
    got = {r.id: (r.admitted, r.call_number) for r in quota.admit_calls(df, "ts", "id", cap).collect()}
    by_day: dict = {}
    for i, ts, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        by_day.setdefault(ts.date(), []).append(i)
    want = {}
    for ids in by_day.values():
        for n, i in enumerate(ids, 1):
            want[i] = (n <= cap, n if n <= cap else None)
    assert got == want


def test_ledger_matches_brute_force(spark):
    rows, df = calls(spark)
    cap = 50
    done = F.col("ts") + F.make_dt_interval(secs=F.col("secs"))
    ledger = {r.DateUtc: r for r in quota.call_ledger(df, "ts", "id", done, cap).collect()}
    by_day: dict = {}
    for i, ts, secs in sorted(rows, key=lambda r: (r[1], r[0])):
        by_day.setdefault(ts.date(), []).append((ts, secs))
    assert set(ledger) == {d.isoformat() for d in by_day}
    for day, items in by_day.items():
        admitted = items[:cap]
        row = ledger[day.isoformat()]
        assert row.CallsMade == min(len(items), cap) and row.MaxCallsPerDay == cap
        assert row.LastCallStartedAtUtc == max(t for t, _ in admitted)
        last_done = max(t + dt.timedelta(microseconds=round(s * 1e6)) for t, s in admitted)
        assert abs((row.LastCallCompletedAtUtc - last_done).total_seconds()) < 1e-5


def test_repeated_and_null_ids_keep_every_row_once(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(1, day, 1.0), (1, day, 2.0), (2, day, 1.0), (None, day + dt.timedelta(hours=1), 1.0), (5, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, secs double")
    for cap in (1, 2, 3, 10):
        got = quota.admit_calls(df, "ts", "id", cap).collect()
        assert len(got) == 5
        of_day = [r for r in got if r.ts is not None]
        assert sorted(r.call_number for r in of_day if r.admitted) == list(range(1, min(cap, 4) + 1))
    assert quota.admit_calls(df, "ts", "id", 10).filter("id IS NULL").first().admitted


def test_large_cap_keeps_the_early_limit(spark):
    rows, df = calls(spark, n=3000)
    cap = 5000
    admitted = quota.admitted_calls(df, "ts", "id", cap)
    assert admitted.count() == len(rows)
    plan = admitted._jdf.queryExecution().executedPlan().toString()
    # The first ranking is by day and part: no task meets a whole day.
    assert "hashpartitioning(call_date" in plan and plan.count("Window [") == 2 and "_part" in plan
