"""Source mixing and stratified sharding: laws, repeatability, awkward rows."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from helpers import awkward_docs, no_docs
from pyspark.sql import functions as F

from strata.llm import source_mix, stratified_shards


def docs_of(spark, sizes):
    rows = [(k, " ".join(["w"] * n), s) for k, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def water(sizes, weights=(1, 2, 3), most=3):
    """Targets by filling up sources one at a time."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > most * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("block_rows", [1000, 5])
def test_mix_meets_targets(spark, block_rows):
    sizes = [("hot", 1 + i % 50) for i in range(600)] + [("a", 3)] * 30 + [("b", 40)] * 50 + [("c", 7)] * 3 + [(None, 9)] * 40
    rows = source_mix.mix_documents(docs_of(spark, sizes), block_rows=block_rows).collect()
    total = Counter()
    for s, n in sizes:
        total[s] += n
    targets, taken = water(total), Counter()
    for r in rows:
        assert r.source_size == total[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.size * len(r.places) and len(r.places) <= 3
        taken[r.source] += r.taken
    for s in total:
        assert abs(taken[s] - targets[s]) <= 50
    assert sum(targets.values()) == pytest.approx(sum(total.values()))


def test_mix_repeats_itself_and_shards_are_level(spark):
    docs = docs_of(spark, [(f"s{i % 4}", 1 + i % 9) for i in range(400)])
    one, two = (sorted(map(str, source_mix.mix_documents(d, block_rows=5, shards=8).collect())) for d in (docs, docs.repartition(7)))
    assert one == two
    mix = source_mix.plan_mix(docs, block_rows=5, shards=8)
    units = Counter(s for r in mix.blocks.collect() for s in (r.shards or []))
    assert set(units) == set(range(8)) and max(units.values()) - min(units.values()) <= 1
    out = source_mix.delivered(docs, block_rows=5, shards=8).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r.mix_shard].append(r.mix_slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_quotas_add_up(spark):
    units = spark.createDataFrame([(f"s{i % 3}", i, 1) for i in range(100)], "source string, block int, pass int")
    rows = source_mix._quotas(units, 7, 100, 3).collect()
    per_source, per_shard = Counter(), Counter()
    for r in rows:
        per_source[r.source] += r.quota
        per_shard[r.shard] += r.quota
    assert per_source == Counter(f"s{i % 3}" for i in range(100))
    assert max(per_shard.values()) - min(per_shard.values()) <= 1 and len(per_shard) == 7


def test_mix_on_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = source_mix.mix_documents(docs).collect()
    assert len(rows) == docs.count()
    assert sum(r.taken for r in rows if r.doc_id in (100, 101, 102)) == 0
    out = source_mix.delivered(docs, slots=False)
    assert out.columns == docs.columns
    assert sum(len(r.places) for r in rows) == out.count()
    assert source_mix.mix_documents(no_docs(spark)).count() == 0 and source_mix.delivered(no_docs(spark)).count() == 0


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_shards_are_level_and_mixed(spark, bucket_rows):
    docs = docs_of(spark, [("hot" if i % 3 else f"s{i % 5}", i % 4) for i in range(500)])
    rows = stratified_shards.stratified_shards(docs, shards=24, bucket_rows=bucket_rows).collect()
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    sizes = [len(v) for v in shards.values()]
    assert set(shards) == set(range(24)) and max(sizes) - min(sizes) <= 1
    whole = Counter(r.source for r in rows)
    for v in shards.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
        for s, n in Counter(r.source for r in v).items():
            assert abs(n - whole[s] * len(v) / 500) <= 3  # half the number of sources
    again = stratified_shards.stratified_shards(docs.repartition(5), shards=24, bucket_rows=bucket_rows).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_shards_on_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = stratified_shards.stratified_shards(docs, shards=50).collect()
    assert len(rows) == docs.count() and len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert {r["size"] for r in rows if r.doc_id == 100} == {8}
    assert stratified_shards.stratified_shards(no_docs(spark)).count() == 0


def test_main_paths_hold_no_python(spark):
    docs = awkward_docs(spark)
    for out in (source_mix.mix_documents(docs), stratified_shards.stratified_shards(docs)):
        plan = out._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert F is not None
