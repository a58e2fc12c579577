"""Exact and approximate vector search against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import kd_search, nn_descent

SCHEMA = "vec_id long, embedding array<float>, score double, id string"


def vectors(n, seed=1, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + 0.6 * rng.normal(size=(n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, x, more=()):
    rows = [(i, v.tolist(), None, "k") for i, v in enumerate(x)]
    return spark.createDataFrame(rows + list(more), SCHEMA)


ODD = [(7001, None, None, None), (7002, [0.1, None, 0.2], None, None), (7003, [float("nan")] * 3, None, None), (7004, [float("inf"), 0.0], None, None), (None, [1.0, 1.0], None, None)]


def brute(rows, every, k):
    """Integer scores of all pairs, shorter vectors padded with zeros."""
    width = max(len(v) for _, v in rows)
    ids = np.array([i for i, _ in rows])
    m = np.array([[np.floor(256 * float(np.float32(c))) for c in v] + [0.0] * (width - len(v)) for _, v in rows])
    out = []
    for q in ids[ids % every == 0]:
        s = m @ m[ids == q][0]
        top = sorted((-int(x), int(i)) for x, i in zip(s, ids) if i != q)[:k]
        out += [(int(q), r + 1, i, -x) for r, (x, i) in enumerate(top)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block", [(10_000, 512), (90, 7)])
def test_top_k_is_exact(spark, shard_rows, block):
    x = vectors(700)
    x[50:60] = x[3]  # ties
    more = [(8000, [0.0] * 16, None, None), (8050, [1.0, -1.0], None, None), *ODD]
    got = kd_search.top_k(frame(spark, x, more), F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_queries=block)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(8000, [0.0] * 16), (8050, [1.0, -1.0])]
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, 50, 5)


def long_scores(x, queries, k):
    out = []
    for q in queries:
        scores = sorted((-sum(int(256 * a) * int(256 * b) for a, b in zip(x[q], v)), i) for i, v in enumerate(x) if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("size", [2**17, 2**21])
def test_scores_are_exact_as_doubles_and_as_longs(spark, size):
    rng = np.random.default_rng(5)
    x = [[float(a), float(-a), float(b)] for a, b in zip(rng.integers(size - 9, size, 40), rng.integers(0, 200, 40))]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = kd_search.top_k(df, F.col("vec_id") % 4 == 0, shard_rows=10, block_queries=3)
    assert sorted(tuple(r) for r in got.collect()) == long_scores(x, range(0, 40, 4), 5)


def test_sums_may_leave_64_bits_where_scores_do_not(spark):
    x = [[2.0**27, 2.0**27, 3.0], *[[float(2**27 - i), float(i - 2**27), float(i * i % 37)] for i in range(30)]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = kd_search.top_k(df, F.col("vec_id") == 0, shard_rows=10)
    assert sorted(tuple(r) for r in got.collect()) == long_scores(x, [0], 5)
    with pytest.raises(Exception, match="(?i)overflow|too large|too big"):  # 2 * 2**70
        kd_search.top_k(df, F.col("vec_id") == 5, shard_rows=10).collect()


def test_a_component_beyond_64_bits_raises(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        kd_search.top_k(df, F.col("vec_id") == 0).collect()


def test_a_shard_builds_its_tree_once_for_a_part_of_the_blocks():
    shard = kd_search.Shard(np.arange(3), 1, np.arange(3, dtype=np.int64).tobytes())
    for q in (1, 2):
        assert shard.search([9], 1, np.array([q], np.int64).tobytes(), [-np.inf], 1).values.tolist() == [[9, 2, 2 * q]]
    assert len(shard.trees) == 1


def test_more_hits_than_the_beam(spark):
    x = vectors(300, seed=9)
    got = nn_descent.nearest(frame(spark, x), F.col("vec_id") % 100 == 0, k=100)
    counts = {r["query_id"]: r["count"] for r in got.groupBy("query_id").count().collect()}
    assert counts == {0: 100, 100: 100, 200: 100}


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19)), 3.0 * i], None, None) for i in range(12)]
    got = kd_search.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, k=3).collect()
    assert sorted(tuple(r) for r in got) == brute([(r[0], r[1]) for r in rows], 100, 3)


def test_few_and_no_vectors(spark):
    assert kd_search.top_k(frame(spark, vectors(0)), F.lit(True)).count() == 0
    assert kd_search.top_k(frame(spark, vectors(3)), F.lit(True)).count() == 6
    assert nn_descent.nearest(frame(spark, vectors(0)), F.lit(True)).count() == 0
    assert nn_descent.nearest(frame(spark, vectors(3)), F.lit(True)).count() == 6


def test_tree_prunes_but_finds_all():
    rng = np.random.default_rng(0)
    points = rng.integers(-200, 200, (3000, 3)).astype(np.float64)
    tree = kd_search.Tree(np.arange(3000), points, leaf=16)
    q = np.array([5.0, -3.0, 1.0])
    exact = sorted(((float(s), -i) for i, s in enumerate(points @ q)), reverse=True)[:5]
    assert tree.search(q, -1, 5, -np.inf) == [(s, -i) for s, i in exact]
    assert tree.search(q, -1, 5, exact[2][0]) == [(s, -i) for s, i in exact if s >= exact[2][0]]


def recall(got, x, every, k):
    ids = np.arange(len(x))
    hit = total = 0
    for q in ids[::every]:
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        best = set(np.argsort(-s, kind="stable")[:k].tolist())
        hit += len(best & {r.vec_id for r in got if r.query_id == q})
        total += k
    return hit / total


def test_recall_and_scores(spark):
    x = vectors(3000, dim=32)
    x[10:400] = x[9] + 1e-4 * np.random.default_rng(3).normal(size=(390, 32))  # a hot vector
    got = nn_descent.nearest(frame(spark, x, [(8020, [0.0] * 32, None, None), *ODD]), F.col("vec_id") % 60 == 0, k=20).collect()
    assert recall(got, x, 60, 20) >= 0.9
    for r in got[:200]:
        assert r.score == pytest.approx(float(x[r.query_id].astype(float) @ x[r.vec_id].astype(float)), abs=1e-12)
    for q in {r.query_id for r in got}:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert q not in [r.vec_id for r in own] and 8020 not in [r.vec_id for r in own] and len(own) == 20


@pytest.mark.parametrize("spread,huge", [(0.0, 1e5), (3.0, 1e7)])
def test_recall_with_norms_of_any_size(spark, spread, huge):
    x = vectors(2500, dim=24).astype(float)
    x *= 10 ** np.random.default_rng(8).uniform(-spread, spread, (len(x), 1))
    x[7] *= huge
    got = nn_descent.nearest(frame(spark, x.astype(np.float32)), F.col("vec_id") % 50 == 0, k=20).collect()
    assert recall(got, x.astype(np.float32), 50, 20) >= 0.9


def test_lists_only_get_closer(spark):
    x = vectors(1500, seed=9)
    table = frame(spark, x)
    one = nn_descent._weight(nn_descent.build_index(table, rounds=0, degree=15).lists)
    more = nn_descent._weight(nn_descent.build_index(table, rounds=3, degree=15).lists)
    assert more > one
