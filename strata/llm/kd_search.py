"""Exact top-k inner products with one KD-tree per shard.

Vectors are cut into shards of bounded size by a hash of their id; a shard is
one packed row.  Each shard gets a KD-tree: median splits along the widest
side, a tight box around the points of every node.  A query walks a tree best
first: the bound of a box is the largest product that any point in it could
have with the query, and a box is opened only while its bound reaches the kth
score found so far.

That kth score is propagated.  A first pass searches only the shard where a
query itself lives; its kth score is a lower limit that every other shard
starts from.  Equal scores are never cut off, so ties go to the smaller id.

Queries travel in blocks of bounded size.  A shard meets a bounded number of
blocks at a time, and its tree is built once for all of them.

Scores are exact: components are integers, multiplied in double precision
while every sum stays below 2**53, as 64-bit integers below 2**63, and as
Python's integers from there on.  A returned score that does not fit a long,
or a component that does not, raises.

Defined cases: vectors that are null or hold null or non-finite components,
and rows with a null id, take no part; vectors of unequal length are compared
as if the shorter had zeros at its end; a query skips rows with its own id;
repeated vectors each count; with fewer than k candidates all are returned;
an empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import parallelism, staged, usable_vector

#: Points in a leaf.
LEAF = 128
#: Points in a shard, and queries in a block, on average.
SHARD_ROWS = 16_384
BLOCK_QUERIES = 512
#: Blocks that meet a shard in one group, at most on average.
MEET_BLOCKS = 64

PACKED = "shard int, ids array<long>, dim int, data binary"
HITS = "query_id vec_id score"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component x, taken as a double; one outside 64 bits raises."""

    def one(x: Column) -> Column:
        scaled = x * F.lit(float(scale))
        fits = (scaled >= F.lit(-(2.0**63))) & (scaled < F.lit(2.0**63))
        return F.when(fits, F.floor(scaled).cast("long")).otherwise(F.raise_error(F.lit("a component does not fit 64 bits")).cast("long"))

    return F.transform(vector.cast("array<double>"), one)


class Tree:
    """KD-tree over integer points: median splits, tight boxes, points in leaf order."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(ids))
        low, high, kids, spans = [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            part = points[self.order[a:b]]
            node = len(spans)
            lo, hi = part.min(axis=0), part.max(axis=0)
            low.append(lo)
            high.append(hi)
            kids.append([-1, -1])
            spans.append((a, b))
            if parent >= 0:
                kids[parent][side] = node
            wide = int(np.argmax(hi - lo))
            if b - a > leaf and hi[wide] > lo[wide]:
                half = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(part[:, wide], half, kind="introselect")]
                todo += [(a, a + half, node, 0), (a + half, b, node, 1)]
        self.ids, self.points = ids[self.order], points[self.order]
        self.spans = spans
        self.kids = [tuple(k) for k in kids]
        # Per inner node the boxes of both children, for one product with a query.
        self.low, self.high = np.array(low), np.array(high)

    def search(self, query: np.ndarray, own: int, k: int, least: float) -> list[tuple[float, int]]:
        """Up to k (score, id) of at least ``least``, best first, ties to the smaller id."""
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        bounds = self.high @ plus + self.low @ minus
        best: list[tuple[float, int]] = []  # heap; the worst of the best on top
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least:
                break
            left, right = self.kids[node]
            if left >= 0:
                for kid in (left, right):
                    if bounds[kid] >= least:
                        heapq.heappush(queue, (-bounds[kid], kid))
                continue
            a, b = self.spans[node]
            scores = self.points[a:b] @ query
            for i in np.flatnonzero(scores >= least).tolist():
                if (who := int(self.ids[a + i])) == own:
                    continue
                item = (scores[i], -who)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _matrix(data: bytes, rows: int, dim: int, width: int) -> np.ndarray:
    out = np.zeros((rows, width), np.int64)
    out[:, :dim] = np.frombuffer(data, np.int64).reshape(rows, dim)
    return out


class Shard:
    """A shard's points, with a tree for each kind of number its queries need."""

    def __init__(self, ids: np.ndarray, dim: int, data: bytes):
        self.ids, self.dim, self.data = np.asarray(ids, np.int64), dim, data
        self.most = _most(np.frombuffer(data, np.int64))
        self.trees: dict[tuple[int, type], Tree] = {}

    def search(self, ids, dim, data, least, k: int) -> pd.DataFrame:
        """Hits of a block of queries: query, id and score."""
        width = max(self.dim, dim, 1)
        queries = _matrix(data, len(ids), dim, width)
        top = self.most * _most(queries) * width
        kind = np.float64 if top < 2**53 else np.int64 if top < 2**63 else object
        if (width, kind) not in self.trees:
            self.trees[width, kind] = Tree(self.ids, _matrix(self.data, len(self.ids), self.dim, width).astype(kind))
        tree, found = self.trees[width, kind], []
        for q, own, limit in zip(queries.astype(kind), ids, least, strict=True):
            found += [(int(own), who, int(score)) for score, who in tree.search(q, int(own), k, limit)]
        return pd.DataFrame(found, columns=HITS.split(), dtype=object).astype("int64")


def _most(values: np.ndarray) -> int:
    """The largest absolute value, as an exact integer."""
    return max(-int(values.min(initial=0)), int(values.max(initial=0)))


def _pack(pdf: pd.DataFrame, key: str) -> pd.DataFrame:
    """One row for a group: its ids, its width, and the matrix as bytes."""
    dim = max((len(v) for v in pdf["v"]), default=0)
    data = np.zeros((len(pdf), dim), np.int64)
    for row, v in zip(data, pdf["v"], strict=True):
        row[: len(v)] = v
    return pd.DataFrame({key: [pdf[key].iloc[0]], "ids": [pdf["id"].to_numpy()], "dim": [dim], "data": [data.tobytes()]})


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest integer inner products per query."""
    used = vectors.where(usable_vector(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = used.select(
        F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    rows = staged(rows, "kd-rows")
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asking // block_queries))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(shards)).cast("int"))
    packed = staged(
        rows.select("shard", "id", "v").groupBy("shard").applyInPandas(lambda pdf: _pack(pdf, "shard"), PACKED), "kd-shards"
    )
    asks = rows.where("asks").select("shard", "id", "v")

    # First pass: each query in the shard it lives in, for a lower limit of its kth score.
    home = asks.groupBy("shard").applyInPandas(lambda pdf: _pack(pdf, "shard"), PACKED)
    home = home.select("shard", F.struct("ids", "dim", "data").alias("q"))

    def first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                hits = Shard(r.ids, r.dim, r.data).search(r.q["ids"], r.q["dim"], r.q["data"], [-np.inf] * len(r.q["ids"]), k)
                full = hits.groupby("query_id")["score"].agg(["size", "min"])
                kth = full["min"].where(full["size"] >= k).dropna().astype("int64")
                yield pd.DataFrame({"id": kth.index.to_numpy(np.int64), "least": kth.to_numpy()})

    limits = packed.join(home, "shard").mapInPandas(first_pass, "id long, least long")
    limits = limits.groupBy("id").agg(F.min("least").alias("least"))

    # Second pass: every block of queries against every shard, from that limit on.
    block = F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(blocks)).cast("int")
    with_limit = asks.join(limits, "id", "left").select(block.alias("block"), "id", "v", "least")

    def pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _pack(pdf, "block")
        # The next double below: a long limit beyond 2**53 must not be rounded up.
        out["least"] = [np.nextafter(pdf["least"].to_numpy(np.float64, na_value=-np.inf), -np.inf)]
        return out

    asked = with_limit.groupBy("block").applyInPandas(pack_block, "block int, ids array<long>, dim int, data binary, least array<double>")
    # A shard meets the blocks of one part at a time; few shards meet smaller parts, so that all cores have work.
    parts = min(blocks, max(-(-blocks // MEET_BLOCKS), -(-2 * parallelism(vectors.sparkSession) // shards)))
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (shards, parts)]
    asked = asked.withColumn("part", F.pmod("block", F.lit(parts))).select("*", every[0].alias("shard"))
    held = packed.select("*", every[1].alias("part"))
    asked, held = (t.repartition(shards * parts, "shard", "part") for t in (asked, held))

    def second_pass(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame(columns=HITS.split(), dtype="int64")]
        for r in left.itertuples(index=False):  # one row, or none
            shard = Shard(r.ids, r.dim, r.data)
            found += [shard.search(q.ids, q.dim, q.data, q.least, k) for q in right.itertuples(index=False)]
        return pd.concat(found, ignore_index=True)

    pairs = held.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part"))
    hits = pairs.applyInPandas(second_pass, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
