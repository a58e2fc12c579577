"""Approximate nearest neighbours by NN-descent and greedy graph search.

Graph.  Every vector keeps a list of its closest others.  First lists come
from blocks of vectors on the same side of random hyperplanes.  Then rounds of
NN-descent: a neighbour of a neighbour is likely a neighbour, so for every
node the vectors on its list and those that list it meet in a join, are
compared pairwise, and improve each other's lists; the rounds end when hardly
any list changes.  Nodes travel in blocks of neighbours-by-hyperplane, so that
a vector is sent once for the many lists of a block that name it.

Search.  A query starts at its own list and repeatedly opens the best nodes it
has not opened yet, joining their lists and vectors, until its best hits are
all opened.

Nearness is the inner product.  Norms may differ by any factor, so vectors
are dealt into bands within which norms differ by less than 4, and each band
has its own graph.  In a band, vectors are scaled by the band's upper norm and
given one more component that makes all norms equal, so that closeness in the
graph is closeness of direction and size; a query's extra component is 0,
which makes its score proportional to the inner product.  Hyperplanes see
directions only.  Scaled vectors are kept in single precision, and as one
scale holds for a band only, a huge vector takes nothing from the others.  A
query searches every band, from its own list in its own band and from the
best of some spread rows in the others.  Final scores are inner products of
the original vectors in double precision.

The index holds every row.  It is approximate: ``degree``, ``beam`` and the
bound on how many nodes that list a node take part in one round trade time for
recall, which the tests measure against brute force.

Defined cases: vectors that are null, zero, or hold null or non-finite
components, and rows with a null id, take no part; vectors of unequal length
compare as if the shorter had zeros at its end; a query skips its own id;
repeated vectors each count; with fewer than k candidates all are returned
where the graph reaches them; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import discard, parallelism, staged, usable_vector

DEGREE = 60
#: Nodes that list a node, taking part in one round, at most.
REVERSE = 60
ROUNDS = 10
#: Rounds end when all lists together come closer by less than this share.
SETTLED = 1e-3
FORESTS = 3
BLOCK_ROWS = 512
#: Hits a search keeps, and nodes it opens at once.
BEAM = 48
OPEN = 8
SEARCH_ROUNDS = 8
SEED = 5
#: A band's norms span this power of two, downwards from the largest norm.
BAND_BITS = 2
#: Rows of another band that a query looks at to find where to start there.
PIVOTS = 512
#: Codes of a band start at its number times this.
BAND_CODES = 1 << 40


def _vectors(table: pa.Table, column: str = "v") -> np.ndarray:
    raw = table.column(column).to_pylist()
    return np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1) if raw else np.zeros((0, 1), np.float32)


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _ints(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64)


def _lengths(table: pa.Table, column: str) -> np.ndarray:
    return np.diff(table.column(column).combine_chunks().offsets.to_numpy()).astype(np.int64) if table.num_rows else np.zeros(0, np.int64)


def best_per(owner: np.ndarray, other: np.ndarray, near: np.ndarray, k: int):
    """The k nearest distinct others of each owner, nearest first."""
    order = np.lexsort((-near, other, owner))
    owner, other, near = owner[order], other[order], near[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    fresh &= owner != other
    owner, other, near = owner[fresh], other[fresh], near[fresh]
    order = np.lexsort((other, -near, owner))
    owner, other, near = owner[order], other[order], near[order]
    start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    keep = rank < k
    return owner[keep], other[keep], near[keep]


def _listed(owner, other, near, names=("id", "others", "near")) -> pa.Table:
    """One row per owner with its others and their nearness."""
    start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    cuts = pa.array(np.append(start, len(owner)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (other.astype(np.int64), near.astype(np.float32))]
    return pa.table([pa.array(owner[start].astype(np.int64)), *lists], names=list(names))


LISTS = "id long, others array<long>, near array<float>"


class Index:
    """Vectors (id, band, v, codes) and lists (id, others, near), both in shared storage; the bands that have rows."""

    def __init__(self, vectors: DataFrame, lists: DataFrame, bands: list[int]):
        self.vectors, self.lists, self.bands = vectors, lists, bands


def _log_norm(x: Column) -> Column:
    """Binary logarithm of a usable vector's norm, without overflow of its squares."""
    most = F.array_max(F.transform(x, F.abs))
    return F.log2(most) + F.log2(F.aggregate(x, F.lit(0.0), lambda a, c: a + (c / most) * (c / most))) / 2


def _prepared(rows: DataFrame, top: float, width: int, sizes: dict[int, int]) -> DataFrame:
    """(id, band, v, codes): vectors scaled to their band's upper norm and made
    of equal norm, and their block in every forest."""
    bits_of = {band: max(0, int(np.ceil(np.log2(n / BLOCK_ROWS)))) for band, n in sizes.items()}
    bits = max(bits_of.values(), default=0)
    planes = np.random.default_rng(SEED).standard_normal((FORESTS, bits, width + 1)).astype(np.float32)

    def run(batches):
        for batch in batches:
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            v = np.zeros((batch.num_rows, width + 1))
            at = np.repeat(np.arange(batch.num_rows), lengths)
            inner = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            v[at, inner] = flat
            v /= np.abs(v).max(axis=1, keepdims=True)
            v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
            band = batch.column(3).to_numpy()
            used = np.array([bits_of.get(b, 0) for b in band.tolist()], np.int64)
            code = np.repeat((band * BAND_CODES)[:, None], FORESTS, axis=1)
            turned = (v - v.mean(axis=1, keepdims=True)).astype(np.float32)
            for f in range(FORESTS if bits else 0):
                code[:, f] += ((turned @ planes[f].T > 0) & (np.arange(bits) < used[:, None])) @ (1 << np.arange(bits, dtype=np.int64))
            size = np.minimum(1.0, np.exp2(batch.column(2).to_numpy() - (top - BAND_BITS * band)))
            v *= size[:, None]
            v[:, width] = np.sqrt(1.0 - size * size)
            codes = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * FORESTS), pa.array(code.ravel()))
            raw = pa.array([r.tobytes() for r in v.astype(np.float32)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), raw, codes], ["id", "band", "v", "codes"])

    return rows.select("id", "x", "size", "band").mapInArrow(run, "id long, band long, v binary, codes array<long>")


def _first_lists(vectors: DataFrame, degree: int) -> DataFrame:
    """Closest others inside the blocks of every forest; large blocks are cut in pieces."""
    in_forest = vectors.select("id", "v", F.posexplode("codes").alias("forest", "code"))
    size = in_forest.groupBy("forest", "code").agg(F.ceil(F.count("*") / F.lit(2 * BLOCK_ROWS)).alias("pieces"))
    in_forest = in_forest.join(size, ["forest", "code"]).withColumn("piece", F.pmod(F.xxhash64("id", "forest"), F.col("pieces")))

    def run(table: pa.Table) -> pa.Table:
        ids, v = _ints(table, "id"), _vectors(table)
        near = v @ v.T
        k = min(degree + 1, len(ids))
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        owner = np.repeat(ids, k)
        return _listed(*best_per(owner, ids[top.ravel()], np.take_along_axis(near, top, 1).ravel(), degree))

    return in_forest.groupBy("forest", "code", "piece").applyInArrow(run, LISTS)


def _merged(lists: DataFrame, degree: int, parts: int) -> DataFrame:
    """One list per node from many: the nearest distinct others."""

    def run(table: pa.Table) -> pa.Table:
        owner = np.repeat(_ints(table, "id"), _lengths(table, "others"))
        return _listed(*best_per(owner, _flat(table, "others"), _flat(table, "near"), degree))

    placed = lists.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    return placed.groupBy("part").applyInArrow(run, LISTS)


def _round(vectors: DataFrame, lists: DataFrame, blocks: DataFrame, degree: int) -> DataFrame:
    """New list entries: everybody around a node compared with everybody else around it."""
    forward = lists.select("id", F.explode("others").alias("other"))
    listing = forward.select(F.col("other").alias("id"), F.col("id").alias("other"))
    turn = W.partitionBy("id").orderBy(F.xxhash64("id", "other"), "other")
    listing = listing.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= REVERSE).drop("turn")
    around = forward.union(listing).groupBy("id").agg(F.collect_set("other").alias("around"))
    around = around.join(blocks, "id")
    worst = lists.select("id", F.when(F.size("near") >= degree, F.element_at("near", -1)).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    named = around.select("block", F.explode("around").alias("id")).distinct().select(F.col("block").alias("at"), "id")
    sent = named.join(vectors.select("id", "v"), "id").join(worst, "id")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, v, limit = _ints(right, "id"), _vectors(right), right.column("worst").to_numpy()
        order = np.argsort(ids)
        ids, v, limit = ids[order], v[order], limit[order]
        cuts = np.append(0, np.cumsum(_lengths(left, "around")))
        rows = np.searchsorted(ids, _flat(left, "around")) if left.num_rows else np.zeros(0, np.int64)
        owner, other, near = [], [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = rows[a:b]
            close = v[own] @ v[own].T
            i, j = np.nonzero(close > limit[own][:, None])
            away = i != j
            owner.append(own[i[away]])
            other.append(own[j[away]])
            near.append(close[i[away], j[away]])
            if sum(map(len, owner)) > 2_000_000:
                owner, other, near = ([x] for x in best_per(*(np.concatenate(x) for x in (owner, other, near)), degree))
        if not owner:
            return _listed(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        a, b, c = best_per(*(np.concatenate(x) for x in (owner, other, near)), degree // 2)
        return _listed(ids[a], ids[b], c)

    return around.groupBy("block").cogroup(sent.groupBy("at")).applyInArrow(run, LISTS)


def build_index(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", degree: int = DEGREE, rounds: int = ROUNDS) -> Index:
    """NN-descent over all usable rows of ``table``."""
    used = table.where(usable_vector(F.col(vector_col), allow_zero=False) & F.col(id_col).isNotNull())
    rows = used.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.withColumn("size", _log_norm(F.col("x")))
    top, width = rows.agg(F.max("size"), F.max(F.size("x"))).first()
    top = top or 0.0
    rows = rows.withColumn("band", F.floor((F.lit(top) - F.col("size")) / BAND_BITS).cast("long"))
    # Exponents of doubles are few, and so are bands.
    sizes = {r.band: r["count"] for r in rows.groupBy("band").count().collect()}
    vectors = _prepared(rows, top, width or 1, sizes)
    vectors = staged(vectors.dropDuplicates(["id"]), "ann-vectors")
    parts = 2 * parallelism(table.sparkSession)
    # A node's block: its first code, large ones cut in pieces.
    code = F.col("codes")[0]
    size = vectors.groupBy(code.alias("c")).agg(F.ceil(F.count("*") / F.lit(2 * BLOCK_ROWS)).alias("pieces"))
    blocks = vectors.select("id", code.alias("c")).join(size, "c")
    blocks = staged(blocks.select("id", F.xxhash64("c", F.pmod(F.xxhash64("id"), F.col("pieces"))).alias("block")), "ann-blocks")
    lists = staged(_merged(_first_lists(vectors, degree), degree, parts), "ann-lists")
    held = _weight(lists)
    for _ in range(rounds):
        lists, last = staged(_merged(lists.union(_round(vectors, lists, blocks, degree)), degree, parts), "ann-lists"), lists
        discard(last)
        now = _weight(lists)
        if now - held <= SETTLED * abs(now):
            break
        held = now
    return Index(vectors, lists, sorted(sizes))


def _weight(lists: DataFrame) -> float:
    """Sum of all nearness on the lists, which rounds can only raise."""
    return lists.agg(F.sum(F.aggregate("near", F.lit(0.0), lambda a, x: a + x.cast("double")))).first()[0] or 0.0


def _entered(index: Index, asked: DataFrame, beam: int, parts: int) -> DataFrame:
    """First states in the bands that are not a query's own: the best of the
    band's pivots, of which the very best are opened first."""
    order = W.partitionBy("band").orderBy(F.xxhash64("id", F.lit(SEED)), "id")
    pivots = index.vectors.select("band", "id", "v").withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= PIVOTS).drop("turn")
    pivots = pivots.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    bands = F.array(*[F.lit(b).cast("long") for b in index.bands])
    others = asked.select("query_id", "q", F.explode(F.array_except(bands, F.array("own"))).alias("goal"))
    others = others.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, goal = _vectors(left, "q").copy(), _ints(left, "goal")
        q[:, -1] = 0  # as in the rounds of the search
        ids, band, v = _ints(right, "id"), _ints(right, "band"), _vectors(right)
        rows = {b: np.flatnonzero(band == b) for b in set(goal.tolist())}
        out = [[], [], [], []]
        for i, b in enumerate(goal.tolist()):
            near = v[rows[b]] @ q[i]
            best = np.lexsort((ids[rows[b]], -near))[:beam]
            found = ids[rows[b]][best].tolist()
            for column, value in zip(out, (found, near[best].tolist(), [], found[:OPEN])):
                column.append(value)
        arrays = [pa.array(c, pa.list_(t)) for c, t in zip(out, (pa.int64(), pa.float32(), pa.int64(), pa.int64()))]
        return pa.table([left.column("query_id"), left.column("q"), *arrays], names=["query_id", "q", "ids", "scores", "opened", "frontier"])

    shape = "query_id long, q binary, ids array<long>, scores array<float>, opened array<long>, frontier array<long>"
    return others.groupBy("part").cogroup(pivots.groupBy("at")).applyInArrow(run, shape)


def search(index: Index, queries: DataFrame, k: int, beam: int = BEAM, rounds: int = SEARCH_ROUNDS) -> DataFrame:
    """(query_id, vec_id): the best hits of greedy search; ``queries`` has the ids of indexed rows."""
    beam = max(beam, 2 * k)  # never fewer than what is asked for
    parts = 2 * parallelism(queries.sparkSession)
    part = F.pmod(F.xxhash64("task"), F.lit(parts))
    vectors = index.vectors.select("id", "v")
    back = index.lists.select("id", F.explode(F.slice("others", 1, 20)).alias("other")).select(F.col("other").alias("id"), F.col("id").alias("other"))
    turn = W.partitionBy("id").orderBy(F.xxhash64("id", "other"), "other")
    back = back.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= REVERSE).groupBy("id").agg(F.collect_list("other").alias("back"))
    edges = index.lists.join(back, "id", "left").select("id", F.array_union("others", F.coalesce("back", F.array().cast("array<long>"))).alias("others"))
    edges = staged(edges, "ann-edges")
    asked = queries.select(F.col("id").alias("query_id")).distinct()
    asked = asked.join(index.vectors.select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("band").alias("own")), "query_id")
    none = [F.array().cast(t).alias(c) for c, t in (("ids", "array<long>"), ("scores", "array<float>"), ("opened", "array<long>"))]
    state = asked.select("query_id", "q", *none, F.array("query_id").alias("frontier"))
    if len(index.bands) > 1:
        state = state.union(_entered(index, asked, beam, parts))
    # A task is a query in a band; numbers hold once the table is staged.
    state = state.select(F.monotonically_increasing_id().alias("task"), "*")
    held = None
    for turn_no in count():
        last, state = held, staged(state, "ann-search")
        discard(last)
        held = state
        going = F.size("frontier") > 0
        if turn_no >= rounds:  # further only where hits are missing
            going = going & (F.size("ids") < k)
        if turn_no and state.where(going).isEmpty():
            break
        opening = state.select("task", F.explode("frontier").alias("id"))
        met = opening.join(edges, "id").groupBy("task").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("met"))
        fresh = state.select("task", "query_id", "ids").join(met, "task")
        fresh = fresh.select("task", "query_id", F.explode(F.array_except("met", "ids")).alias("id")).where("id <> query_id")
        fresh = fresh.join(vectors, "id").select(part.alias("at"), F.col("task").alias("asker"), "id", "v")

        def step(left: pa.Table, right: pa.Table) -> pa.Table:
            q, asker = _vectors(left, "q").copy(), _ints(left, "task")
            if q.shape[1] > 1:
                q[:, -1] = 0  # the extra component is the candidates' own
            row = np.argsort(asker)
            place = row[np.searchsorted(asker[row], _ints(right, "asker"))] if right.num_rows else np.zeros(0, np.int64)
            fresh_ids = _ints(right, "id")
            score = np.einsum("ij,ij->i", q[place], _vectors(right)) if right.num_rows else np.zeros(0, np.float32)
            order = np.argsort(place, kind="stable")
            place, fresh_ids, score = place[order], fresh_ids[order], score[order]
            cuts = np.searchsorted(place, np.arange(len(asker) + 1))
            old_ids, old_scores, opened, frontier = (left.column(c).to_pylist() for c in ("ids", "scores", "opened", "frontier"))
            out = [[], [], [], []]
            for i in range(len(asker)):
                ids = np.concatenate([np.array(old_ids[i], np.int64), fresh_ids[cuts[i] : cuts[i + 1]]])
                near = np.concatenate([np.array(old_scores[i], np.float32), score[cuts[i] : cuts[i + 1]]])
                best = np.lexsort((ids, -near))[:beam]
                done = set(opened[i]) | set(frontier[i])
                heads = [x for x in ids[best][: k + OPEN].tolist() if x not in done][:OPEN]
                for column, value in zip(out, (ids[best].tolist(), near[best].tolist(), sorted(done), heads)):
                    column.append(value)
            arrays = [pa.array(c, pa.list_(t)) for c, t in zip(out, (pa.int64(), pa.float32(), pa.int64(), pa.int64()))]
            return pa.table([*(left.column(c) for c in ("task", "query_id", "q")), *arrays], names=["task", "query_id", "q", "ids", "scores", "opened", "frontier"])

        shape = "task long, query_id long, q binary, ids array<long>, scores array<float>, opened array<long>, frontier array<long>"
        state = state.withColumn("part", part).groupBy("part").cogroup(fresh.groupBy("at")).applyInArrow(step, shape)
    # A few more than k: single precision may order close ones differently.
    hits = staged(state.select("query_id", F.explode(F.slice("ids", 1, k + OPEN)).alias("vec_id")), "ann-hits")
    discard(held, edges)
    return hits


def nearest(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each query row."""
    index = build_index(table, id_col, vector_col)
    flagged = table.where(F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"))
    hits = search(index, flagged, k)
    usable = usable_vector(F.col(vector_col), allow_zero=False)
    x = table.where(usable).select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).cast("array<double>").alias("x")).dropDuplicates(["i"])
    scored = hits.join(x.withColumnsRenamed({"i": "vec_id", "x": "a"}), "vec_id").join(x.withColumnsRenamed({"i": "query_id", "x": "b"}), "query_id")
    short = F.least(F.size("a"), F.size("b"))
    product = F.aggregate(F.zip_with(F.slice("a", F.lit(1), short), F.slice("b", F.lit(1), short), lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    scored = scored.select("query_id", "vec_id", product.alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
