"""N-gram Jaccard join with signature trees.

Documents become sets of word shingles; equal sets are one class.  Two classes
link when 100 * intersection >= 80 * union.

Groups.  Shingles are put in one order for all sets: rare ones by hash, then
the frequent ones (counted over the whole corpus) by count.  Sets as similar
as asked for share a shingle among the first |x| - ceil(0.8 |x|) + 1 of their
order, so classes that share such a shingle form a group, and every link lies
inside some group.  Taken l shingles further, two such sets share l + 1: a
class whose longer prefix has fewer shingles in common with all others links
with nothing, and only the classes that are left ever get their sets made.
The order only decides how large groups get, never what is found: the table
of frequent shingles may be cut to its bound freely.

Neighbourhoods.  Classes take the least class within two steps over groups as
their label; those with one label are a neighbourhood, cut into blocks of
bounded size.  A block is a cell, and its sets travel there once, however many
groups they are in.  Where groups reach over blocks, two blocks are a cell.

Trees.  Within a cell classes are sorted by size and content into a signature
tree.  A class has a bitmap of its shingles with two to four bits a shingle; a
node holds the OR of its bitmaps, the range of sizes, the largest number of
shingles beyond the bits set, and the component of its classes if they share
one.  Two nodes are walked down together only while sizes and the largest
possible overlap -- common bits plus the smaller excess -- still allow a link,
and only while they are not one component already: what is linked need not be
linked again.

Rounds.  In a cell each class first proposes its closest partner, twice;
proposals are verified on the exact sets and components formed.  This
collapses large groups of near copies with few pairs.  The last round walks
the tree again and verifies all pairs left between different components.
Blocks go first, each with one class of its neighbourhood that all its blocks
get; cells of two blocks then hold only what may link with another component.
The result is exact (on 64-bit shingle hashes).

Defined cases: null and wordless texts have the empty set and link with
nothing; texts of fewer than five words are one shingle of all words; repeated
rows and equal sets share a class and a component; a null id counts for a
component only if all ids are null; an empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import bytes_of, discard, parallelism, staged, text_batches
from strata.llm.components import components
from strata.llm.shingles import mix, shingle_sets

U = np.uint64
#: A shingle in this many documents of one task is reported as frequent.
FREQUENT = 4
#: Frequent shingles broadcast, at most (16 bytes each); only their order depends on it.
MAX_FREQUENT = 1 << 17
#: Prefix shingles that are dealt to buckets at once, about.
DEAL_SHINGLES = 1 << 19
#: Classes in a block of a neighbourhood, and in a leaf of a tree.
CHUNK = 1024
LEAF = 16
#: Shingles of a block's sets, about.
BLOCK_SHINGLES = 1 << 19
#: Classes whose sets a task of cells holds at once, about.
PART_ROWS = 2048
#: Shingles compared at once when pairs are verified, and words of their bits over all pairs.
VERIFY_SHINGLES = 1 << 13
VERIFY_WORDS = 1 << 20
#: Words of the filter that names documents whose sets are needed, at most; beyond that more are made than needed.
MAX_WORDS = 1 << 20
BITS_PER_SHINGLE = 2


def class_of(shingles: np.ndarray) -> int:
    """64-bit id of a set."""
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap_of(shingles: np.ndarray) -> np.ndarray:
    """Bitmap over hashed shingles; its width is a power of two of at least 64 bits."""
    width = max(64, 1 << (BITS_PER_SHINGLE * len(shingles) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(mix(shingles) & U(width - 1)).astype(np.intp)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def prefix_length(n):
    """Shingles of a set of n among which a partner must share one."""
    return n - (8 * n + 9) // 10 + 1


def shared_length(n):
    """Shingles that two sets of n or more share, if they link, in prefixes longer by one less."""
    return (n + 9) // 10


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def frequent_shingles(docs: DataFrame, text_col: str) -> np.ndarray:
    """Frequent shingles, sorted by hash, with their rank by count (two rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= FREQUENT
            return pa.RecordBatch.from_arrays([pa.array(found[keep].view(np.int64)), pa.array(n[keep])], ["s", "n"])

        for batch in text_batches(batches):
            held += shingle_sets(batch.column(0))
            size = sum(map(len, held))
            if size > 6_000_000:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    rows = docs.select(_text(text_col)).mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "s").limit(MAX_FREQUENT).toArrow()
    shingles = np.asarray(top.column(0), np.int64).view(np.uint64)
    rank = np.arange(len(shingles), 0, -1).astype(np.uint64)  # the most frequent come last
    order = np.argsort(shingles)
    return np.stack([shingles[order], rank[order]])


def _prefixes(sets: list[np.ndarray], frequent: np.ndarray) -> list[np.ndarray]:
    """The longer prefix of each set, the shingles among which a partner must share one before the others."""
    if not sets:
        return []
    shingles = np.concatenate(sets)
    key = mix(shingles) >> U(1)
    known, rank = frequent
    if len(known):
        met = np.zeros(1 << 20, bool)
        met[(known >> U(44)).astype(np.intp)] = True
        maybe = np.flatnonzero(met[(shingles >> U(44)).astype(np.intp)])
        at = np.minimum(np.searchsorted(known, shingles[maybe]), len(known) - 1)
        same = known[at] == shingles[maybe]
        key[maybe[same]] = U(1 << 63) | rank[at[same]]
    out, low = [], 0
    for s in sets:
        first = prefix_length(len(s))
        length = first - 1 + shared_length(len(s))
        order = np.argpartition(key[low : low + len(s)], (first - 1, length - 1))[:length]
        out.append(s[order])
        low += len(s)
    return out


def described(docs: DataFrame, frequent: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, n, class, prefix): each row's set in short; the mixed prefix once a task for each class."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in text_batches(batches):
            sets = shingle_sets(batch.column(1))
            ids = [class_of(s) if len(s) else None for s in sets]
            fresh = []
            for i, own in enumerate(ids):
                if own is not None and own not in seen:
                    seen.add(own)
                    fresh.append(i)
            prefix = [None] * len(sets)
            for i, first in zip(fresh, _prefixes([sets[i] for i in fresh], shared.value)):
                prefix[i] = mix(first).tobytes()
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(ids, pa.int64()), pa.array(prefix, pa.binary())], ["id", "n", "class", "prefix"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), _text(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n long, class long, prefix binary")


def groups(rows: DataFrame, buckets: int) -> DataFrame:
    """(gid, class, k): classes that share a prefix shingle, equal groups of a bucket once.

    Without a gid: how many shingles of its longer prefix (``k``, to be summed)
    a class shares with any other.  Shingles are told apart by their bucket and
    31 bits more; those taken for one only make groups and counts larger.
    """

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Classes that the task has not met yet, in batches of bounded prefixes."""
        seen = set()
        for batch in batches:
            fresh = [c not in seen and not seen.add(c) for c in batch.column("class").to_pylist()]
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            ends = bytes_of(batch.column("prefix"))[1][1:] // (8 * DEAL_SHINGLES)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(ends)) + 1, [len(ends)]])
            for low, high in zip(cuts[:-1], cuts[1:]):
                yield batch.slice(int(low), int(high - low))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, cuts = bytes_of(batch.column("prefix"))
            token, size = np.frombuffer(raw.tobytes(), np.uint64), np.diff(cuts) // 8
            owner = np.repeat(batch.column("class").to_numpy(), size)
            first = np.arange(len(token)) - np.repeat(cuts[:-1] // 8, size) < np.repeat(prefix_length(batch.column("n").to_numpy()), size)
            bucket = ((token >> U(32)) % U(buckets)).astype(np.uint16)
            short = (token & U(0x7FFFFFFF)).astype(np.uint32) | first.astype(np.uint32) << np.uint32(31)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[order])) for x in (short.view(np.int32), owner)]
            full = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), *(x.take(pa.array(full)) for x in lists)], ["bucket", "tokens", "owners"])

    def grouped(table: pa.Table) -> pa.Table:
        lists = table.column("tokens").combine_chunks()
        short = lists.flatten().to_numpy().view(np.uint32)
        owner = table.column("owners").combine_chunks().flatten().to_numpy()
        record = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        token = short & np.uint32(0x7FFFFFFF)
        order = np.argsort(token)
        size = np.diff(np.append(np.flatnonzero(np.append(True, token[order][1:] != token[order][:-1])[: len(order)]), len(order)))
        order = order[np.repeat(size > 1, size)]
        order = order[np.lexsort((record[order], owner[order], token[order]))]
        token, owner, record, first = token[order], owner[order], record[order], short[order] >> np.uint32(31) == 1
        # A class comes once from a task: its second shingle of one record was taken for the first one and counts.
        again = (token[1:] == token[:-1]) & (owner[1:] == owner[:-1])
        keep = np.append(True, ~again | (record[1:] == record[:-1]))[: len(token)]
        token, owner, first = token[keep], owner[keep], first[keep]

        def met(token, owner):
            """Rows, sorted by both, of tokens that several owners have; and where each token begins."""
            starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
            size = np.diff(np.append(starts, len(token)))
            many = np.maximum.reduceat(owner, starts) != np.minimum.reduceat(owner, starts) if len(starts) else np.zeros(0, bool)
            rows = np.flatnonzero(np.repeat(many, size))
            return rows, np.append(0, np.cumsum(size[many]))

        who, k = np.unique(owner[met(token, owner)[0]], return_counts=True)
        token, owner = token[first], owner[first]
        keep = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))[: len(token)]
        token, owner = token[keep], owner[keep]
        rows, cuts = met(token, owner)
        owner, size = owner[rows], np.diff(cuts)
        gid = mix(np.add.reduceat(mix(owner.view(np.uint64) ^ U(0x5BD1E995)), cuts[:-1])) if len(size) else np.zeros(0, np.uint64)
        once = np.zeros(len(gid), bool)
        once[np.unique(gid, return_index=True)[1]] = True
        gid, owner = np.repeat(gid[once], size[once]).view(np.int64), owner[np.repeat(once, size)]
        return pa.table({
            "gid": pa.concat_arrays([pa.nulls(len(who), pa.int64()), pa.array(gid)]),
            "class": np.concatenate([who, owner]),
            "k": np.concatenate([k, np.zeros(len(gid), np.int64)]),
        })

    dealt = rows.where("prefix IS NOT NULL").select("class", "n", "prefix").mapInArrow(deal, "bucket int, tokens array<int>, owners array<long>")
    return dealt.groupBy("bucket").applyInArrow(grouped, "gid long, class long, k long")


class Node:
    """A node of a signature tree over ``rows`` a..b of a sorted chunk."""

    __slots__ = ("a", "b", "bits", "low", "high", "excess", "comp", "kids")

    def __init__(self, a, b, bits, low, high, excess, comp, kids=()):
        self.a, self.b, self.bits, self.low, self.high, self.excess, self.comp, self.kids = a, b, bits, low, high, excess, comp, kids


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap (or rows of them) folded to fewer words; hashes fold alike."""
    if bits.shape[-1] == words:
        return bits
    return np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, words), axis=-2)


class Chunk:
    """Classes of a group sorted by size, their bitmaps, and the tree over them."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, comp: np.ndarray, bits: list[bytes]):
        maps = [np.frombuffer(x, np.uint64) for x in bits]
        order = sorted(range(len(ids)), key=lambda i: (len(maps[i]), int(n[i]), int(comp[i]), int(ids[i])))
        self.ids, self.n, self.comp = ids[order], n[order], comp[order]
        self.maps = [maps[i] for i in order]
        self.excess = self.n - np.array([int(np.bitwise_count(m).sum()) for m in self.maps])
        nodes = [self.leaf(a, min(a + LEAF, len(ids))) for a in range(0, len(ids), LEAF)]
        while len(nodes) > 1:
            nodes = [self.join(nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        self.root = nodes[0]

    def leaf(self, a: int, b: int) -> Node:
        words = min(len(m) for m in self.maps[a:b])
        bits = np.bitwise_or.reduce([folded(m, words) for m in self.maps[a:b]])
        one = self.comp[a] if (self.comp[a:b] == self.comp[a]).all() else None
        return Node(a, b, bits, int(self.n[a:b].min()), int(self.n[a:b].max()), int(self._excess(a, b, words).max()), one)

    def _excess(self, a: int, b: int, words: int) -> np.ndarray:
        return np.array([self.n[i] - np.bitwise_count(folded(self.maps[i], words)).sum() for i in range(a, b)])

    def join(self, kids: list[Node]) -> Node:
        if len(kids) == 1:
            return kids[0]
        words = min(len(k.bits) for k in kids)
        bits = np.bitwise_or.reduce([folded(k.bits, words) for k in kids])
        # Folding frees at most the bits it merges: the excess is taken anew where widths differ.
        excess = max(k.excess if len(k.bits) == words else int(self._excess(k.a, k.b, words).max()) for k in kids)
        one = kids[0].comp if all(k.comp is not None and k.comp == kids[0].comp for k in kids) else None
        return Node(kids[0].a, kids[-1].b, bits, min(k.low for k in kids), max(k.high for k in kids), excess, one, kids)


def may_link(x: Node, y: Node) -> bool:
    """False if no class below ``x`` can link with one below ``y`` of another component."""
    if x.comp is not None and x.comp == y.comp:
        return False
    if 4 * max(x.low, y.low) > 5 * min(x.high, y.high):
        return False
    words = min(len(x.bits), len(y.bits))
    common = int(np.bitwise_count(folded(x.bits, words) & folded(y.bits, words)).sum())
    slack = min(x.excess, y.excess)
    if len(x.bits) != len(y.bits):  # the wider one was folded: only the narrower excess still holds
        slack = x.excess if len(x.bits) == words else y.excess
    return 9 * (common + slack) >= 4 * (x.low + y.low)


def leaf_pairs(x: Chunk, y: Chunk) -> Iterator[tuple[Node, Node]]:
    """Dual traversal: pairs of leaves that may hold a link."""
    todo = [(x.root, y.root)]
    while todo:
        p, q = todo.pop()
        if not may_link(p, q) and p is not q:
            continue
        if p is q:
            if p.comp is not None:
                continue
            if p.kids:
                todo += [(a, b) for i, a in enumerate(p.kids) for b in p.kids[i:]]
            else:
                yield p, q
        elif p.kids or q.kids:
            split_p = p.kids and (not q.kids or p.b - p.a >= q.b - q.a)
            todo += [(k, q) for k in p.kids] if split_p else [(p, k) for k in q.kids]
        else:
            yield p, q


def open_pairs(x: Chunk, y: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of x, rows of y, closeness) that pass the bound for the pair itself."""
    for p, q in leaf_pairs(x, y):
        a, b = np.arange(p.a, p.b), np.arange(q.a, q.b)
        words = min(len(x.maps[i]) for i in a)
        words = min(words, min(len(y.maps[i]) for i in b))
        left, right = np.array([folded(x.maps[i], words) for i in a]), np.array([folded(y.maps[i], words) for i in b])
        common = np.bitwise_count(left[:, None, :] & right[None, :, :]).sum(axis=2, dtype=np.int64)
        over = [x.n[a] - np.bitwise_count(left).sum(axis=1, dtype=np.int64), y.n[b] - np.bitwise_count(right).sum(axis=1, dtype=np.int64)]
        most = common + np.minimum(over[0][:, None], over[1][None, :])
        na, nb = x.n[a][:, None], y.n[b][None, :]
        most = np.minimum(most, np.minimum(na, nb))
        fits = (9 * most >= 4 * (na + nb)) & (x.comp[a][:, None] != y.comp[b][None, :])
        if p is q:
            fits &= a[:, None] < b[None, :]
        i, j = np.nonzero(fits)
        if len(i):
            yield a[i], b[j], most[i, j] / (na + nb - most)[i, j]


def overlaps(sets: list[np.ndarray]):
    """A function that counts the shingles common to pairs (rows i, rows j) of the sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, name, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    names = np.cumsum(held > 1) - 1  # shingles of one set alone are common to no pair
    several = held[name] > 1
    owner, name = owner[several], names[name[several]]
    order = np.argsort(name, kind="stable")
    owner, name = owner[order], name[order]
    ends = np.searchsorted(name, np.arange(0, int(name[-1]) + VERIFY_SHINGLES + 1, VERIFY_SHINGLES)) if len(name) else np.zeros(1, int)

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        same = np.zeros(len(i), np.int64)
        for a, b in zip(ends[:-1], ends[1:]):
            at = name[a:b] - name[a] // VERIFY_SHINGLES * VERIFY_SHINGLES
            width = int(at[-1]) // 64 + 1
            bits = np.zeros((len(sets), width * 64), bool)
            bits[owner[a:b], at] = True
            bits = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
            step = max(1, VERIFY_WORDS // width)
            for low in range(0, len(i), step):
                same[low : low + step] += np.bitwise_count(bits[i[low : low + step]] & bits[j[low : low + step]]).sum(axis=1, dtype=np.int64)
        return same

    return common


def closest(i: np.ndarray, j: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The pairs that are the closest one of one of their rows."""
    ends, pick = np.concatenate([i, j]), np.concatenate([np.arange(len(i))] * 2)
    rank = np.lexsort((pick, -near[pick], ends))
    first = rank[np.concatenate([[True], ends[rank][1:] != ends[rank][:-1]])]
    return np.unique(pick[first])


def joined(comp: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """The least component that each class of a cell is in once all that link are joined.

    Classes of one component at first are joined already.
    """
    names, at = np.unique(comp, return_inverse=True)
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    n = np.array([len(s) for s in sets])
    maps = [bitmap_of(s).tobytes() for s in sets]
    common = overlaps(sets)
    for best in (True, True, False):
        roots = np.array([root(x) for x in range(len(parent))])
        chunk = Chunk(np.arange(len(sets)), n, roots[at], maps)
        found = list(open_pairs(chunk, chunk))
        if not found:
            break
        i, j, near = (np.concatenate(f) for f in zip(*found))
        if best:
            keep = closest(i, j, near)
            i, j = i[keep], j[keep]
        i, j = chunk.ids[i], chunk.ids[j]
        same = common(i, j)
        link = 100 * same >= 80 * (n[i] + n[j] - same)
        for a, b in zip(i[link].tolist(), j[link].tolist()):
            x, y = root(int(at[a])), root(int(at[b]))
            parent[max(x, y)] = min(x, y)
    return names[np.array([root(x) for x in range(len(parent))])][at]


def linked(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b), staged: components of a cell (cell, class, comp) and the least one that they are joined with there."""

    def run(table: pa.Table) -> pa.Table:
        cell, own, comp = (table.column(c).to_numpy() for c in ("cell", "class", "comp"))
        order = np.lexsort((own, cell))
        keep = np.append(True, (cell[order][1:] != cell[order][:-1]) | (own[order][1:] != own[order][:-1]))[: len(order)]
        order = order[keep]  # a set may have been made twice
        cell, own, comp = cell[order], own[order], comp[order]
        held = table.column("shingles").combine_chunks()
        cuts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
        least = comp.copy()
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high - low > 1:
                least[low:high] = joined(comp[low:high], [np.frombuffer(held[int(k)].as_buffer(), np.uint64) for k in order[low:high]])
        moved = comp != least
        return pa.table({"a": comp[moved], "b": least[moved]})

    parts = max(parallelism(cells.sparkSession), -(-cells.count() // PART_ROWS))
    met = cells.join(sets, "class").select("cell", "class", "comp", "shingles", F.pmod(F.xxhash64("cell"), F.lit(parts)).alias("part"))
    return staged(met.groupBy("part").applyInArrow(run, "a long, b long"), "jaccard-links")


def exact_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(class, shingles), staged, of the ``wanted`` (id, class) and few others; a class may come twice.

    A filter of bits for the wanted ids and classes goes to all tasks, so no text is shuffled.
    """
    spark = docs.sparkSession
    words = min(MAX_WORDS, 1 << max(6, (wanted.count() // 2).bit_length()))

    def word(h: np.ndarray) -> np.ndarray:
        return (h >> U(6) & U(words - 1)).astype(np.int64)

    def bit(h: np.ndarray) -> np.ndarray:
        return U(1) << (h & U(63))

    def hashed(values: pa.Array, seed: int) -> np.ndarray:
        return mix(values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ U(seed))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.concatenate([hashed(batch.column(0).drop_null(), 0), hashed(batch.column(1), 1)])
            at, rows = np.unique(word(h), return_inverse=True)
            bits = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(bits, rows, bit(h))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits.view(np.int64))], ["word", "bits"])

    marked = wanted.select("id", "class").mapInArrow(mark, "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    table = np.zeros(words, np.uint64)
    table[marked.column(0).to_numpy()] = marked.column(1).to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def known(h):
            return (shared.value[word(h)] & bit(h)) != 0

        seen = set()
        for batch in text_batches(batches):
            ids = batch.column(0)
            here = np.array(ids.is_null(), bool)  # a class without any id is sought among rows without one
            here[~here] = known(hashed(ids.drop_null(), 0))
            found = [s for s in shingle_sets(batch.column(1).filter(pa.array(here))) if len(s)]
            names = pa.array([class_of(s) for s in found], pa.int64())
            own, sets = [], []
            for c, wants, s in zip(names.to_pylist(), known(hashed(names, 1)), found):
                if wants and c not in seen:
                    seen.add(c)
                    own.append(c)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(sets, pa.binary())], ["class", "shingles"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), _text(text_col).alias("text"))
    return staged(texts.mapInArrow(run, "class long, shingles binary"), "jaccard-sets")


def blocks(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class, at) of all members, and (class, cell) of what all blocks of a neighbourhood get, staged."""
    label = None
    for _ in range(2):
        near = members.withColumn("label", F.col("class")) if label is None else members.join(label.select("class", "label"), "class")
        least = near.groupBy("gid").agg(F.min("label").alias("label"))
        last, label = label, staged(members.join(least, "gid").groupBy("class").agg(F.min("label").alias("label"), F.first("n").alias("n")), "jaccard-labels")
        discard(last)
    size = F.ceil(F.greatest(F.count("*") / F.lit(CHUNK), F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("long")
    cut = label.groupBy("label").agg(size.alias("blocks"), F.min("class").alias("first"))
    cut = staged(cut, "jaccard-blocks")
    at = F.xxhash64("label", F.pmod(F.xxhash64("class"), F.col("blocks")))
    placed = staged(label.join(cut, "label").select("class", at.alias("at")), "jaccard-placed")
    every = cut.where("blocks > 1").select("label", F.col("first").alias("class"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    return placed, every.select("class", F.xxhash64("label", "block").alias("cell"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n (set size), class, component_id.  See the module's text."""
    frequent = frequent_shingles(docs, text_col)
    prefixed = staged(described(docs, frequent, id_col, text_col), "jaccard-prefixes")
    rows = staged(prefixed.select("id", "n", "class"), "jaccard-rows")
    classes = rows.where("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    classes = staged(classes, "jaccard-classes")
    buckets = min(1 << 16, max(128, rows.count() // 2000))
    grouped = staged(groups(prefixed, buckets), "jaccard-groups")
    discard(prefixed)

    # A partner has at least 0.8 n shingles, and the smaller one's bound holds for both.
    shares = grouped.where("gid IS NULL").groupBy("class").agg(F.sum("k").alias("k")).join(classes, "class")
    least = F.expr("((8 * n + 9) div 10 + 9) div 10")
    alive = staged(shares.where(F.col("k") >= least).select("class", "id", "n"), "jaccard-alive")
    members = grouped.where("gid IS NOT NULL").select("gid", "class").join(alive.select("class", "n"), "class").distinct()
    members = staged(members, "jaccard-members")
    discard(grouped)
    placed, every = blocks(members)
    sets = exact_sets(docs, alive, id_col, text_col)

    # The class that all blocks of a neighbourhood get is its least: it names the component of what links with it.
    cells = placed.select("class", F.col("at").alias("cell")).union(every.select("class", "cell"))
    cells = staged(cells.withColumn("comp", F.col("class")), "jaccard-cells")
    comp = linked(cells, sets).select(F.col("a").alias("node"), F.col("b").alias("component"))
    discard(cells)

    # What is left: groups over several blocks, and in them what may link with another component.
    left = placed.join(comp, F.col("class") == F.col("node"), "left").select("class", "at", F.coalesce("component", "class").alias("comp"))
    left = members.select("gid", "class").join(left, "class")
    spans = left.groupBy("gid").agg(F.min("at").alias("a"), F.max("at").alias("b"), F.min("comp").alias("c"), F.max("comp").alias("d"))
    left = staged(left.join(spans.where("a <> b AND c <> d").select("gid"), "gid"), "jaccard-open")
    sides = left.groupBy("gid", F.col("at").alias("other")).agg(F.min("comp").alias("c"), F.max("comp").alias("d"))
    far = left.join(sides, "gid").where("at <> other AND NOT (c = d AND c = comp)")
    far = staged(far.select(F.xxhash64(F.least("at", "other"), F.greatest("at", "other")).alias("cell"), "class", "comp").distinct(), "jaccard-cells")
    if not far.isEmpty():
        more = linked(far, sets)
        whole = components(more).select(F.col("node").alias("component"), F.col("component").alias("whole"))
        # A component's least class is not among its nodes.
        comp = comp.join(whole, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
        comp = comp.union(whole.select(F.col("component").alias("node"), F.col("whole").alias("component")))
        comp = staged(comp, "jaccard-components")
        discard(more)
    discard(left, far, members, placed, alive, sets)

    least = classes.select("class", "id").join(comp, F.col("class") == F.col("node"), "left")
    least = least.select("class", "id", F.coalesce("component", "class").alias("comp"))
    first = least.groupBy("comp").agg(F.min("id").alias("component_id"))
    answer = least.join(first, "comp").select(F.col("class").alias("c"), "component_id")
    out = rows.select("id", "n", "class").join(answer, F.col("class") == F.col("c"), "left")
    return out.select("id", "n", "class", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id."""
    out = near_classes(docs, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Documents that link with nothing all stay; rows equal in id and text count
    as one document.
    """
    found = near_classes(docs, id_col, text_col)
    kept = found.where((F.col("n") == 0) | F.col("component_id").eqNullSafe(F.col("id")))
    kept = kept.select(F.col("id").alias("kept_id")).distinct().hint("shuffle_hash")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("own_id"), _text(text_col).alias("own_text"))
    stay = packed.join(kept, F.col("own_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return stay.dropDuplicates(["own_id", "own_text"]).select("row.*")
