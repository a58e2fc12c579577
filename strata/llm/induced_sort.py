"""External induced sorting of suffixes, with common-prefix values.

A text is cut by its LMS positions (where a suffix is smaller than both
neighbours).  Sorting follows the recursion of induced sorting: the LMS
substrings are sorted by one induction and named; the names form a reduced
text whose suffixes are ordered by naming pairs of names until the names are
unique or span the depth asked for; a second induction carries that order to
every suffix of the text.

An induction is two sweeps over queues, one queue a symbol.  In the first,
symbols ascend and every popped suffix whose left neighbour is not smaller
pushes that neighbour into its symbol's queue; in the second, symbols descend.
A queue is popped in the order it was filled, so the queues together are a
priority queue ordered by (symbol, rank).  Queues hold tuples of a position and
the common prefix with the tuple before it, and keep only a bounded tail in
memory: the rest lies in unnamed temporary files, which vanish when closed.
The value of a pushed tuple is one more than the least value popped since the
last push into the same queue.

Everything is done on blocks of tuples.  Values are capped at ``depth``: two
suffixes that agree on that many symbols count as equal.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples handled at once, and kept in memory per queue.
BLOCK = 1 << 16
TAIL = 1 << 15
#: Arrays above this many bytes are kept in temporary files.
IN_MEMORY = 64 << 20
SYMBOLS = 257  # a separator and the byte values


def array_of(n: int, dtype) -> np.ndarray:
    """Zeros; held in an unnamed file of its own if large."""
    size = n * np.dtype(dtype).itemsize
    if size <= IN_MEMORY:
        return np.zeros(n, dtype)
    with tempfile.TemporaryFile() as file:
        file.truncate(size)
        return np.memmap(file, dtype, "r+", shape=(n,))


class Queue:
    """Append-only sequence of (position, common prefix) that can be read anywhere."""

    KIND = np.dtype([("at", "<i8"), ("same", "u1")])

    def __init__(self):
        self.count = self.flushed = 0
        self.tail = np.empty(64, self.KIND)
        self.file = None

    def push(self, at: np.ndarray, same: np.ndarray) -> None:
        n, held = len(at), self.count - self.flushed
        if held + n > len(self.tail):
            if held + n > TAIL:
                if self.file is None:
                    self.file = tempfile.TemporaryFile()
                self.file.seek(0, 2)
                self.file.write(self.tail[:held].tobytes())
                self.flushed, held = self.count, 0
            if held + n > len(self.tail):
                grown = np.empty(max(held + n, min(TAIL, 2 * len(self.tail))), self.KIND)
                grown[:held] = self.tail[:held]
                self.tail = grown
        self.tail["at"][held : held + n] = at
        self.tail["same"][held : held + n] = same
        self.count += n

    def read(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        rows = self.tail[max(a, self.flushed) - self.flushed : max(b, self.flushed) - self.flushed]
        if a < self.flushed:
            self.file.seek(a * self.KIND.itemsize)
            old = np.frombuffer(self.file.read((min(b, self.flushed) - a) * self.KIND.itemsize), self.KIND)
            rows = np.concatenate([old, rows]) if len(rows) else old
        return rows["at"].copy(), rows["same"].copy()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Induction:
    """The two sweeps over a text of symbols 0..256 that ends with a single 0."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth
        self.left = [Queue() for _ in range(SYMBOLS)]
        self.right = [Queue() for _ in range(SYMBOLS)]

    def close(self) -> None:
        for q in (*self.left, *self.right):
            q.close()

    def common(self, p: int, q: int) -> int:
        """Common prefix of two suffixes, up to the depth."""
        a, b = self.text[p : p + self.depth], self.text[q : q + self.depth]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def _restart(self) -> None:
        self.since = np.full(SYMBOLS, 255, np.uint8)  # least value since a queue's last push
        self.fresh = np.ones(SYMBOLS, bool)

    def _induce(self, queues: list[Queue], at: np.ndarray, same: np.ndarray, symbol: int, keep) -> None:
        """Push the left neighbours that ``keep`` allows; ``same`` is the popped sequence's."""
        before = np.where(at > 0, self.text[np.maximum(at - 1, 0)], 0)
        rows = np.flatnonzero(keep(before) & (at > 0))
        least = int(same.min()) if len(same) else 255
        if not len(rows):
            np.minimum(self.since, least, out=self.since)
            return
        target = before[rows]
        order = np.argsort(target, kind="stable")
        rows, target = rows[order], target[order]
        first = np.ones(len(rows), bool)
        first[1:] = target[1:] != target[:-1]
        value = np.empty(len(rows), np.uint8)
        value[~first] = _range_least(same, rows[:-1][~first[1:]] + 1, rows[1:][~first[1:]])
        value[first] = np.minimum(self.since[target[first]], np.minimum.accumulate(same)[rows[first]])
        value = np.minimum(value.astype(np.int64) + 1, self.depth)
        value[first & self.fresh[target]] = 0
        np.minimum(self.since, least, out=self.since)
        last = np.append(np.flatnonzero(first)[1:] - 1, len(rows) - 1)
        after = np.append(np.minimum.accumulate(same[::-1])[::-1], 255)
        self.since[target[last]] = after[rows[last] + 1]
        self.fresh[target[last]] = False
        starts = np.flatnonzero(first)
        for a, b in zip(starts.tolist(), (last + 1).tolist()):
            queues[int(target[a])].push(at[rows[a:b]] - 1, value[a:b])

    def run(self, seeds: list[Queue]) -> None:
        """``seeds``: the LMS suffixes of each symbol, in order."""
        self._restart()
        for c in range(SYMBOLS):
            queue, at = self.left[c], 0
            while at < queue.count:
                p, same = queue.read(at, min(at + BLOCK, queue.count))
                at += len(p)
                self._induce(self.left, p, same, c, lambda x: x >= c)
            for a in range(0, seeds[c].count, BLOCK):
                p, same = seeds[c].read(a, min(a + BLOCK, seeds[c].count))
                if a == 0:
                    end = queue.read(queue.count - 1, queue.count)[0] if queue.count else p[:0]
                    same[0] = self.common(int(end[0]), int(p[0])) if len(end) else 0
                self._induce(self.left, p, same, c, lambda x: x > c)
        self._restart()
        for c in range(SYMBOLS - 1, -1, -1):
            queue, at = self.right[c], 0
            while at < queue.count:
                p, same = queue.read(at, min(at + BLOCK, queue.count))
                at += len(p)
                self._induce(self.right, p, same, c, lambda x: x <= c)
            stack, end = self.left[c], self.left[c].count
            while end:
                a = max(0, end - BLOCK)
                p, same = stack.read(a, min(end + 1, stack.count))
                if end == stack.count:  # what was popped before the largest of these
                    low = queue.read(queue.count - 1, queue.count)[0] if queue.count else p[:0]
                    over = self.common(int(low[0]), int(p[-1])) if len(low) else 0
                    same = np.append(same, np.uint8(over))
                p, same = p[: end - a][::-1], same[1 : end - a + 1][::-1]
                self._induce(self.right, p, same, c, lambda x: x < c)
                end = a

    def sorted(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (positions, common prefix with the suffix before) in order."""
        for c in range(SYMBOLS):
            low, high = self.left[c], self.right[c]
            for a in range(0, low.count, BLOCK):
                yield low.read(a, min(a + BLOCK, low.count))
            end = high.count
            while end:
                a = max(0, end - BLOCK)
                p, same = high.read(a, min(end + 1, high.count))
                if end == high.count:
                    top = low.read(low.count - 1, low.count)[0] if low.count else p[:0]
                    same = np.append(same, np.uint8(self.common(int(top[0]), int(p[-1])) if len(top) else 0))
                yield p[: end - a][::-1], same[1 : end - a + 1][::-1]
                end = a


def _range_least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a..b], both ends included, for many ranges (sparse table)."""
    out = np.empty(len(a), np.uint8)
    if not len(a):
        return out
    level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        here = level == k
        out[here] = np.minimum(table[a[here]], table[b[here] - (1 << k) + 1])
    return out


def lms_positions(text: np.ndarray) -> np.ndarray:
    """Positions smaller than both neighbouring suffixes, the end included."""
    n, found = len(text), [np.array([len(text) - 1], np.int64)]
    small = True  # whether the suffix after the block is smaller than the one after it
    for end in range(n - 1, 0, -BLOCK * 16):
        a = max(0, end - BLOCK * 16)
        step = text[a + 1 : end + 1].astype(np.int32) - text[a:end]
        # Where the next symbol is equal the type is that of the next position.
        known = np.where(step != 0, np.arange(end - a), end - a)
        known = np.minimum.accumulate(known[::-1])[::-1]
        kind = np.append(step > 0, small)[known]
        after = np.append(kind, small)
        at = np.flatnonzero(~after[:-1] & after[1:]) + a + 1
        found.append(at[at < n - 1])
        small = bool(kind[0])
    return np.concatenate(found[::-1]) if n > 1 else found[0]


def _same_substrings(text: np.ndarray, p: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether text[p:p+size] equals text[q:q+size], for many pairs."""
    same, live, i = np.ones(len(p), bool), np.arange(len(p)), 0
    while len(live):
        equal = text[p[live] + i] == text[q[live] + i]
        same[live[~equal]] = False
        i += 1
        live = live[equal & (size[live] > i)]
    return same


def _named(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """A name for each LMS substring, in the order of the substrings."""
    seeds = [Queue() for _ in range(SYMBOLS)]
    first = text[lms]
    order = np.argsort(first, kind="stable")
    cuts = np.searchsorted(first[order], np.arange(SYMBOLS + 1))
    for c in range(SYMBOLS):
        at = lms[order[cuts[c] : cuts[c + 1]]]
        seeds[c].push(at, np.zeros(len(at), np.uint8))
    run = Induction(text, depth)
    run.run(seeds)
    number, size = {}, np.append(np.diff(lms) + 1, 1)
    names = array_of(len(lms), np.int64)
    before, name = len(lms) - 1, 0  # the end is the smallest and is not induced
    for at, _ in run.sorted():
        index = np.searchsorted(lms, at)
        index = index[(index < len(lms) - 1) & (lms[np.minimum(index, len(lms) - 1)] == at)]
        if not len(index):
            continue
        chain = np.append(before, index)
        x, y = chain[:-1], chain[1:]
        differ = size[x] != size[y]
        some = np.flatnonzero(~differ)
        differ[some] = ~_same_substrings(text, lms[x[some]], lms[y[some]], size[x[some]])
        names[index] = name + np.cumsum(differ)
        name, before = int(names[index[-1]]), int(index[-1])
    run.close()
    for q in seeds:
        q.close()
    del number
    return names


def _ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs, by ranges of the first part that fit in memory."""
    n, out, base, low = len(first), array_of(len(first), np.int64), 0, 0
    ends = np.unique(np.append(np.arange(16 * BLOCK, n, 16 * BLOCK), n))
    borders = np.partition(first, ends[:-1])[ends[:-1]].tolist() if len(ends) > 1 else []
    for high in [*sorted(set(borders)), None]:
        rows = np.flatnonzero((first >= low) & (first < high)) if high is not None else np.flatnonzero(first >= low)
        if len(rows):
            order = rows[np.lexsort((second[rows], first[rows]))]
            step = np.append(False, (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]]))
            rank = np.cumsum(step)
            out[order] = base + rank
            base += int(rank[-1]) + 1
        low = high if high is not None else low
    return out


def lms_order(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the LMS suffixes, by at least ``depth`` symbols."""
    names = _named(text, lms, depth)
    span = 1  # names that a rank stands for; each covers two symbols or more
    while 2 * span < depth and int(names.max()) + 1 < len(names):
        after = np.full(len(names), -1, np.int64)
        after[:-span] = names[span:]
        names = _ranked(names, after)
        span *= 2
    return names


def sorted_suffixes(text: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but the last in order, by at least ``depth`` symbols, as
    blocks of (positions, common prefix with the one before, up to ``depth``).

    ``text`` holds symbols 0..256 as unsigned 16-bit integers and ends with 0.
    """
    lms = lms_positions(text)
    rank = lms_order(text, lms, depth)
    order = lms[np.argsort(rank, kind="stable")]
    run = Induction(text, depth)
    seeds = [Queue() for _ in range(SYMBOLS)]
    first = text[order]
    cuts = np.searchsorted(first, np.arange(SYMBOLS + 1))
    for c in range(SYMBOLS):
        for a in range(int(cuts[c]), int(cuts[c + 1]), BLOCK):
            at = order[a : min(a + BLOCK, int(cuts[c + 1]))]
            seeds[c].push(at, _common_before(text, order, a, len(at), depth))
    run.run(seeds)
    yield from run.sorted()
    run.close()
    for q in seeds:
        q.close()


def _common_before(text: np.ndarray, order: np.ndarray, a: int, n: int, depth: int) -> np.ndarray:
    """Common prefix of order[a:a+n] with what stands before each, up to ``depth``."""
    out = np.zeros(n, np.uint8)
    live = np.arange(a, a + n)
    live = live[live > 0]
    end = len(text) - 1
    for _ in range(depth):
        p, q = order[live] + out[live - a], order[live - 1] + out[live - a]
        live = live[(p <= end) & (q <= end) & (text[np.minimum(p, end)] == text[np.minimum(q, end)])]
        if not len(live):
            break
        out[live - a] += 1
    return out
