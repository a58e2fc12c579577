"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

A batch of texts becomes one array of code points.  Each code point gets a
class; what the pattern looks ahead for (the letters of a contraction, whether
white space goes on) is folded into the class by comparing the array with
itself shifted.  The pattern is then a small automaton over classes.  A class
is a function from state to state, and functions compose associatively: the
array is cut into blocks, all blocks compose their functions at once, a scan
over the block functions gives each block its first state, and a second sweep
yields the state before every position.  State and class say whether a token
starts there.  No regular expression is involved.

The slices between starts go through pair merging, cached by slice; those not
met before are merged side by side, over arrays.  The byte
offset at which each slice begins is kept beside the ids, so that decoding can
restore any run of slices (``decode_slices``) as well as the whole text.

Slices follow public_tokenizers.PATTERN:
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Defined cases: null text is empty (no ids, empty bytes); repeated rows are
kept one by one; null ids stay null; only the named columns are read; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import give_back, ship, text_batches

# Classes of a position.
BOUND, LETTER, NUMBER, OTHER, MARK2, MARK3, SPACE_X, WHITE_X, WHITE = range(9)
# States after a position.
FREE, IN_LETTER, IN_NUMBER, IN_OTHER, PENDING, IN_WHITE, LEFT1, LEFT2 = range(8)
N_STATES = 8
BLOCK = 64
#: Code points scanned at once.
SCAN_CHARS = 256_000
#: Bytes of slices, ids and their bookkeeping that a worker remembers.
CACHE_BYTES = 32 << 20
#: Slices decoded at once.
SLICES_AT_ONCE = 4096
#: Slices of more bytes are merged with a heap.
LONG_SLICE = 48
#: Slices looked up together; those not met before are merged side by side.
SLICES_TOGETHER = 50_000


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a token) by class and state."""
    step, start = np.zeros((9, N_STATES), np.uint8), np.ones((9, N_STATES), bool)
    for cls, inside in ((LETTER, IN_LETTER), (NUMBER, IN_NUMBER), (OTHER, IN_OTHER)):
        step[cls] = inside
        start[cls, [inside, PENDING]] = False
    for cls, left in ((MARK2, LEFT1), (MARK3, LEFT2)):
        step[cls] = left
        step[cls, [IN_OTHER, PENDING]] = IN_OTHER
        start[cls, [IN_OTHER, PENDING]] = False
    step[SPACE_X], step[WHITE_X], step[WHITE] = PENDING, FREE, IN_WHITE
    start[WHITE, IN_WHITE] = False
    for cls in range(1, 9):  # letters of a contraction are taken whatever they are
        step[cls, LEFT2], step[cls, LEFT1] = LEFT1, FREE
        start[cls, [LEFT1, LEFT2]] = False
    return step, start


STEP, START = _machine()


# Code points that the library's Unicode tables have as letters or
# numbers and those of Python 3.13 have not (first, last, class).
NEWER = (
    (0x1C89, 0x1C8A, LETTER), (0xA7CB, 0xA7CD, LETTER), (0xA7DA, 0xA7DC, LETTER), (0x105C0, 0x105F3, LETTER),
    (0x10D40, 0x10D49, NUMBER), (0x10D4A, 0x10D65, LETTER), (0x10D6F, 0x10D85, LETTER), (0x10EC2, 0x10EC4, LETTER),
    (0x11380, 0x11389, LETTER), (0x1138B, 0x1138B, LETTER), (0x1138E, 0x1138E, LETTER), (0x11390, 0x113B5, LETTER),
    (0x113B7, 0x113B7, LETTER), (0x113D1, 0x113D1, LETTER), (0x113D3, 0x113D3, LETTER), (0x116D0, 0x116E3, NUMBER),
    (0x11BC0, 0x11BE0, LETTER), (0x11BF0, 0x11BF9, NUMBER), (0x13460, 0x143FA, LETTER), (0x16100, 0x1611D, LETTER),
    (0x16130, 0x16139, NUMBER), (0x16D40, 0x16D6C, LETTER), (0x16D70, 0x16D79, NUMBER), (0x18CFF, 0x18CFF, LETTER),
    (0x1CCF0, 0x1CCF9, NUMBER), (0x1E5D0, 0x1E5ED, LETTER), (0x1E5F0, 0x1E5F0, LETTER), (0x1E5F1, 0x1E5FA, NUMBER),
)


@lru_cache(maxsize=1)
def code_classes() -> np.ndarray:
    """Class of every code point, before looking ahead."""
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
        elif kind == "Z":
            table[cp] = WHITE
    table[[*range(0x09, 0x0E), 0x85]] = WHITE
    for first, last, cls in NEWER:
        table[first : last + 1] = cls
    return table


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that sequences of classes make of the state.

    Returns the number of each class's function, the flat table of products
    (first * size + then), and the state each function leads to from FREE.
    Number 0 is the identity.
    """
    found = {tuple(range(N_STATES)): 0}
    todo = list(found)
    while todo:
        f = todo.pop()
        for g in STEP:
            h = tuple(int(g[x]) for x in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    funcs = np.array(list(found), np.uint8)
    product = np.array([[found[tuple(g[f].tolist())] for g in funcs] for f in funcs], np.intp)
    own = np.array([found[tuple(g.tolist())] for g in STEP], np.intp)
    return own, product.ravel(), funcs[:, FREE].astype(np.intp)


OF_CLASS, PRODUCT, FROM_FREE = _monoid()
N_FUNCS = len(FROM_FREE)


def compose_scan(funcs: np.ndarray) -> np.ndarray:
    """Exclusive scan of numbered state functions under composition.

    Blocks are composed side by side, their products scanned by the same rule,
    and the result carried back into the blocks.
    """
    n = len(funcs)
    if n <= BLOCK:
        out, now = np.empty_like(funcs), 0
        for i, f in enumerate(funcs.tolist()):
            out[i] = now
            now = PRODUCT[now * N_FUNCS + f]
        return out
    blocks = -(-n // BLOCK)
    grid = np.zeros(blocks * BLOCK, np.intp)
    grid[:n] = funcs
    columns = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    total = columns[0]
    for column in columns[1:]:
        total = PRODUCT.take(total * N_FUNCS + column)
    now = compose_scan(total)
    out = np.empty_like(columns)
    for j, column in enumerate(columns):
        out[j] = now
        now = PRODUCT.take(now * N_FUNCS + column)
    return out.T.ravel()[:n]


def token_starts(classes: np.ndarray) -> np.ndarray:
    """Positions where a token starts, from the classes of a text."""
    before = FROM_FREE.take(compose_scan(OF_CLASS.take(classes)))
    return np.flatnonzero(START.ravel().take(classes * np.intp(N_STATES) + before))


def classify(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Class of each position; ``bounds`` are separators between texts."""
    cls = code_classes()[codes]
    cls[bounds] = BOUND
    n = len(cls)
    white = cls == WHITE
    follows = np.zeros(n, bool)  # something other than white space comes next
    follows[:-1] = ~white[1:] & (cls[1:] != BOUND)
    ends_white = white & follows
    cls[ends_white] = WHITE_X
    cls[ends_white & (codes == 0x20)] = SPACE_X
    marks = np.flatnonzero((codes == 0x27) & (cls == OTHER))
    if len(marks):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        pair = one.astype(np.int64) << 21 | two
        cls[marks[np.isin(one, [ord(c) for c in "stmd"])]] = MARK2
        cls[marks[np.isin(pair, [ord(a) << 21 | ord(b) for a, b in ("re", "ve", "ll")])]] = MARK3
    return cls


def slices(texts: list[str]) -> Iterator[list[str]]:
    """The pattern's matches in each text, in order."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SCAN_CHARS):
            size += len(texts[end]) + 1
            end += 1
        part = texts[at:end]
        joined = "\n".join(part) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.cumsum([len(t) + 1 for t in part]) - 1
        starts = token_starts(classify(codes, bounds))
        cuts = np.searchsorted(starts, bounds)
        starts, low = starts.tolist(), 0
        for cut in cuts.tolist():  # starts[cut] is the separator
            yield [joined[a:b] for a, b in zip(starts[low:cut], starts[low + 1 : cut + 1], strict=True)]
            low = cut + 1
        at = end


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: its bytes, lowest-ranked adjacent pair merged first."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) > LONG_SLICE:
        return _merge_long(parts, ranks)
    get, none = ranks.get, len(ranks) + 1
    pairs = [get(a + b, none) for a, b in pairwise(parts)]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap over a linked list, for slices of any length."""
    n = len(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        if not parts[i] or (j := after[i]) >= n or len(parts[i]) + len(parts[j]) != size:
            continue  # one of the two has grown meanwhile
        parts[i], parts[j] = parts[i] + parts[j], b""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(parts[i] + parts[k])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[k])))
        if (p := before[i]) >= 0 and (r := ranks.get(parts[p] + parts[i])) is not None:
            heapq.heappush(heap, (r, p, len(parts[p]) + len(parts[i])))
    return [ranks[p] for p in parts if p]


class Pairs:
    """Merging of many slices at once, over arrays of ids.

    Which two ids make a third follows from the ranks.  In a round every slice
    merges its lowest-ranked pair, the first of equals; slices without a pair
    that merges leave."""

    def __init__(self, ranks: dict[bytes, int]):
        made = {}
        self.size = max(ranks.values()) + 1
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    made[left * self.size + right] = rank
        self.keys = np.array(sorted(made), np.int64)
        self.ranks = np.array([made[k] for k in self.keys.tolist()], np.int64)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge; ``size`` where there is none."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], self.size)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each slice (none empty)."""
        out: list[bytes] = [b""] * len(pieces)
        ids = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        who = np.arange(len(pieces))
        last = np.cumsum(sizes) - 1
        ranks = np.full(len(ids), self.size, np.int64)  # of an id and the one after it
        ranks[:-1] = self.rank(ids[:-1], ids[1:])
        ranks[last] = self.size
        while len(who):
            low = last - sizes + 1
            least = np.minimum.reduceat(ranks, low)
            goes_on = least < self.size
            if not goes_on.all():
                done = np.flatnonzero(~goes_on)
                flat = ids.astype(np.int32).tobytes()
                for w, a, n in zip(who[done].tolist(), low[done].tolist(), sizes[done].tolist(), strict=True):
                    out[w] = flat[4 * a : 4 * (a + n)]
                kept = np.repeat(goes_on, sizes)
                ids, ranks = ids[kept], ranks[kept]
                who, sizes, least = who[goes_on], sizes[goes_on], least[goes_on]
                if not len(who):
                    break
                last = np.cumsum(sizes) - 1
                low = last - sizes + 1
            hits = np.flatnonzero(ranks == np.repeat(least, sizes))
            at = hits[np.searchsorted(hits, low)]
            ids[at] = least
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids, ranks = ids[kept], ranks[kept]
            at -= np.arange(len(at))  # an id before each is gone by now
            sizes = sizes - 1
            last = np.cumsum(sizes) - 1
            low = last - sizes + 1
            ends = at == last
            ranks[at[ends]] = self.size
            inner = at[~ends]
            ranks[inner] = self.rank(ids[inner], ids[inner + 1])
            after = at[at > low]
            ranks[after - 1] = self.rank(ids[after - 1], ids[after])
        return out


def _together(texts: Iterator[list[str]]) -> Iterator[list[list[str]]]:
    """The slices of consecutive texts, until there are ``SLICES_TOGETHER``."""
    part, size = [], 0
    for pieces in texts:
        part.append(pieces)
        size += len(pieces)
        if size >= SLICES_TOGETHER:
            yield part
            part, size = [], 0
    if part:
        yield part


class Codec(dict):
    """Ids by slice (packed 32-bit integers), worked out when first asked for; bytes by id."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes = {i: b for b, i in self.ranks.items()}
        self.names = {i: str(i) for i in self.bytes}
        self.pairs = Pairs(self.ranks)
        self.held = 0
        code_classes()

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", merge_pairs(piece.encode("utf-8", "surrogatepass"), self.ranks)).tobytes()
        if len(piece) <= 64:
            self._keep(piece, ids)
        return ids

    def _keep(self, piece: str, ids: bytes) -> None:
        self.held += 4 * len(piece) + len(ids) + 200
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        self[piece] = ids

    def learn(self, pieces: Iterable[str]) -> None:
        """Merge the short slices among ``pieces`` that are not known, side by side."""
        new, merging = [], []
        for piece in set(pieces).difference(self):
            raw = piece.encode("utf-8", "surrogatepass")
            if (known := self.ranks.get(raw)) is not None:
                self._keep(piece, array("i", [known]).tobytes())
            elif len(raw) <= LONG_SLICE:
                new.append(piece)
                merging.append(raw)
        for piece, ids in zip(new, self.pairs.merge(merging) if new else [], strict=True):
            self._keep(piece, ids)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text: its ids, and for each slice the index of its first id."""
        for together in _together(slices(texts)):
            self.learn(chain.from_iterable(together))
            for pieces in together:
                groups = list(map(self.__getitem__, pieces))
                first = np.zeros(len(groups) + 1, np.int32)
                np.cumsum(np.fromiter(map(len, groups), np.int32, len(groups)) // 4, out=first[1:])
                yield np.frombuffer(b"".join(groups), np.int32), first[:-1]

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))

    def decode_slices(self, ids: list[int], first: list[int], start: int, end: int) -> bytes:
        """Bytes of the slices ``start`` to ``end``, from the kept offsets alone."""
        stop = first[end] if end < len(first) else len(ids)
        return self.decode(ids[first[start] : stop]) if start < len(first) else b""


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and vocabulary."""
    return Codec(path)


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``ids`` array<int>, and ``offsets`` array<int>, the index in
    ``ids`` at which each pre-token begins."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks)
        for batch in text_batches(batches):
            pairs = list(own.encode(batch.column(1).to_pylist()))
            ids, offsets = (_lists([p[k] for p in pairs]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, offsets], ["id", "ids", "offsets"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, ids array<int>, offsets array<int>").withColumnRenamed("id", id_col)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=ends[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def decode(encoded: DataFrame, ranks: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of ``ids_col`` added as ``out`` (null ids: null)."""

    @F.pandas_udf("binary")
    def one(ids: pd.Series) -> pd.Series:
        own = codec(ranks)
        return pd.Series([None if i is None else own.decode(i) for i in ids], dtype=object)

    return encoded.withColumn(out, one(F.col(ids_col)))


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")).cast("binary"), 256)


def coded(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids``, ``ids_sha256`` and ``decoded_sha256``,
    the digest of the bytes that all slices give when they are decoded one by
    one from the kept offsets.  One pass, one worker: text in, digests out."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        own = codec(ranks)
        for batch in text_batches(batches, 64):
            ids, digests, decoded = [], [], []
            for found, first in own.encode(batch.column(1).to_pylist()):
                values, starts = found.tolist(), first.tolist()
                back = hashlib.sha256()
                for at in range(0, len(starts), SLICES_AT_ONCE):
                    back.update(own.decode_slices(values, starts, at, at + SLICES_AT_ONCE))
                ids.append(found)
                digests.append(hashlib.sha256(",".join(map(own.names.__getitem__, values)).encode()).hexdigest())
                decoded.append(back.hexdigest())
            sizes = pa.array([len(i) for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, _lists(ids), pa.array(digests, pa.string()), pa.array(decoded, pa.string())], names)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.mapInArrow(run, f"id {id_type}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the slices, and give the digests of both."""
    return coded(docs, ranks, id_col, text_col).drop("ids")
