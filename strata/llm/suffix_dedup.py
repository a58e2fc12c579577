"""Removal of byte strings that repeat from earlier documents, by suffix arrays.

A byte goes if some 50-byte string covers it that also starts in a document
with a smaller id.  Every 50-byte string counts, overlaps included, judged on
the input.

1. Anchors.  Among the 16-byte hashes inside a 50-byte string the least one is
   its anchor, so equal strings have equal anchors wherever they stand.  It
   changes at about one position in eighteen.  Anchors are compared across the
   corpus, packed by hash bucket; those met in one document only are done with.
2. Fragments.  Neighbouring 50-byte strings with one anchor that several
   documents have make up a fragment.  Fragments meet by anchor, so
   all equal strings meet; equal fragments are one, with the smallest document.
3. Suffix arrays.  Anchors with fragments that differ are gathered into shards;
   stretches whose 50-byte strings all occur once, by hash, are left out.
   A shard's fragments, joined by separators, are sorted by external induced
   sorting (``induced_sort``): recursion over LMS names, queues on disk,
   common-prefix values carried along.  Suffixes with a common prefix of 50
   bytes are one group; where the group has a smaller document, the string goes.
4. Removal.  The runs found are gathered per document and cut out.

The order of sort within a shard streams from Spark, a shard's text and queues
lie on disk where large, and no step holds more than a block of a shard.

Defined cases: null text is empty; texts under 50 bytes are untouched; rows
with equal ids are one document and never judged against each other; null ids
count as the largest; repeated rows are each answered; an empty table gives an
empty result.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from strata.llm.common import bytes_of, discard, gathered, parallelism, staged, text_batches
from strata.llm.induced_sort import array_of, sorted_suffixes
from strata.llm.shingles import powers, mix

U = np.uint64
LENGTH = 50
GRAM = 16
#: Bytes of text per bucket of anchors and per part of documents, on average.
BUCKET_BYTES = 2 << 20
PART_BYTES = 8 << 20
#: Text in a suffix array, unless one anchor alone has more.
SHARD_BYTES = 8 << 20
#: Bytes of texts hashed at once, unless one text alone has more, and strings in a fragment.
TEXT_BLOCK = 1 << 18
RUN = 1 << 12
#: Fragments whose bytes are gathered at once.
GATHER_ROWS = 1 << 14
#: Bytes hashed at once inside a shard.
HASH_BLOCK = 1 << 20
LAST = np.iinfo(np.int64).max


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each position on."""
    two = data[:-1].astype(np.uint64) << U(8) | data[1:]
    four = two[:-2] << U(16) | two[2:]
    eight = four[:-4] << U(32) | four[4:]
    return mix(mix(eight[:-8]) + eight[8:])


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every run of ``width`` values."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def blocks_of(cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """[low, high) of texts that are hashed at once, given where each begins and the last one ends."""
    low = 0
    while low < len(cuts) - 1:
        high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + TEXT_BLOCK, side="right")) - 1)
        yield low, high
        low = high


def anchors(data: np.ndarray, cuts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last, text) of runs of strings with equal anchors, for texts
    that lie end to end in ``data``, text k from ``cuts[k]`` to ``cuts[k + 1]``.

    A run never leaves its text and holds at most ``RUN`` strings."""
    none = np.zeros(0, np.int64)
    count = len(data) - length + 1
    if count < 1:
        return none.view(np.uint64), none, none, none
    least = sliding(gram_hashes(data), length - GRAM + 1, np.minimum)
    opens = np.ones(count, bool)
    np.not_equal(least[1:], least[:-1], out=opens[1:])
    for edge in (cuts[:-1], np.maximum(cuts[1:] - length + 1, cuts[:-1])):  # a text's first string, and the first that leaves it
        opens[edge[edge < count]] = True
    first = np.flatnonzero(opens)
    last = np.append(first[1:], count) - 1
    text = np.searchsorted(cuts, first, side="right") - 1
    inside = first + length <= cuts[text + 1]
    first, last, text = first[inside], last[inside], text[inside]
    pieces = (last - first) // RUN + 1
    if len(pieces) and pieces.max() > 1:
        place = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, last, text = (np.repeat(x, pieces) for x in (first, last, text))
        first = first + place * RUN
        last = np.minimum(first + RUN - 1, last)
    return least[first], first, last, text


def bucketed(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 further bits of each hash."""
    spread = mix(hashes)
    return ((spread >> U(32)) % U(buckets)).astype(np.int64), (spread & U(0xFFFFFFFF)).astype(np.int64)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), text.alias("text"), F.hash(text).alias("mark"))


def shared_anchors(rows: DataFrame, buckets: int, parts: int) -> DataFrame:
    """(part, keys): per part of documents, the anchors that other documents have too."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def dealt():
            hashes, ids = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            bucket, key = bucketed(hashes, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).astype(np.int32)
            full = np.flatnonzero(np.diff(cuts)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)).take(pa.array(full)) for x in (key.astype(np.uint32).view(np.int32)[order], ids[order])]
            return pa.RecordBatch.from_arrays([pa.array(full), *lists], ["bucket", "keys", "ids"])

        for batch in text_batches(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, cuts = bytes_of(batch.column(1))
            for low, high in blocks_of(cuts):
                own, _, _, text = anchors(data[cuts[low] : cuts[high]], cuts[low : high + 1] - cuts[low])
                order = np.lexsort((own, text))
                own, text = own[order], text[order]
                fresh = np.ones(len(own), bool)
                fresh[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
                if len(own):
                    held.append((own[fresh], ids[low + text[fresh]]))
                    size += int(fresh.sum())
            if size > 2_000_000:
                yield dealt()
                held, size = [], 0
        if held:
            yield dealt()

    def meet(table: pa.Table) -> pa.Table:
        key = table.column("keys").combine_chunks().flatten().to_numpy().view(np.uint32).astype(np.int64)
        ids = table.column("ids").combine_chunks().flatten().to_numpy()
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        several = ids[start] != ids[np.append(start[1:], len(ids)) - 1] if len(start) else np.zeros(0, bool)
        keep = np.repeat(several, np.diff(np.append(start, len(ids))))
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])]) if len(key) else keep
        key, ids = key[keep & fresh], ids[keep & fresh]
        part, whole = part_of(ids, parts), table.column("bucket")[0].as_py() << 32 | key if len(key) else key
        order = np.lexsort((whole, part))
        part, whole = part[order], whole[order]
        fresh = np.ones(len(part), bool)
        fresh[1:] = (part[1:] != part[:-1]) | (whole[1:] != whole[:-1])
        part, whole = part[fresh], whole[fresh]
        cuts = np.searchsorted(part, np.arange(parts + 1)).astype(np.int32)
        full = pa.array(np.flatnonzero(np.diff(cuts)).astype(np.int32))
        return pa.table([full, pa.ListArray.from_arrays(pa.array(cuts), pa.array(whole)).take(full)], names=["part", "keys"])

    dealt = rows.select("id", "text").mapInArrow(deal, "bucket int, keys array<int>, ids array<long>")
    return dealt.groupBy("bucket").applyInArrow(meet, "part int, keys array<long>")


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % U(parts)).astype(np.int32)


@F.pandas_udf(IntegerType())
def _part(ids: pd.Series, parts: pd.Series) -> pd.Series:
    return pd.Series(part_of(ids.to_numpy(np.int64), int(parts.iloc[0])) if len(ids) else [], dtype="int32")


def joined(ats: list[int]) -> list[int]:
    """The same places with those that touch or overlap made one."""
    out: list[int] = []
    for at in sorted(ats):
        if out and at >> 32 <= out[-1] & 0xFFFFFFFF:
            out[-1] = out[-1] & ~0xFFFFFFFF | max(out[-1] & 0xFFFFFFFF, at & 0xFFFFFFFF)
        else:
            out.append(at)
    return out


def joined_arrays(ats: np.ndarray, *document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``joined`` for the places of many documents, sorted by document and place:
    the places, and a row of each one's document."""
    if not len(ats):
        return ats, np.zeros(0, np.int64)
    other = np.ones(len(ats), bool)
    other[1:] = np.logical_or.reduce([d[1:] != d[:-1] for d in document])
    rank = np.cumsum(other) - 1
    reach = np.maximum.accumulate(rank << 32 | ats & 0xFFFFFFFF) & 0xFFFFFFFF
    opens = other.copy()
    opens[1:] |= ats[1:] >> 32 > reach[:-1]
    first = np.flatnonzero(opens)
    return ats[first] & ~0xFFFFFFFF | reach[np.append(first[1:], len(ats)) - 1], first


def equal_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each of ``rows`` has the bytes of the row before it, which is as long."""
    out = np.ones(len(rows), bool)
    for low in range(0, len(rows), GATHER_ROWS):
        some = rows[low : low + GATHER_ROWS]
        mine, cuts = gathered(data, start[some], size[some])
        out[low : low + GATHER_ROWS] = np.logical_and.reduceat(mine == gathered(data, start[some - 1], size[some])[0], cuts[:-1])
    return out


def fragment_table(key, who, mark, data, start, size, ats, counts, whole) -> pa.Table:
    """Rows of ``fragments``, in the order of the texts: neighbours there overlap, and compress together."""
    bounds = np.append(0, np.cumsum(counts)).astype(np.int32)
    order = np.lexsort((ats[bounds[:-1]], who)) if len(key) else key
    types = (pa.int64(), pa.int64(), pa.int32())
    columns = [pa.array(x[order], t) for x, t in zip((key, who, mark), types)]
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ats)).take(pa.array(order))
    texts = []
    for low in range(0, len(order), GATHER_ROWS):
        some = order[low : low + GATHER_ROWS]
        raw, cuts = gathered(data, start[some], size[some])
        valid = pa.py_buffer(np.packbits(whole[some], bitorder="little"))
        texts.append(pa.Array.from_buffers(pa.binary(), len(some), [valid, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw)]))
    return pa.table([columns[0], pa.chunked_array(texts, pa.binary()), *columns[1:], lists], names=["key", "fragment", "id", "mark", "ats"])


def fragments(rows: DataFrame, shared: DataFrame, buckets: int, parts: int) -> DataFrame:
    """(key, fragment, id, mark, ats): text around shared anchors and the places
    that have it, each start << 32 | end.

    Inside a part, a fragment that an earlier document has too is not sent:
    such places are removals, gathered in a row per document with a null fragment.
    """

    def cut(texts: pa.Table, met: pa.Table) -> pa.Table:
        keys = np.unique(met.column("keys").combine_chunks().flatten().to_numpy()) if met.num_rows else np.zeros(0, np.int64)
        data, cuts = bytes_of(texts.column("text"))
        ids, marks = (texts.column(c).to_numpy() for c in ("id", "mark"))
        found = []
        for low, high in blocks_of(cuts) if len(keys) else ():
            at = cuts[low]
            block = data[at : cuts[high]]
            own, first, last, text = anchors(block, cuts[low : high + 1] - at)
            bucket, key = bucketed(own, buckets)
            whole = bucket << 32 | key
            hit = keys[np.minimum(np.searchsorted(keys, whole), len(keys) - 1)] == whole
            first, end = first[hit], last[hit] + LENGTH
            power, inverse = powers(1 << max(18, len(block).bit_length()))
            total = np.zeros(len(block) + 1, np.uint64)
            np.cumsum((block.astype(np.uint64) + U(1)) * power[: len(block)], out=total[1:])
            found.append((whole[hit], mix((total[end] - total[first]) * inverse[first]), first + at, end - first, text[hit] + low))
        if not found:
            return fragment_table(*[np.zeros(0, np.int64)] * 3, data, *[np.zeros(0, np.int64)] * 5)
        key, digest, start, size, text = (np.concatenate([f[k] for f in found]) for k in range(5))
        del found
        who, mark = ids[text], marks[text].astype(np.int64)
        order = np.lexsort((start, mark, who, digest, size, key))
        key, digest, start, size, text, who, mark = (x[order] for x in (key, digest, start, size, text, who, mark))
        same = np.zeros(len(key), bool)
        same[1:] = (key[1:] == key[:-1]) & (size[1:] == size[:-1]) & (digest[1:] == digest[:-1])
        same[same] = equal_bytes(data, start, size, np.flatnonzero(same))
        head = np.flatnonzero(~same)  # the fragment's first row: its smallest document
        group = np.cumsum(~same) - 1
        least = who == who[head][group]
        at = (start - cuts[text]) << 32 | (start - cuts[text] + size)
        kept = np.flatnonzero(least)
        opens = np.ones(len(kept), bool)
        opens[1:] = (group[kept][1:] != group[kept][:-1]) | (mark[kept][1:] != mark[kept][:-1])
        first = kept[opens]
        gone = np.flatnonzero(~least)
        gone = gone[np.lexsort((at[gone], mark[gone], who[gone]))]
        spans, doc = joined_arrays(at[gone], who[gone], mark[gone])
        here = np.ones(len(spans), bool)
        here[1:] = (who[gone][doc][1:] != who[gone][doc][:-1]) | (mark[gone][doc][1:] != mark[gone][doc][:-1])
        lone = gone[doc[here]]
        rows_at = np.concatenate([first, lone])
        counts = np.concatenate([np.diff(np.append(np.flatnonzero(opens), len(kept))), np.diff(np.append(np.flatnonzero(here), len(spans)))])
        return fragment_table(
            np.concatenate([key[first], who[lone]]), who[rows_at], mark[rows_at],
            data, np.concatenate([start[first], start[lone]]), np.concatenate([size[first], np.zeros(len(lone), np.int64)]),
            np.concatenate([at[kept], spans]), counts, np.arange(len(rows_at)) < len(first),
        )

    placed = rows.withColumn("part", _part("id", F.lit(parts)))
    return placed.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(cut, "key long, fragment binary, id long, mark int, ats array<long>")


def repeated(data: np.ndarray, first: np.ndarray, size: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(piece, offset) of the strings that a piece of a smaller document has too.

    Pieces are stretches of ``data``; ``least`` is the smallest document of each.
    """
    ends = np.cumsum(size + 1)
    text = array_of(int(ends[-1]), np.uint16)
    for low in range(0, len(size), GATHER_ROWS):
        some = slice(low, low + GATHER_ROWS)
        raw, cuts = gathered(data, first[some], size[some])
        at = int(ends[low] - size[low]) - 1
        text[np.arange(at, at + len(raw)) + np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))] = raw.astype(np.uint16) + 1
    held_piece, held_at = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def judged(piece, offset, start):
        low = np.minimum.reduceat(least[piece], start)
        gone = least[piece] > np.repeat(low, np.diff(np.append(start, len(piece))))
        return piece[gone], offset[gone]

    for position, same in sorted_suffixes(text, LENGTH):
        piece = np.searchsorted(ends, position, side="right")
        offset = position - (np.where(piece > 0, ends[piece - 1], 0))
        whole = ends[np.minimum(piece, len(ends) - 1)] - 1 - position >= LENGTH
        same = same >= LENGTH
        # A suffix too short to hold the string has no common prefix that long, so it also ends a group.
        piece, offset, same = piece[whole], offset[whole], same[whole]
        if not len(piece):
            continue
        piece, offset = np.concatenate([held_piece, piece]), np.concatenate([held_at, offset])
        start = np.flatnonzero(np.concatenate([np.arange(len(held_piece)) == 0, ~same]))
        if not len(start) or start[0] != 0:
            start = np.concatenate([[0], start])
        open_from = int(start[-1])
        if open_from:
            yield judged(piece[:open_from], offset[:open_from], start[:-1])
        held_piece, held_at = piece[open_from:], offset[open_from:]
    if len(held_piece):
        yield judged(held_piece, held_at, np.zeros(1, np.int64))


def met_twice(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, end): the stretches of the pieces whose strings may occur
    twice, by a 64-bit hash of every 50-byte string.  Pieces lie end to end.

    What is left out holds only strings that occur once in the shard, so a
    sort could find nothing there.
    """
    first, size = cuts[:-1], np.diff(cuts)
    power, inverse = powers(HASH_BLOCK)
    found, low = [], 0
    while low < len(size):  # a block of pieces at a time
        high = max(low + 1, int(np.searchsorted(first, first[low] + HASH_BLOCK // 2)))
        block = data[cuts[low] : cuts[high]]
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + U(1)) * power[: len(block)], out=total[1:])
        stop = np.repeat(first[low:high] - first[low] + size[low:high], size[low:high])
        at = np.flatnonzero(np.arange(len(block)) + LENGTH <= stop)
        found.append((at + first[low], mix((total[at + LENGTH] - total[at]) * inverse[at])))
        low = high
    at, hashes = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = at[twice]
    if not len(at):
        return at, at, at
    piece = np.searchsorted(first, at, side="right") - 1
    start = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (at[1:] > at[:-1] + LENGTH)]))
    end = at[np.append(start[1:], len(at)) - 1] + LENGTH
    return piece[start], at[start] - first[piece[start]], end - first[piece[start]]


def spans_table(who: np.ndarray, mark: np.ndarray, ats: np.ndarray) -> pa.RecordBatch:
    """A row per document with its places, those that touch or overlap made one."""
    order = np.lexsort((ats, mark, who))
    who, mark = who[order], mark[order]
    spans, at = joined_arrays(ats[order], who, mark)
    who, mark = who[at], mark[at]
    opens = np.ones(len(spans), bool)
    opens[1:] = (who[1:] != who[:-1]) | (mark[1:] != mark[:-1])
    first = np.flatnonzero(opens)
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(spans)).astype(np.int32)), pa.array(spans))
    return pa.RecordBatch.from_arrays([pa.array(who[first]), pa.array(mark[first], pa.int32()), lists], ["id", "mark", "ats"])


class Shard:
    """Anchors whose fragments differ, until they fill a suffix array.

    Of a piece its bytes, its smallest document and the number of that
    document's rows; of each such row its mark, its places and their number."""

    def __init__(self):
        self.pieces, self.parts, self.size = [], [], 0

    def add(self, pieces: pa.LargeBinaryArray, *parts: np.ndarray) -> None:
        self.pieces.append(pieces)
        self.parts.append(parts)
        self.size += int(pa.compute.sum(pa.compute.binary_length(pieces)).as_py() or 0)

    def spans(self) -> Iterator[pa.RecordBatch]:
        """(id, mark, ats) of what the suffix array finds repeated."""
        if not self.pieces:
            return
        data, cuts = bytes_of(pa.chunked_array(self.pieces))
        least, rows, mark, places, ats = (np.concatenate(x) for x in zip(*self.parts))
        origin, low, high = met_twice(data, cuts)
        found = []
        for piece, offset in repeated(data, cuts[origin] + low, high - low, least[origin]) if len(origin) else ():
            if not len(piece):
                continue
            order = np.lexsort((offset, piece))
            piece, offset = piece[order], offset[order]
            start = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (offset[1:] > offset[:-1] + 1)]))
            end = offset[np.append(start[1:], len(piece)) - 1] + LENGTH
            piece, offset = piece[start], offset[start]
            found.append((origin[piece], low[piece] + offset << 32 | low[piece] + end))
        if not found:
            return
        piece, at = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((at, piece))
        at, kept = joined_arrays(at[order], piece[order])
        piece = piece[order][kept]
        row, of = _spread((np.cumsum(rows) - rows)[piece], rows[piece])
        place, by = _spread((np.cumsum(places) - places)[row], places[row])
        begin, at = ats[place] >> 32, at[of][by]
        yield spans_table(least[piece][of][by], mark[row][by], begin + (at >> 32) << 32 | begin + (at & 0xFFFFFFFF))


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of stretches that begin at ``first``, and the stretch of each."""
    of = np.repeat(np.arange(len(first)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count - first, count), of


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows, sorted by the first column, in tables that hold each of its values whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(0)[0].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def repeated_spans(cut: DataFrame, tasks: int) -> DataFrame:
    """(id, mark, ats): removals, by equal fragments and by the shards' suffix arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for table in whole_keys(batches):
            whole = table.column("fragment").is_valid().combine_chunks().to_numpy(zero_copy_only=False)
            yield from table.filter(pa.array(~whole)).select(["id", "mark", "ats"]).to_batches()
            table = table.filter(pa.array(whole)).combine_chunks()
            if not table.num_rows:
                continue
            key, who, mark = (table.column(c).to_numpy() for c in ("key", "id", "mark"))
            texts = pa.chunked_array(table.column("fragment").cast(pa.large_binary())).combine_chunks()
            code = texts.dictionary_encode().indices.to_numpy()
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1])
            head, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1  # a fragment's first row: its smallest document
            own = who == who[head][group]
            yield from table.filter(pa.array(~own)).select(["id", "mark", "ats"]).to_batches()
            border = np.flatnonzero(np.append(True, key[head][1:] != key[head][:-1]))
            count = np.diff(np.append(border, len(head)))
            several = np.repeat(count > 1, count)
            if not several.any():
                continue
            lists = table.column("ats").filter(pa.array(own & several[group])).combine_chunks()
            rows = np.add.reduceat(own, head, dtype=np.int64)[several]
            places, ats = pa.compute.list_value_length(lists).to_numpy().astype(np.int64), lists.flatten().to_numpy()
            marks, head, count = mark[own & several[group]], head[several], count[count > 1]
            texts = texts.take(pa.array(head))
            cuts = [np.append(0, np.cumsum(x)) for x in (count, rows, places)]
            size = np.append(0, np.cumsum(pa.compute.binary_length(texts).to_numpy()))[cuts[0]]
            low = 0
            while low < len(count):  # anchor by anchor until the shard is full
                high = min(len(count), int(np.searchsorted(size, size[low] + max(1, SHARD_BYTES - shard.size))))
                a, b = (int(cuts[0][x]) for x in (low, high))
                c, d = (int(cuts[1][x]) for x in (a, b))
                e, f = (int(cuts[2][x]) for x in (c, d))
                shard.add(texts.slice(a, b - a), who[head[a:b]], rows[a:b], marks[c:d], places[c:d], ats[e:f])
                low = high
                if shard.size >= SHARD_BYTES:
                    yield from shard.spans()
                    shard = Shard()
        yield from shard.spans()

    sent = cut.repartition(tasks, "key").sortWithinPartitions("key", "fragment", "id")
    return sent.mapInArrow(run, "id long, mark int, ats array<long>")


def _kept(raw: bytes, spans) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal runs removed."""
    gone = np.zeros(len(raw) + 1, np.int32)
    spans = np.asarray(spans, np.int64)
    np.add.at(gone, spans >> 32, 1)
    np.add.at(gone, spans & 0xFFFFFFFF, -1)
    covered = np.cumsum(gone[:-1]) > 0
    runs = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~covered].tobytes(), runs


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, spans): per document that loses bytes, its removed [start, end),
    each as start << 32 | end."""
    rows = _rows(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = max(16, total // BUCKET_BYTES), max(16, total // PART_BYTES)
    shared = staged(shared_anchors(rows, buckets, parts), "suffix-anchors")
    # Staged, so that the shuffled texts are gone before the fragments are shuffled.
    cut = staged(fragments(rows, shared, buckets, parts), "suffix-fragments")
    discard(shared)
    found = repeated_spans(cut, 2 * parallelism(docs.sparkSession))
    spans = staged(found.groupBy("id", "mark").agg(F.flatten(F.collect_list("ats")).alias("spans")), "suffix-spans")
    discard(cut)
    return spans


@F.pandas_udf(StructType([StructField("kept", BinaryType()), StructField("n_spans", LongType())]))
def _cut_out(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    out = [(t, 0) if s is None or not len(s) else _kept(t, s) for t, s in zip(raw, spans)]
    return pd.DataFrame({"kept": [k for k, _ in out], "n_spans": [n for _, n in out]})


def kept_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: id, n_bytes, kept (binary), n_spans, and the ``carry`` columns as a struct ``row``."""
    gone = removals(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None)
    rows = docs.select(
        F.col(id_col).alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), text.alias("text"), F.hash(text).alias("mark"), row.alias("row")
    )
    met = rows.join(gone.hint("shuffle_hash"), ["id", "mark"], "left")
    met = met.withColumn("cut", _cut_out("text", "spans"))
    return met.select("own", "row", F.octet_length("text").cast("long").alias("n_bytes"), "cut.kept", "cut.n_spans")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = kept_bytes(docs, id_col, text_col)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select(F.col("own").alias(id_col), "n_bytes", removed.cast("long").alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@F.pandas_udf(StringType())
def _as_text(kept: pd.Series) -> pd.Series:
    return pd.Series([k.decode("utf-8", "ignore") for k in kept], dtype=object)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the removed bytes cut out of the text and, if there is a
    length column, its value brought up to date.

    A character that a cut leaves in pieces goes as a whole.  Null texts stay null.
    """
    out = kept_bytes(docs, id_col, text_col, carry=docs.columns)
    text = F.when(F.col("n_spans") > 0, _as_text("kept")).otherwise(F.col(f"row.`{text_col}`"))
    out = out.select("row", text.alias("new_text"))
    columns = []
    for name in docs.columns:
        value = F.col(f"row.`{name}`")
        if name == text_col:
            value = F.col("new_text")
        elif name == length_col:
            value = F.char_length("new_text").cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return out.select(*columns)
