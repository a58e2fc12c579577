"""Phrase collocation mining.

Phrases of 2 to ``longest`` words that occur at least ``least`` times, scored by
how seldom their parts occur apart.  Texts are lower-cased (A-Z), split into
pieces at punctuation and line ends, and pieces into words; a phrase lies within
one piece, and all counts are kept per language.

Method: prefix-free parsing.

* A text's tokens (its words, with a mark between pieces) are cut where a hash
  of ``longest - 1`` tokens is a trigger.  A chunk goes on through the window
  that ends it, so neighbouring chunks overlap by ``longest - 1`` tokens: every
  run of up to ``longest`` tokens starts in exactly one chunk's own part and
  lies whole inside that chunk.  A chunk's tail of ``longest - 1`` tokens starts
  nothing, unless the chunk ends its text: overlaps are counted once.
* Equal texts, passages and lines give equal chunks.  The dictionary holds each
  distinct chunk of a language once, with its parse frequency, and runs are
  counted inside distinct chunks, weighted by it.
* Longer runs are counted only where they can be frequent.  Pairs of frequent
  words are first counted by hash alone; then runs of two words and more are
  counted as texts where all their pairs are frequent by hash.  Which words and
  pairs are frequent is told to the tasks by a bitmap of at most ``MAX_BITS``
  bits (16 MB), two bits a run.  Runs with one hash can only add up, so there is
  no false miss; a false hit costs a row in the shuffle and nothing else, since
  ``least`` is applied to the exact counts of the texts.

Sums are longs and scores are computed in decimals of 38 digits, so nothing
overflows.  A hot language is no hot task: counts are grouped by language and
phrase after map-side sums, and the report takes the first rows per task before
it ranks.

Defined cases: a null text is empty, a null language is ``und``; no words, no
rows; a phrase's parts occur at least as often as it does, so their counts are
always known; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bytes_of, discard, gathered, ship, staged, text_batches
from strata.llm.shingles import mix, powers

#: One window in so many is a trigger.
TRIGGER = 24
#: Bits of the bitmap: 16 a frequent run, between these bounds.
MIN_BITS, MAX_BITS = 1 << 15, 1 << 27
#: Words a task remembers the hashes of.
CACHE_WORDS = 200_000
#: Token bytes handled at once when runs are counted.
SLAB_BYTES = 4 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Stands between pieces; a line end is never part of a word.
MARK = b"\n"
_APART = b"\xff"  # never part of UTF-8
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + _APART * 10)

CHUNKS = "lang string, chunk string, last boolean"
#: What a count of runs gives: hashes only, texts only (the most rows, so nothing that follows from the text), or both.
HASHED = "h long, n long"
RUNS = "lang string, phrase string, n long"
HASHED_RUNS = "lang string, phrase string, h long, n long"


class Hashes(dict):
    """64-bit hashes of words, 0 for the mark alone; forgotten when they are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = 0 if word == MARK else xxhash.xxh64_intdigest(word) or 1
        return value

    def of(self, tokens: list[bytes], lang: str) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of a language's tokens (other languages have others), and which are words."""
        found = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        return found ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())), found != 0


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` tokens from every place on."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i]
        out ^= out >> np.uint64(29)
    return out


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, a place of each, and the sums of their weights."""
    group, distinct = pd.factorize(keys)
    place = np.empty(len(distinct), np.int64)
    place[group] = np.arange(len(keys))
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, group, weights)
    return distinct, place, sums


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text and a mark between its pieces."""
    found = text.translate(_FOLD).replace(_APART, b" \xff ").split()
    return [MARK if t == _APART else t for t in found] if _APART in found else found


def parse(tokens: list[bytes], hashes: np.ndarray, overlap: int) -> Iterator[tuple[bytes, bool]]:
    """The overlapping chunks of one text, and whether each ends it."""
    if not tokens:
        return
    windows = joined(hashes, overlap)
    starts = np.flatnonzero((windows >> np.uint64(33)) % np.uint64(TRIGGER) == 0)
    starts = starts[starts > 0].tolist()
    at = 0
    for start in starts:
        yield b" ".join(tokens[at : start + overlap]), False
        at = start
    yield b" ".join(tokens[at:]), True


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4) -> DataFrame:
    """Distinct chunks per language with their parse frequency."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Hashes()
        for batch in text_batches(batches):
            langs, chunks, last = [], [], []
            for code, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = tokens_of(body.as_buffer().to_pybytes())
                for chunk, end in parse(tokens, cache.of(tokens, code)[0], max(1, longest - 1)):
                    langs.append(code)
                    chunks.append(chunk)
                    last.append(end)
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(last, pa.bool_())],
                                  names=["lang", "chunk", "last"])

    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return given.mapInArrow(cut, CHUNKS).groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("freq"))


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where both bits of a hash are set."""
    mask = np.uint64(len(bitmap) * 8 - 1)
    found = np.ones(len(hashes), bool)
    for place in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        found &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of one language at a time, out of about ``SLAB_BYTES`` of all:
    their bytes end to end, where each begins and the last one ends, whether
    they end a text, and their frequencies."""
    held, size = [], 0

    def dealt():
        table = pa.Table.from_batches(held)
        lang = table.column(0).combine_chunks().dictionary_encode()
        code = lang.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        table = table.take(pa.array(order))
        cuts = np.searchsorted(code[order], np.arange(len(lang.dictionary) + 1)).tolist()
        for name, low, high in zip(lang.dictionary.to_pylist(), cuts, cuts[1:]):
            own = table.slice(low, high - low)
            yield name, *bytes_of(own.column(1)), own.column(2).to_numpy(), own.column(3).to_numpy()

    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= SLAB_BYTES:
            yield from dealt()
            held, size = [], 0
    if held and size:
        yield from dealt()


def _words(data: np.ndarray, cuts: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, hash, is a word) of the tokens of chunks that lie end to end.

    Short words get a polynomial hash from one running sum over the bytes,
    longer ones, for which that is weak, are hashed one by one."""
    space = np.flatnonzero(data == 32)
    first = np.sort(np.concatenate([cuts[:-1], space + 1]))
    end = np.sort(np.concatenate([space, cuts[1:]]))
    power, inverse = powers(1 << max(16, len(data).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    size = end - first
    hashes = mix((total[end] - total[first]) * inverse[first] + size.astype(np.uint64))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[first[i] : end[i]].tobytes())
    return first, end, hashes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())), data[first] != MARK[0]


def count_runs(
    chunks: DataFrame, sizes: Sequence[int], overlap: int, known: bytes | None = None, known_words: int = 0, schema: str = RUNS
) -> DataFrame:
    """Runs of ``sizes`` words inside distinct chunks with their whole counts,
    as the columns of ``schema``.

    With ``known``, a bitmap of the frequent runs of ``known_words`` words,
    only runs whose every part of that length may be frequent."""
    spark = chunks.sparkSession
    bitmap = spark.sparkContext.broadcast(known) if known is not None else None  # at most MAX_BITS bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8) if bitmap is not None else None
        for code, data, cuts, ends, freqs in _slabs(batches):
            start, end, hashes, word = _words(data, cuts, code)
            first = np.searchsorted(start, cuts[:-1])
            lens = np.diff(np.append(first, len(start)))
            left = np.repeat(first + lens, lens) - np.arange(len(start))  # tokens from here to the chunk's end
            own = left > np.repeat(np.where(ends, 0, overlap), lens)  # places in a chunk's own part
            weight = np.where(own, np.repeat(freqs, lens), 0)
            good = None if bits is None else _has(bits, joined(hashes, known_words))
            for n in sizes:
                if len(start) < n:
                    continue
                many = len(start) - n + 1
                take = own[:many] & (left[:many] >= n)
                for i in range(n):
                    take &= word[i : many + i]
                if good is not None:
                    for i in range(n - known_words + 1):
                        take &= good[i : many + i]
                at = np.flatnonzero(take)
                if not len(at):
                    continue
                keys, where, sums = summed(joined(hashes, n)[at], weight[at])
                columns = {"h": pa.array(keys.view(np.int64)), "n": pa.array(sums)}
                if "phrase" in names:
                    low = start[at[where]]
                    raw, bounds = gathered(data, low, end[at[where] + n - 1] - low)
                    phrases = pa.Array.from_buffers(pa.string(), len(low), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw)])
                    columns |= {"lang": pa.repeat(pa.scalar(code, pa.string()), len(low)), "phrase": phrases}
                yield pa.record_batch([columns[c] for c in names], names=names)

    names = [field.split()[0] for field in schema.split(", ")]
    key = [c for c in names if c != "n"]
    return chunks.select("lang", "chunk", "last", "freq").mapInArrow(count, schema).groupBy(*key).agg(F.sum("n").alias("n"))


def bitmap_of(frequent: DataFrame) -> bytes:
    """Two bits for every row's ``h``; 16 bits a row within the bounds."""
    wanted = 16 * max(1, frequent.count())
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (wanted - 1).bit_length()))
    mask = F.lit(bits - 1)
    places = [h.bitwiseAND(mask) + 1 for h in (F.col("h"), F.shiftrightunsigned("h", 32))]  # Spark's buckets and places begin at 1
    place = frequent.select(F.explode(F.array(*places)).alias("place"))
    # Spark's bitmaps hold 32,768 bits each: at most MAX_BITS / 32,768 rows come to the driver.
    maps = place.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in maps.collect():
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
    return out.tobytes()


def frequent_runs(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """Runs of 1 to ``longest`` words with at least ``least`` occurrences
    (``lang``, ``phrase``, ``words``, ``f``), and words per language (``n``)."""
    overlap = max(1, longest - 1)
    chunks = staged(dictionary(docs, text, lang, longest), "collocation-dictionary")
    singles = staged(count_runs(chunks, (1,), overlap, schema=HASHED_RUNS), "collocation-words")
    totals = singles.groupBy("lang").agg(F.sum("n").alias("n"))
    runs = singles.filter(F.col("n") >= least)
    if longest >= 2:
        pairs = staged(count_runs(chunks, (2,), overlap, bitmap_of(runs), 1, HASHED).filter(F.col("n") >= least), "collocation-pairs")
        longer = count_runs(chunks, range(2, longest + 1), overlap, bitmap_of(pairs), 2).filter(F.col("n") >= least)
        runs = runs.select(*longer.columns).unionByName(staged(longer, "collocation-longer"))
        discard(pairs)
    discard(chunks)
    words = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1
    return runs.select("lang", "phrase", words.alias("words"), F.col("n").alias("f")), totals


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(2000000 a / (l + r))`` without overflow."""
    wide = a.cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")
    return F.call_function("div", wide, left.cast("decimal(20,0)") + right.cast("decimal(20,0)"))


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, most: int = 2000, covered: int = 80, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Each language's first ``most`` phrases: ``lang``, ``rank``, ``phrase``,
    ``a`` (its count), ``l`` and ``r`` (counts of its parts at the weakest cut),
    ``n`` (words of the language) and ``score``.

    A phrase inside a longer candidate that has at least ``covered`` per cent of
    its occurrences is left out."""
    runs, totals = frequent_runs(docs, text, lang, longest, least)
    candidates = runs.filter(F.col("words") >= 2)
    cut = candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.withColumn("_first", F.expr("substring_index(phrase, ' ', k)")).withColumn("_rest", F.expr("substring_index(phrase, ' ', k - words)"))
    part = runs.select("lang", "phrase", "f")
    left = part.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    right = part.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "_first"]).join(right, ["lang", "_rest"])
    cut = cut.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    weakest = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))

    word = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda at: F.array_join(F.slice(word, at, m), " "))))
    longer = runs.filter(F.col("words") >= 3).select("lang", F.col("f").alias("_f"), F.explode(inner).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("_f").alias("_f"))
    apart = weakest.join(longer, ["lang", "phrase"], "left").filter(
        F.col("_f").isNull() | (F.col("_f").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = apart.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return first.filter(F.col("rank") <= most).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
