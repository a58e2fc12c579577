"""Language-model scores by context-tree weighting.

A text is its words, lower-cased (A-Z), each followed by a space, and an end.
Every byte is eight binary decisions; the context of a decision is the bytes
before it and the bits of its byte so far.  At every depth of context, from
none to ``depth`` bytes, a Krichevsky-Trofimov estimate gives the next bit, and
the weights of the depths are those of context-tree weighting: a node's weighted
probability is half its own estimate's and half the product of its children's.
The mix of all depths gives every bit a probability, hence every text a code
length, and the texts' probabilities sum to at most one.

On Spark:

* Block probabilities depend on counts alone, not on order, so the tree is
  built from the counts of all training texts' byte runs of ``depth`` + 1
  ("grams"; eight bytes at most, so that they are exact numbers and no hashes).
  Grams that occur in held-out texts alone are in the tree with count 0; their
  nodes weigh nothing and leave the estimates as they are.
* Texts are dealt into blocks of ``BLOCK_BYTES``.  The most frequent grams (at
  most ``HEAD_GRAMS``) and tokens (at most ``HEAD_WORDS``) are sent to all tasks.
  For every other one that it has, a block asks once; the answers are joined by
  gram, go back to the block, and are summed up text by text.  What is shuffled
  is the texts once and each block's distinct rarer grams.
* The tree is walked up (counts and weighted probabilities) and down (the mix)
  two depths at a time.  Nodes that share the nearer bytes go to one task, which
  takes them in slabs of whole groups; such a group is one context and all that
  lies two bytes beyond it, which is bounded whatever the input (256 x 256
  contexts, a few thousand in text).  Only depths 0 and 1 are computed on the
  driver: at most 65,280 nodes.

``base_score`` is the add-one score of the tokens (words and end) under their
counts in the training texts.

Defined cases: a null text is empty and scored for its end alone; a null id is
carried; repeated rows are scored and learned from each; without training texts
every bit costs one bit and ``base_score`` is 0; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import discard, parallelism, ship, staged, text_batches

#: Bytes and rows of a block of texts (a longer text is a block of its own).
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 100_000
#: Grams and tokens sent to every task: 16 MB and a few MB, whatever the input.
HEAD_GRAMS, HEAD_WORDS = 1 << 20, 1 << 17
#: Rows of grams or nodes that a task takes at once, besides its last whole group.
SLAB_ROWS = 1 << 16
DEPTH = 5
END = b"\n"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
LN2 = math.log(2.0)

GRAMS = "key long, n long"
WORDS = "word binary, n long"
NODES = "key long, zeros long, ones long, weighted double"
MIXED = "key long, ahead double, rest double"


# ---- the tree, as arrays -------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x >= 1/2, by Stirling's series at x + 8."""
    z = x + 8.0
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    series += 1 / (1188 * z**9) - 691 / (360360 * z**11)
    product = x.copy()
    for i in range(1, 8):
        product *= x + i
    return series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Level:
    """Nodes of one depth: keys (context bytes, then 1 and the bits so far),
    counts, own and weighted log probabilities, and every node's place in the
    level above it (the one a byte shorter)."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray | None, leaf: bool = False) -> None:
        self.key, self.zeros, self.ones = key, zeros, ones
        self.own = log_kt(zeros, ones)
        self.weighted = self.own if weighted is None else weighted
        self.leaf = leaf
        self.up: np.ndarray | None = None

    def parent(self, depth: int) -> Level:
        """The level at ``depth``, one less than this one's."""
        above = (((self.key >> 8) & ((1 << 8 * depth) - 1)) << 8) | (self.key & 255)
        key, self.up = np.unique(above, return_inverse=True)
        sums = [np.bincount(self.up, weights=x, minlength=len(key)) for x in (self.zeros, self.ones, self.weighted)]
        out = Level(key, sums[0], sums[1], None)
        out.weighted = np.logaddexp(out.own, sums[2]) - LN2
        return out

    def mix(self, ahead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a one from depths up to this one, and the weight left for deeper ones."""
        share = np.ones(len(self.key)) if self.leaf else np.minimum(1.0, np.exp(self.own - LN2 - self.weighted))
        return ahead + rest * share * (self.ones + 0.5) / (self.zeros + self.ones + 1.0), rest * (1.0 - share)


def climb(level: Level, depth: int, to: int) -> list[Level]:
    """Levels from ``depth`` (the given one) up to ``to``."""
    levels = [level]
    while depth > to:
        depth -= 1
        levels.append(levels[-1].parent(depth))
    return levels


def descend(levels: list[Level], ahead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mix at the first of ``levels`` from that at the last."""
    for level in reversed(levels[:-1]):
        ahead, rest = level.mix(ahead[level.up], rest[level.up])
    return ahead, rest


def leaves(gram: np.ndarray, n: np.ndarray) -> tuple[Level, np.ndarray, np.ndarray]:
    """The nodes of the deepest contexts; per gram its eight nodes and bits."""
    symbol = gram & 255
    node = np.stack([(1 << b) | (symbol >> (8 - b)) for b in range(8)], 1)
    bit = np.stack([(symbol >> (7 - b)) & 1 for b in range(8)], 1)
    key, place = np.unique((((gram >> 8) << 8)[:, None] | node).ravel(), return_inverse=True)
    times, one = np.repeat(n.astype(float), 8), bit.ravel() == 1
    counts = [np.bincount(place, weights=times * side, minlength=len(key)) for side in (~one, one)]
    return Level(key, counts[0], counts[1], None, leaf=True), place.reshape(-1, 8), bit


# ---- texts and blocks ----------------------------------------------------


def _blocks(docs: DataFrame, held_out: Column, doc_id: str, text: str) -> DataFrame:
    """Texts as scored, with a block number; written, so that it stays."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, rows = TaskContext.get().partitionId() << 32, 0, 0
        for batch in text_batches(batches):
            numbers, bodies = [], []
            for body in batch.column(2):
                found = body.as_buffer().to_pybytes().translate(_FOLD).split()
                body = b" ".join(found) + b" " + END if found else END
                if rows and (size + len(body) > BLOCK_BYTES or rows >= BLOCK_ROWS):
                    block, size, rows = block + 1, 0, 0
                size, rows = size + len(body), rows + 1
                numbers.append(block)
                bodies.append(body)
            yield pa.record_batch([pa.array(numbers, pa.int64()), batch.column(0), batch.column(1), pa.array(bodies, pa.binary())],
                                  names=["block", "doc_id", "held_out", "body"])

    given = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    fields = given.schema.fields
    schema = T.StructType([T.StructField("block", T.LongType()), *fields])
    return staged(given.mapInArrow(deal, schema), "context-texts")


def _bodies(column: pa.Array) -> list[bytes]:
    return [x.as_buffer().to_pybytes() for x in column]


def grams_of(bodies: list[bytes], depth: int) -> np.ndarray:
    """The gram that ends at every byte of every text, text after text; before
    a text stand ``depth`` ends."""
    pad = END * depth
    data = np.frombuffer(pad + b"".join(body + pad for body in bodies), np.uint8)
    two = data[:-1].astype(np.uint16) << 8 | data[1:]
    runs = {4: two[:-2].astype(np.uint32) << 16 | two[2:], 2: two, 1: data}
    out, at = np.zeros(len(data) - depth, np.int64), 0
    for width, run in runs.items():  # a gram has at most seven bytes
        if depth + 1 & width:
            out <<= 8 * width
            out |= run[at : at + len(out)]
            at += width
    lens = np.array([len(x) for x in bodies], np.int64)
    own = np.zeros(len(out) + 1, np.int8)
    starts = np.cumsum(lens + depth) - (lens + depth)
    own[starts] = 1
    own[starts + lens] -= 1
    return out[np.cumsum(own[:-1], dtype=np.int8).view(bool)]


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bool], list[bytes]]]:
    """Block by block, as far as a task has it."""
    block, held, bodies = None, [], []
    for batch in batches:
        for number, out, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _bodies(batch.column(2)), strict=True):
            if number != block and bodies:
                yield block, held, bodies
                held, bodies = [], []
            block = number
            held.append(out)
            bodies.append(body)
    if bodies:
        yield block, held, bodies


class Lookup:
    """Values by distinct non-negative keys: an open-addressed table in arrays."""

    def __init__(self, key: np.ndarray, value: np.ndarray) -> None:
        self.bits = max(4, (2 * len(key)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.key, self.value = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        place, left = self._place(key), np.arange(len(key))
        while len(left):
            free = self.key[place[left]] < 0
            tried = left[free]
            self.key[place[tried]] = key[tried]
            won = self.key[place[tried]] == key[tried]
            self.value[place[tried[won]]] = value[tried[won]]
            left = np.concatenate([left[~free], tried[~won]])
            place[left] = (place[left] + 1) & self.mask

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The values; not a number where a key is not in the table."""
        step = 1 << 17  # so many at once stay in a processor's cache
        return np.concatenate([self._find(key[at : at + step]) for at in range(0, len(key), step)] or [np.zeros(0)])

    def _find(self, key: np.ndarray) -> np.ndarray:
        place = self._place(key)
        there = self.key[place]
        out = np.where(there == key, self.value[place], np.nan)
        left = np.flatnonzero((there != key) & (there >= 0))
        while len(left):
            place[left] = (place[left] + 1) & self.mask
            there = self.key[place[left]]
            hit = there == key[left]
            out[left[hit]] = self.value[place[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


_HEAD: list = []  # a worker's last head and its table


def _head_table(head: tuple[np.ndarray, np.ndarray]) -> Lookup:
    """The table of a broadcast head, made once in a Python worker and not for every block."""
    if not _HEAD or _HEAD[0] is not head:
        _HEAD[:] = [head, Lookup(*head)]
    return _HEAD[1]


def _gram_counts(texts: DataFrame, depth: int) -> DataFrame:
    """All grams with their number in the training texts, combined by block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, bodies in _whole_blocks(batches):
            train = grams_of([b for b, out in zip(bodies, held, strict=True) if not out], depth)
            key, n = np.unique(train, return_counts=True)
            rest = np.unique(grams_of([b for b, out in zip(bodies, held, strict=True) if out], depth))
            if len(key):  # both are sorted
                rest = rest[key[np.minimum(np.searchsorted(key, rest), len(key) - 1)] != rest]
            yield pa.record_batch([pa.array(np.concatenate([key, rest])), pa.array(np.concatenate([n, np.zeros(len(rest), n.dtype)]))], names=["key", "n"])

    return texts.select("block", "held_out", "body").mapInArrow(count, GRAMS).groupBy("key").agg(F.sum("n").alias("n"))


def _word_counts(texts: DataFrame) -> DataFrame:
    """All tokens with their number in the training texts, combined by block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, bodies in _whole_blocks(batches):
            found: Counter[bytes] = Counter()
            for out, body in zip(held, bodies, strict=True):
                tokens = [*body.split(), END]
                if out:
                    found.update(dict.fromkeys(tokens, 0))
                else:
                    found.update(tokens)
            yield pa.record_batch([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return texts.select("block", "held_out", "body").mapInArrow(count, WORDS).groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(rows: DataFrame, most: int) -> DataFrame:
    """Rows with ``n`` from the least power of two on that at most ``most`` rows reach."""
    at_least = rows.filter(F.col("n") > 0).groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("rows")).collect()
    floor, taken = 62, 0
    for row in sorted(at_least, reverse=True):  # one row a power of two
        if taken + row.rows > most:
            break
        floor, taken = row.power, taken + row.rows
    return rows.filter(F.col("n") >= F.lit(1 << floor))


def _asked(texts: DataFrame, depth: int, head: object, head_words: object) -> DataFrame:
    """Per block its distinct grams and tokens that are not in the heads."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, common = _head_table(head.value), head_words.value
        for block, _, bodies in _whole_blocks(batches):
            gram = np.unique(grams_of(bodies, depth))  # each is looked up once, in order
            gram = gram[np.isnan(known.find(gram))]
            word = {END}
            for body in bodies:
                word.update(body.split())
            word = list(word - common.keys())
            blocks = pa.array(np.full(len(gram) + len(word), block))
            keys = pa.concat_arrays([pa.array(gram), pa.nulls(len(word), pa.int64())])
            yield pa.record_batch([blocks, keys, pa.concat_arrays([pa.nulls(len(gram), pa.binary()), pa.array(word, pa.binary())])], names=["block", "key", "word"])

    return texts.select("block", "held_out", "body").mapInArrow(ask, "block long, key long, word binary")


# ---- the tree on Spark ---------------------------------------------------


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns after the first, in pieces of whole groups of the first, which is sorted."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = columns if held is None else [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
        if len(held[0]) >= SLAB_ROWS and held[0][0] != held[0][-1]:
            cut = int(np.searchsorted(held[0], held[0][-1]))
            yield [c[:cut] for c in held[1:]]
            held = [c[cut:] for c in held]
    if held is not None and len(held[0]):
        yield held[1:]


def _grouped(rows: DataFrame, depth: int, work: Callable[[list[np.ndarray]], list[np.ndarray]], schema: str) -> DataFrame:
    """``work`` on slabs of ``rows`` in which every group of keys with the same
    nearest ``depth`` bytes of context is whole."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _slabs(batches):
            columns = work(slab)
            if len(columns[0]):
                yield pa.record_batch([pa.array(c) for c in columns], names=names)

    near = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * depth) - 1)).alias("near")
    dealt = rows.select(near, *rows.columns).repartition(parallelism(rows.sparkSession), "near").sortWithinPartitions("near")
    return dealt.mapInArrow(run, schema)


def gram_scores(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``key``, ``n``, ``logp``: log10 of every gram's last byte after its
    context, from the grams' training counts (``key``, ``n``)."""
    if not 3 <= depth <= 6:
        raise ValueError("depth must be 3 to 6")
    spark = grams.sparkSession
    # Depths whose nodes are written, deepest first; the last is computed on the driver.
    cuts = [d for d in range(depth - 2, 0, -2) if d > 1] + [1]

    def up_from_grams(slab: list[np.ndarray]) -> list[np.ndarray]:
        top = climb(leaves(slab[0], slab[1])[0], depth, cuts[0])[-1]
        return [top.key, top.zeros.astype(np.int64), top.ones.astype(np.int64), top.weighted]

    tables = [staged(_grouped(grams.select("key", "n"), cuts[0], up_from_grams, NODES), "context-nodes")]
    for low, high in zip(cuts, cuts[1:], strict=False):
        def up(slab: list[np.ndarray], low: int = low, high: int = high) -> list[np.ndarray]:
            top = climb(Level(slab[0], slab[1].astype(float), slab[2].astype(float), slab[3]), low, high)[-1]
            return [top.key, top.zeros.astype(np.int64), top.ones.astype(np.int64), top.weighted]

        tables.append(staged(_grouped(tables[-1], high, up, NODES), "context-nodes"))
    rows = tables[-1].orderBy("key").collect()  # depth 1: at most 256 contexts x 255 nodes
    ahead, rest = np.zeros(1 << 16), np.ones(1 << 16)
    if rows:
        column = [np.array(c) for c in zip(*[(r.key, float(r.zeros), float(r.ones), r.weighted) for r in rows], strict=True)]
        levels = climb(Level(column[0].astype(np.int64), *column[1:]), 1, 0)
        root = levels[-1].mix(np.zeros(len(levels[-1].key)), np.ones(len(levels[-1].key)))
        ahead[levels[0].key], rest[levels[0].key] = descend(levels, *root)
    shared = spark.sparkContext.broadcast((ahead, rest))  # 65,536 entries

    mixed: DataFrame | None = None  # of the last written depth; None where that is depth 1
    for at in range(len(cuts) - 2, -1, -1):  # down to the first written depth
        low, high = cuts[at], cuts[at + 1]
        mixed = staged(_down(tables[at], mixed, low, high, shared), "context-mixed")

    from_shared = mixed is None

    def last(slab: list[np.ndarray]) -> list[np.ndarray]:
        key, n, given_ahead, given_rest = slab
        known = np.isnan(given_ahead)
        gram, order = key[known], np.argsort(key[~known])
        if not len(gram):
            return [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        level, place, bit = leaves(gram, n[known])
        levels = climb(level, depth, cuts[0])
        if from_shared:
            start = [x[levels[-1].key] for x in shared.value]
        else:
            found = np.searchsorted(key[~known][order], levels[-1].key)
            start = [x[~known][order][found] for x in (given_ahead, given_rest)]
        one = descend(levels, *start)[0][place]
        return [gram, n[known], np.log10(np.where(bit == 1, one, 1.0 - one)).sum(1)]

    asked = grams.select("key", "n", F.lit(float("nan")).alias("ahead"), F.lit(float("nan")).alias("rest"))
    if mixed is not None:
        asked = asked.unionByName(mixed.select("key", F.lit(0).cast("long").alias("n"), "ahead", "rest"))
    return _grouped(asked, cuts[0], last, "key long, n long, logp double")


def _down(nodes: DataFrame, mixed: DataFrame | None, low: int, high: int, shared: object) -> DataFrame:
    """The mix at depth ``low`` from that at depth ``high`` (``mixed``, or the shared arrays for depth 1)."""

    from_shared = mixed is None

    def work(slab: list[np.ndarray]) -> list[np.ndarray]:
        key, zeros, ones, weighted, given_ahead, given_rest = slab
        own = np.isnan(given_ahead)
        if not own.any():
            return [np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
        levels = climb(Level(key[own], zeros[own].astype(float), ones[own].astype(float), weighted[own]), low, high)
        if from_shared:
            start = [x[levels[-1].key] for x in shared.value]
        else:
            order = np.argsort(key[~own])
            found = np.searchsorted(key[~own][order], levels[-1].key)
            start = [x[~own][order][found] for x in (given_ahead, given_rest)]
        return [levels[0].key, *descend(levels, *start)]

    rows = nodes.select("key", "zeros", "ones", "weighted", F.lit(float("nan")).alias("ahead"), F.lit(float("nan")).alias("rest"))
    if mixed is not None:
        none = F.lit(0).cast("long")
        rows = rows.unionByName(mixed.select("key", none.alias("zeros"), none.alias("ones"), F.lit(0.0).alias("weighted"), "ahead", "rest"))
    return _grouped(rows, high, work, MIXED)


# ---- scores --------------------------------------------------------------


def score_texts(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """Every text's log10 probability under the tree of the texts that are not
    ``held_out``: ``doc_id``, ``held_out``, ``n_bytes`` (as scored),
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``,
    ``bits_per_byte``."""
    ship(docs.sparkSession)
    texts = _blocks(docs, held_out, doc_id, text)
    grams = staged(_gram_counts(texts, depth), "context-grams")
    scored = staged(gram_scores(grams, depth), "context-scores")
    discard(grams)
    words = staged(_word_counts(texts), "context-words")
    seen = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    train_tokens, spread = int(seen.n), math.log10(seen.n + seen.v + 1)

    context = docs.sparkSession.sparkContext
    top = _most_frequent(scored, HEAD_GRAMS).select("key", "logp").toArrow()
    head = context.broadcast((top.column("key").to_numpy(), top.column("logp").to_numpy()))
    head_words = context.broadcast({bytes(r.word): r.n for r in _most_frequent(words, HEAD_WORDS).collect()})
    asked = staged(_asked(texts, depth, head, head_words), "context-asked")
    answers = asked.filter(F.col("key").isNotNull()).select("block", "key").join(scored.select("key", "logp"), "key")
    answers = answers.select("block", "key", "logp", F.lit(None).cast("binary").alias("word"), F.lit(None).cast("long").alias("n"))
    tokens = asked.filter(F.col("word").isNotNull()).select("block", "word").join(words, "word")
    tokens = tokens.select("block", F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("logp"), "word", "n")
    fields = {f.name: f for f in texts.schema.fields}
    schema = T.StructType([fields["doc_id"], fields["held_out"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_tokens", "n_known", "train_tokens")],
                           *[T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "bits_per_byte")]])

    def sums(texts: pa.Table, answers: pa.Table) -> pa.Table:
        bodies = [x.as_buffer().to_pybytes() for x in texts.column("body")]
        gram = grams_of(bodies, depth)
        logp = _head_table(head.value).find(gram)
        of_gram = answers.filter(pa.compute.is_valid(answers.column("key")))
        rare = np.isnan(logp)
        logp[rare] = Lookup(of_gram.column("key").to_numpy(), of_gram.column("logp").to_numpy()).find(gram[rare])
        lens = np.array([len(x) for x in bodies], np.int64)
        score = np.add.reduceat(logp, np.cumsum(lens) - lens)
        of_word = answers.filter(pa.compute.is_valid(answers.column("word")))
        count = dict(zip(of_word.column("word").to_pylist(), of_word.column("n").to_pylist(), strict=True))
        count.update(head_words.value)
        rows = []
        for body in bodies:
            tokens = [*body.split(), END]
            n = np.fromiter(map(count.__getitem__, tokens), np.float64, len(tokens))
            rows.append((len(n), int(np.count_nonzero(n)), train_tokens, float(np.log10(n + 1.0).sum()) - len(n) * spread))
        columns = [pa.array(c, pa.int64() if i < 3 else pa.float64()) for i, c in enumerate(zip(*rows, strict=True))]
        bits = -score * math.log2(10) / lens
        return pa.table([texts.column("doc_id"), texts.column("held_out"), pa.array(lens), *columns, pa.array(score), pa.array(bits)], names=schema.names)

    return texts.groupBy("block").cogroup(answers.unionByName(tokens).groupBy("block")).applyInArrow(sums, schema)


__all__ = ["Level", "climb", "descend", "gram_scores", "grams_of", "leaves", "log_kt", "score_texts"]
