"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Terms.  A text becomes counts of hashed terms: runs of four byte classes (how
words are cased, spaced and punctuated), runs of three bytes, and marks for
words that repeat the word before them or an earlier word.  Counts are taken
over the whole text.

Space.  On a bounded sample of labelled rows (``sample_rows``, a documented
bound) terms are weighted by log count and inverse document frequency, and the
leading singular directions of the weighted matrix span the latent space.

Vote.  The labelled vectors are broadcast: at most ``sample_rows`` rows of
``dims`` single-precision numbers, whatever the size of the corpus.  For every
document the exact cosines with all of them come from blocked matrix products;
the ``k`` nearest vote with their labels, weighted by a power of the similarity.

Defined cases: null and empty texts have no terms, their vector is zero, and
they get the sample's share of label 1; without labelled rows every score is
0.5; with repeated ids in the labels the larger label counts; repeated
documents are scored one by one and equally; a null id stays null; only the
named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged, text_batches

SHAPE_TERMS, BYTE_TERMS, WORD_TERMS = 1024, 1024, 64
TERMS = SHAPE_TERMS + BYTE_TERMS + WORD_TERMS
#: Labelled rows kept, at most.
SAMPLE_ROWS = 6_000
DIMS = 64
NEIGHBOURS = 25
#: Documents multiplied at once.
BLOCK_DOCS = 256


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 9, np.uint32)
    kinds[ord("a") : ord("z") + 1] = 0
    kinds[ord("A") : ord("Z") + 1] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    kinds[0x80:] = 3
    for k, chars in ((4, " "), (5, "\n\r\t"), (6, "."), (7, ",;:"), (8, "!?")):
        kinds[[ord(c) for c in chars]] = k
    return kinds


CLASSES = _byte_classes()


def _hashed(codes: np.ndarray, size: int) -> np.ndarray:
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % size


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed terms of a whole text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(TERMS, np.float32)
    n = len(data)
    if n >= 4:
        kinds = CLASSES[data]
        runs = ((kinds[:-3] * 10 + kinds[1:-2]) * 10 + kinds[2:-1]) * 10 + kinds[3:]
        table = np.bincount(runs, minlength=10_000).astype(np.float32)
        out[:SHAPE_TERMS] = np.bincount(SHAPE_OF_RUN, weights=table, minlength=SHAPE_TERMS)
    if n >= 3:
        wide = data.astype(np.uint32)
        runs = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
        out[SHAPE_TERMS : SHAPE_TERMS + BYTE_TERMS] = np.bincount(_hashed(runs, BYTE_TERMS), minlength=BYTE_TERMS)
    words = text.split()
    if words:
        marks = out[SHAPE_TERMS + BYTE_TERMS :]
        again = sum(a == b for a, b in zip(words, words[1:]))
        fresh = len(set(words))
        lines = [x for x in text.split("\n") if x]
        # Shares as counts out of 64, each level a term of its own.
        for i, share in enumerate((again / len(words), 1 - fresh / len(words), 1 - len(set(lines)) / max(len(lines), 1), min(len(words), 640) / 640)):
            marks[i * 16 + min(15, int(share * 16))] = len(words)
    return out


SHAPE_OF_RUN = _hashed(np.arange(10_000), SHAPE_TERMS)


@dataclass
class Space:
    """The fitted latent space and its labelled vectors."""

    weights: np.ndarray  # inverse document frequency of each term
    axes: np.ndarray  # terms x dims
    vectors: np.ndarray  # labelled rows x dims, unit length
    labels: np.ndarray
    share: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        out = (np.log1p(counts) * self.weights) @ self.axes
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)

    def scores(self, counts: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the k nearest labelled vectors, by similarity."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        block = self.project(counts)
        near = block @ self.vectors.T
        k = min(k, near.shape[1])
        rows = np.arange(len(near))[:, None]
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(near[rows, top], 0).astype(np.float64) ** 8
        total = weight.sum(axis=1)
        vote = (weight * self.labels[top]).sum(axis=1) + self.share * 1e-6
        out = vote / (total + 1e-6)
        return np.clip(np.where(np.any(block, axis=1), out, self.share), 0.0, 1.0)


def fit_space(counts: np.ndarray, labels: np.ndarray, dims: int = DIMS) -> Space:
    """Singular directions of the weighted sample, from its term-by-term products."""
    n = len(labels)
    if not n:
        return Space(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    idf = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    weighted = np.log1p(counts) * idf
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
    values, axes = np.linalg.eigh(weighted.T @ weighted)
    axes = np.ascontiguousarray(axes[:, ::-1][:, : min(dims, n)], np.float32)
    space = Space(idf, axes, np.zeros((0, 1)), labels.astype(np.float64), float(labels.mean()))
    space.vectors = space.project(counts)
    return space


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, rows: int, id_col: str, text_col: str) -> DataFrame:
    """At most ``rows`` labelled documents, the first by a digest of the id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = known.orderBy(F.md5(F.col("id").cast("string")), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), "id")  # bounded by ``rows``


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, dims: int = DIMS) -> Space:
    """Fit on the labelled rows for which ``usable`` (a condition on the id) holds."""
    sample = labelled_sample(docs, labels, label_col, usable, sample_rows, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            counts = [term_counts(t).astype(np.float16).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(2), pa.array(counts, pa.binary())], ["id", "label", "counts"])

    counted = staged(sample.select("id", "text", "label").mapInArrow(run, "id string, label int, counts binary"), "quality-sample")
    rows = counted.orderBy("id", "counts").limit(sample_rows).select("label", "counts").toArrow()
    counts = np.array([np.frombuffer(c, np.float16) for c in rows.column(1).to_pylist()], np.float32).reshape(-1, TERMS)
    return fit_space(np.minimum(counts, 60_000), np.asarray(rows.column(0).to_pylist(), np.float64), dims)


def score_quality(docs: DataFrame, space: Space, held_out: Column, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in text_batches(batches, BLOCK_DOCS):
            counts = np.array([term_counts(t) for t in batch.column(2).to_pylist()], np.float32).reshape(-1, TERMS)
            counts = np.minimum(counts, 60_000)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.scores(counts, k), pa.float64())], ["id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.mapInArrow(run, f"id {id_type}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
