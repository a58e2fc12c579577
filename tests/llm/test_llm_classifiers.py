"""Quality votes and the toxicity grammar: held-out accuracy and defined cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import awkward_docs, no_docs
from pyspark.sql import functions as F

from strata.llm import knn_quality, toxic_grammar

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int, score double"


def labelled(spark, label):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels.select("doc_id", label)


def rates(out, labels, label):
    rows = out.where("held_out").join(labels, "doc_id").collect()
    right = [r.predicted == r[label] for r in rows]
    ones = [r.predicted == 1 for r in rows if r[label] == 1]
    zeros = [r.predicted == 0 for r in rows if r[label] == 0]
    return sum(right) / len(right), sum(ones) / len(ones), sum(zeros) / len(zeros)


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark, "quality")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    space = knn_quality.fit(docs, labels, ~held)
    right, ones, zeros = rates(knn_quality.score_quality(docs, space, held), labels, "quality")
    assert right >= 0.97 and ones >= 0.97 and zeros >= 0.9


def test_votes_equal_a_plain_count():
    rng = np.random.default_rng(1)
    counts = rng.poisson(1.0, (80, knn_quality.TERMS)).astype(np.float32)
    labels = rng.integers(0, 2, 80).astype(float)
    space = knn_quality.fit_space(counts[:60], labels[:60], dims=10)
    got = space.scores(counts[60:], k=5)
    v = space.project(counts[60:]).astype(float)
    for row, score in zip(v, got):
        near = space.vectors.astype(float) @ row
        top = np.argsort(-near)[:5]
        w = np.maximum(near[top], 0) ** 8
        assert score == pytest.approx((w @ space.labels[top]) / w.sum(), abs=1e-4)


def test_term_counts_cover_the_whole_text():
    text = "ab " * 50_000
    assert knn_quality.term_counts(text)[: knn_quality.SHAPE_TERMS].sum() == len(text) - 3


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark, "toxic")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxic_grammar.fit(docs, labels, ~held)
    right, ones, zeros = rates(toxic_grammar.score_toxicity(docs, model, held), labels, "toxic")
    assert right >= 0.97 and zeros >= 0.99 and ones >= 0.75
    kept = {r.doc_id for r in toxic_grammar.clean_only(docs, model).select("doc_id").collect()}
    rejected = {r.doc_id for r in toxic_grammar.score_toxicity(docs, model, held).where("predicted = 1").collect()}
    assert not kept & rejected and len(kept) + len(rejected) == docs.count()


def grammar(**factors):
    return toxic_grammar.Grammar({"moron": 0.9, "scum*": 0.8}).reader()


def test_clauses_and_patterns():
    read = grammar()
    patterns = lambda t: [p for clause in read.matches(t) for p, _ in clause]
    I, T = toxic_grammar.INSULT, toxic_grammar.THREAT
    assert patterns("what a Moron!") == [(I, 0)]
    assert patterns("you are a moron") == [(I, toxic_grammar.AIMED)]
    assert patterns("this is not a moron") == [(I, toxic_grammar.NEGATED)]
    assert patterns("not here, moron") == [(I, 0)]  # the clause ends the reach
    assert patterns("he said something about some moron") == [(I, toxic_grammar.REPORTED)]
    assert patterns("they will kill it") == [(T, toxic_grammar.AIMED)]
    assert patterns("kill the process") == []
    assert patterns("SCUMMY") == [(I, 0)] and patterns("oxymoron") == []


def test_scores_weigh_patterns():
    read = grammar()
    plain, negated, quoted = (read.score(t) for t in ("a moron", "not a moron", "it said a moron"))
    assert plain == pytest.approx(0.9) and negated < plain and quoted < plain
    assert read.score("a moron. a moron.") == pytest.approx(1 - 0.1**2)
    assert read.score("") == read.score("nothing here") == 0.0


def test_composition_runs_one_after_the_other():
    first = toxic_grammar._reach(toxic_grammar.TARGET, toxic_grammar.AIMED, 2)
    second = toxic_grammar._rest_of_clause(toxic_grammar.REPORT, toxic_grammar.REPORTED)
    both = toxic_grammar.compose(first, second)
    rnd = random.Random(0)
    for _ in range(200):
        word = [rnd.choice([0, 1, 2, 3, 4, 5]) for _ in range(8)]
        a = b = c = 0
        for x in word:
            a, y = first[a, x]
            b, z = second[b, y]
            c, out = both[c, x]
            assert out == z


def test_covering_sets_explained_documents_aside():
    labels = np.array([1.0] * 20 + [0.0] * 180)
    held = [np.array([0, 2]) for _ in range(20)] + [np.array([2] if i % 2 else [1]) for i in range(180)]
    assert list(toxic_grammar.covering(held, labels, 3)) == [0]


@pytest.mark.parametrize("with_labels", [True, False])
def test_awkward_rows(spark, with_labels):
    docs = awkward_docs(spark)
    rows = [(i, i % 2, i % 2, None) for i in range(20)] + [(None, 1, 1, None), (3, None, None, None), (5, 0, 0, None)]
    labels = spark.createDataFrame(rows if with_labels else [], LABELS)
    never = F.lit(False)
    space = knn_quality.fit(docs, labels, ~never)
    got = knn_quality.score_quality(docs, space, never).collect()
    assert len(got) == docs.count() and all(0.0 <= r.score <= 1.0 for r in got)
    assert knn_quality.score_quality(no_docs(spark), space, never).count() == 0
    model = toxic_grammar.fit(docs, labels, ~never)
    got = toxic_grammar.score_toxicity(docs, model, never).collect()
    assert len(got) == docs.count() and all(0.0 <= r.score <= 1.0 for r in got)
    assert toxic_grammar.clean_only(docs, model).columns == docs.columns
    assert toxic_grammar.score_toxicity(no_docs(spark), toxic_grammar.fit(no_docs(spark), labels, ~never), never).count() == 0
