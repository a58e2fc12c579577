"""A training corpus from ``documents``: five stages, each on all that the one
before it kept.

1. toxicity          documents whose clauses score as toxic go
2. near_duplicates   of documents linked by n-gram Jaccard similarity one stays
3. repeated_passages bytes that repeat from earlier documents are cut out
4. source_mix        documents are taken, left or repeated for the target mix
5. byte_bpe          texts become token ids, checked by decoding them again

``run`` applies them in order and writes each result as Parquet in the shared
folder.  Defined cases: null texts are empty and pass stages 1 to 3; rows equal
in id and text count as one document in stage 2; extra columns of any name are
carried through stages 1 to 4 and left out by stage 5, which returns ids and
digests; an empty table stays empty.  What one stage wrote is deleted once the
next has been written.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import byte_bpe, jaccard_join, source_mix, suffix_dedup, toxic_grammar
from strata.llm.common import discard, ship, staged

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WEIGHTS = (1, 2, 3)
#: Documents, texts and ids, that pass between an executor and a worker at once in the last stage.
BATCH_ROWS = 1000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit the grammar on the labelled documents and keep what it does not reject."""
    ship(spark)
    model = toxic_grammar.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True), "toxic")
    return toxic_grammar.clean_only(docs, model, threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every component, and all that link with nothing."""
    ship(spark)
    return jaccard_join.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out bytes covered by 50-byte strings of earlier documents."""
    ship(spark)
    return suffix_dedup.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once per copy that the mix takes."""
    ship(spark)
    return source_mix.delivered(docs, slots=False, weights=WEIGHTS, most=3)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return byte_bpe.coded(docs, public_tokenizers.path(BYTE_RANKS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", mixed_sources),
    ("byte_bpe", encoded),
]

#: SQL states neither the learned grammar nor byte-pair merging; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)  # the table given at first is none of ours and stays
    return STAGES[-1][1](spark, docs, sf_dir)
