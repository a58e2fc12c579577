"""Registered operator queries against their SQL, and the pipeline end to end."""

from __future__ import annotations

import hashlib
import os
import sys

import duckdb
import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from helpers import awkward_docs, no_docs  # noqa: E402
from strata.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402
from strata.llm import byte_bpe  # noqa: E402

COLUMNS = {
    "op1": ["doc_id", "held_out", "score", "predicted"],
    "op2": ["doc_id", "held_out", "score", "predicted"],
    "op3": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op4": ["query_id", "rank", "vec_id", "score"],
    "op5": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op7": ["doc_id", "size", "source_size", "target", "taken"],
    "op8": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9": ["query_id", "rank", "vec_id", "score"],
    "op10": ["doc_id", "n_shingles", "component_id"],
    "op11": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_sql(spark, name):
    out = QUERIES[name](spark, SF_SMALL)
    wanted = COLUMNS[name.split("_")[0]]
    assert [c for c in out.columns if c in wanted] == wanted
    rows = sorted((tuple(r[c] for c in wanted) for r in out.collect()), key=repr)
    assert rows
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        sql = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in sql.description]
        expected = sorted((tuple(r[names.index(c)] for c in wanted) for r in sql.fetchall()), key=repr)
        assert [tuple(r) for r in rows] == [tuple(r) for r in expected]


def stage_by_stage(spark, docs, sf_dir):
    yield docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        yield docs


def test_pipeline_stages_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tables = list(stage_by_stage(spark, docs, SF_SMALL))
    assert all(t.columns == docs.columns for t in tables[:-1])
    n = [t.count() for t in tables]
    assert n[0] >= n[1] >= n[2] == n[3] and n[4] == n[5]
    texts = {}
    for r in tables[4].collect():
        texts.setdefault(r.doc_id, r.text or "")
    codec = byte_bpe.codec(corpus_pipeline.public_tokenizers.path(corpus_pipeline.BYTE_RANKS))
    for r in tables[5].collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids == next(codec.encode([texts[r.doc_id]]))[0].tolist() and r.n_tokens == len(r.ids)
    whole = sorted(map(str, corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "ids_sha256").collect()))
    assert whole == sorted(map(str, tables[5].select("doc_id", "ids_sha256").collect()))


def test_pipeline_on_awkward_and_no_rows(spark):
    for docs in (awkward_docs(spark), no_docs(spark)):
        tables = list(stage_by_stage(spark, docs, SF_SMALL))
        assert all(t.columns == docs.columns for t in tables[:-1])
        assert tables[-1].count() == tables[-2].count() <= 3 * docs.count()
