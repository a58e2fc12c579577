"""Property test: the Spark rule columns agree with a plain evaluation of the
rule list on random envelopes (one Spark job for all examples)."""

from __future__ import annotations

import json

from conftest import records
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.columns import WHITE_SPACE
from strata.functions.rules import RULES
from strata.operators.envelope import prepare

ABSENT = object()
texts = st.one_of(
    st.just(ABSENT), st.none(), st.just(""), st.sampled_from([" ", "\t", " ", "　 ", "  x "]),
    st.text(alphabet="ab-1 ", min_size=1, max_size=4),
)
ints = st.one_of(st.just(ABSENT), st.none(), st.integers(min_value=-3, max_value=3))
envelopes = st.fixed_dictionaries({r.field: (ints if r.kind == "positive" else texts) for r in RULES})


def expected(env: dict) -> list[str]:
    out = []
    for r in RULES:
        v = env[r.field]
        if r.kind == "positive":
            bad = v is ABSENT or v is None or v <= 0
        else:
            bad = v is ABSENT or v is None or v.strip(WHITE_SPACE) == ""
        if bad:
            out.append(r.message)
    return out


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(envelopes, min_size=150, max_size=150))
def test_rules_match_plain_evaluation(spark, batch):
    texts_ = [json.dumps({k: v for k, v in env.items() if v is not ABSENT}) for env in batch]
    v = prepare(records(spark, texts_), clock=F.col("kafka_timestamp_utc"))
    got = {r.kafka_offset: (r.validation_reason, list(r.validation_errors))
           for r in v.select("kafka_offset", "validation_reason", "validation_errors").collect()}
    for i, env in enumerate(batch):
        errors = expected(env)
        assert got[i] == ((errors[0] if errors else None), errors), (env, got[i])
