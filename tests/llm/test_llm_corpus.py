"""Importance resampling, collocations and context-tree scores against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
from helpers import awkward_docs, by_id, no_docs
from pyspark.sql import functions as F

from strata.llm import collocations, context_tree, importance_resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(rows):
    return [(r.text or "").translate(LOWER) for r in rows]


# ---- importance resampling ----------------------------------------------


def plain_resample(docs, target, percent, least, runs, buckets, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        return [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)], len(words)

    def counts(rows):
        return Counter(crc32(f.encode()) % buckets for t in texts_of(rows) for f in features(t)[0])

    s, t = counts(docs), counts(target)
    in_s, in_t = sum(s.values()), sum(t.values())
    out = []
    for row, text in zip(docs, texts_of(docs), strict=True):
        found, n_words = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (in_s + buckets) / ((s[b] + 1) * (in_t + buckets)))) for b in (crc32(f.encode()) % buckets for f in found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if row.doc_id is None else row.doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([row.doc_id, len(found), weight, score, None, n_words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resampling_equals_a_plain_version(spark):
    docs = awkward_docs(spark, [(107, "one two", "s0", "en", None, None, None, None)] * 5)
    target = spark.createDataFrame([(1, "alpha beta GAMMA"), (2, None), (3, "Épsilon 日本 w5")], "item_id long, text string")
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    for percent, least, runs in ((10, 20, 1), (50, 2, 2), (100, 1, 3), (0, 1, 1)):
        got = importance_resample.importance_resample(docs, target, percent, least, runs=runs, buckets=97)
        want = plain_resample(docs.collect(), target.collect(), percent, least, runs, 97, 2024)
        assert by_id(got.collect(), *names) == want
    kept = importance_resample.importance_resample(docs, target, keep=["text", "id"])
    assert kept.columns == ["doc_id", "text", "id", *names[1:]]


def test_resampling_without_rows(spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert importance_resample.importance_resample(no_docs(spark), target).count() == 0
    assert importance_resample.importance_resample(awkward_docs(spark), target).filter("rank = 1").count() == 1


def test_thresholds_split_ties_exactly(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("score"), (F.col("id") % 3).alias("doc_id"), F.col("id").alias("_row"))
    for count in (0, 1, 142, 143, 200, 999, 1000):
        want = sorted(rows.collect(), key=lambda r: (-r.score, r.doc_id, r._row))[:count]
        assert sorted(rows.filter(importance_resample.draw(rows, count)).collect()) == sorted(want)


# ---- collocations --------------------------------------------------------


def plain_collocations(rows, longest, least, most, covered=80):
    f, n = defaultdict(Counter), Counter()
    for row, text in zip(rows, texts_of(rows), strict=True):
        lang = row.lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        hidden = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and p[i:j] in candidates and 100 * a >= covered * candidates[p[i:j]]}
        scored = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            if p not in hidden:
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def test_words_of_chunks_end_to_end():
    long = b"x" * 65
    chunks = [b"a bc \n a", b"\n", b"bc", long + b" " + long + b"y a", "é bc".encode()]
    cuts = np.append(0, np.cumsum([len(c) for c in chunks]))
    data = np.frombuffer(b"".join(chunks), np.uint8)
    first, end, hashes, word = collocations._words(data, cuts, "en")
    tokens = [t for c in chunks for t in c.split(b" ")]
    assert [data[a:b].tobytes() for a, b in zip(first, end)] == tokens
    assert word.tolist() == [t != b"\n" for t in tokens]
    assert len(set(zip(tokens, hashes.tolist()))) == len(set(tokens)) == len(set(hashes.tolist()))
    assert not set(hashes.tolist()) & set(collocations._words(data, cuts, "fr")[2].tolist())


def test_collocations_equal_a_plain_version(spark):
    more = [(200 + i, "New York City is. New York\tCity was! the New\nYork", "s0", ("en", None, "fr")[i % 3], None, None, None, None) for i in range(40)]
    docs = awkward_docs(spark, more)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for longest, least, most in ((4, 3, 2000), (4, 1, 50), (2, 2, 10), (5, 2, 2000), (1, 1, 5)):
        got = sorted(tuple(r[c] for c in names) for r in collocations.collocations(docs, longest, least, most).collect())
        assert got == plain_collocations(docs.collect(), longest, least, most)
    assert collocations.collocations(no_docs(spark)).count() == 0


def test_chunks_count_every_run_once():
    rnd = np.random.default_rng(3)
    for size in (0, 1, 2, 3, 4, 500, 4000):
        tokens = [b"w%d" % i for i in rnd.integers(0, 30, size)]
        hashes = collocations.Hashes().of(tokens, "en")[0]
        starts = []
        for chunk, last in collocations.parse(tokens, hashes, 3):
            words = chunk.split(b" ")
            starts += [tuple(words[i : i + 4]) for i in range(len(words) - (0 if last else 3))]
        assert [s[0] for s in starts] == tokens
        assert [s for s in starts if len(s) == 4] == [tuple(tokens[i : i + 4]) for i in range(size - 3)]


# ---- context-tree weighting ----------------------------------------------


def plain_scores(rows, held, depth):
    """Bit by bit, with a dictionary of counts per context."""
    bodies = [b"".join(w + b" " for w in re.findall(rb"[^\x20\x09-\x0D]+", t.encode())) + b"\n" for t in texts_of(rows)]

    def decisions(body):
        data = b"\n" * depth + body
        for at in range(depth, len(data)):
            for b in range(8):
                yield data[at - depth : at], (1 << b) | (data[at] >> (8 - b)), data[at] >> (7 - b) & 1

    counts = defaultdict(lambda: [0, 0])
    for body, out in zip(bodies, held, strict=True):
        if not out:
            for context, node, bit in decisions(body):
                for d in range(depth + 1):
                    counts[context[depth - d :], node][bit] += 1
    children = defaultdict(list)
    for context, node in counts:
        if context:
            children[context[1:], node].append((context, node))
    own, weighted = {}, {}
    for key in sorted(counts, key=lambda k: -len(k[0])):
        a, b = counts[key]
        own[key] = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        below = sum(weighted[c] for c in children[key])
        weighted[key] = own[key] if len(key[0]) == depth else np.logaddexp(own[key], below) - math.log(2)

    def one(context, node, d=0):
        key = context[depth - d :], node
        if key not in counts:
            return 0.5
        a, b = counts[key]
        estimate = (b + 0.5) / (a + b + 1)
        if d == depth:
            return estimate
        share = math.exp(own[key] - math.log(2) - weighted[key])
        return share * estimate + (1 - share) * one(context, node, d + 1)

    tokens = [[*body.split(), b"\n"] for body in bodies]
    c = Counter(t for ts, out in zip(tokens, held, strict=True) if not out for t in ts)
    total, kinds = sum(c.values()), len(c)
    return [(len(ts), sum(c[t] > 0 for t in ts), total, sum(math.log10((c[t] + 1) / (total + kinds + 1)) for t in ts),
             sum(math.log10(p if bit else 1 - p) for context, node, bit in decisions(body) for p in [one(context, node)]))
            for ts, body in zip(tokens, bodies, strict=True)]


def scores(spark, docs, held, depth=5):
    rows = context_tree.score_texts(docs, held, depth=depth).collect()
    return sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows)


def test_scores_equal_a_plain_tree(spark, monkeypatch):
    docs = awkward_docs(spark).filter(F.coalesce(F.length("text"), F.lit(0)) < 3000)
    held = F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False))
    rows = docs.withColumn("held", held).collect()
    for depth in (3, 4, 5):
        want = plain_scores(rows, [r.held for r in rows], depth)
        want = sorted((repr(r.doc_id), r.held, *w[:3], round(w[3], 6), round(w[4], 6)) for r, w in zip(rows, want, strict=True))
        assert scores(spark, docs, held, depth) == want
    # Rarer grams and tokens come through the join: nothing changes without the heads.
    monkeypatch.setattr(context_tree, "HEAD_GRAMS", 0)
    monkeypatch.setattr(context_tree, "HEAD_WORDS", 0)
    assert scores(spark, docs, held, 5) == want


def test_scores_without_training_or_rows(spark):
    none = scores(spark, awkward_docs(spark).limit(3), F.lit(True))
    assert all(r[3] == r[4] == 0 and r[5] == 0.0 for r in none)
    row = context_tree.score_texts(awkward_docs(spark).filter("doc_id = 100"), F.lit(True)).first()
    assert math.isclose(row.score, 8 * math.log10(0.5)) and row.n_bytes == 1
    assert context_tree.score_texts(no_docs(spark), F.lit(False)).count() == 0


def test_a_block_looks_up_each_gram_once(monkeypatch):
    bodies, looked = [b"ab ab ab \n", b"\n", b"\xff\xfe abab \n", b"ab ab ab \n"], []
    for depth in (3, 4, 5, 6):
        want = [int.from_bytes((b"\n" * depth + b)[i : i + depth + 1], "big") for b in bodies for i in range(len(b))]
        assert context_tree.grams_of(bodies, depth).tolist() == want
    find = context_tree.Lookup.find
    monkeypatch.setattr(context_tree.Lookup, "find", lambda self, key: looked.append(key.tolist()) or find(self, key))

    class Texts:  # stands in for a table: gives the function that runs in a task
        def select(self, *names):
            return self

        def mapInArrow(self, ask, schema):
            return ask

    class Sent:
        def __init__(self, value):
            self.value = value

    head = np.array(sorted(set(want))[:4])
    ask = context_tree._asked(Texts(), 6, Sent((head, head * 1.0)), Sent({b"ab": 3}))
    batch = pa.record_batch([pa.array([5] * 4), pa.array([False] * 4), pa.array(bodies, pa.binary())], names=["block", "held_out", "body"])
    rows = [r for b in ask(iter([batch])) for r in b.to_pylist()]
    assert sorted(r["key"] for r in rows if r["key"] is not None) == sorted(set(want) - set(head.tolist()))
    assert sorted(r["word"] for r in rows if r["word"] is not None) == sorted([b"\n", b"\xff\xfe", b"abab"])
    assert sum(map(len, looked)) == len(set(want))


def test_estimates_and_lookup():
    a, b = np.array([0.0, 3, 900, 1e9]), np.array([0.0, 5, 40, 1])
    exact = [math.lgamma(x + 0.5) + math.lgamma(y + 0.5) - math.lgamma(x + y + 1) - math.log(math.pi) for x, y in zip(a, b, strict=True)]
    got = context_tree.log_kt(a, b)
    assert np.allclose(got[:3], exact[:3], rtol=1e-11, atol=1e-11)
    assert abs(got[3] - exact[3]) < 1e-4  # differences of numbers near 2e10, in either version
    rnd = np.random.default_rng(1)
    key = np.unique(rnd.integers(0, 1 << 48, 5000))
    table = context_tree.Lookup(key, key * 2.0)
    assert np.array_equal(table.find(key), key * 2.0) and np.isnan(table.find(key + (1 << 50))).all()
    assert len(context_tree.Lookup(key[:0], key[:0]).find(key[:0])) == 0
