"""Induced sorting, suffix-array removal and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, awkward_docs, no_docs

from strata.llm import induced_sort, jaccard_join, shingles, suffix_dedup
from strata.llm.components import components

LAST = suffix_dedup.LAST


@pytest.mark.parametrize("block,tail", [(3, 64), (16, 64), (1 << 16, 1 << 15)])
def test_suffixes_and_common_prefixes(monkeypatch, block, tail):
    monkeypatch.setattr(induced_sort, "BLOCK", block)
    monkeypatch.setattr(induced_sort, "TAIL", tail)
    rnd = random.Random(block)
    for _ in range(40):
        words = [[rnd.randint(1, 3) for _ in range(rnd.randint(1, 12))] for _ in range(4)]
        s = [x for _ in range(rnd.randint(1, 10)) for x in sum((rnd.choice(words) for _ in range(rnd.randint(1, 6))), []) + [0]]
        depth = rnd.choice([4, 20, 60])
        blocks = list(induced_sort.sorted_suffixes(np.array(s, np.uint16), depth))
        at, same = ([x for b in blocks for x in b[k].tolist()] for k in (0, 1))
        assert sorted([*at, len(s) - 1]) == list(range(len(s)))
        for p, q, n in zip(at, at[1:], same[1:]):
            assert s[p : p + depth] <= s[q : q + depth]
            equal = next((i for i, (x, y) in enumerate(zip(s[p : p + depth], s[q : q + depth])) if x != y), min(depth, len(s) - max(p, q)))
            assert n == equal


def test_large_arrays_lie_in_files(monkeypatch):
    monkeypatch.setattr(induced_sort, "IN_MEMORY", 16)
    assert isinstance(induced_sort.array_of(100, np.int64), np.memmap)
    text = np.array(([1, 2, 1, 2, 3, 0] * 30), np.uint16)
    assert sum(len(p) for p, _ in induced_sort.sorted_suffixes(text, 20)) == len(text) - 1


def brute_removals(rows):
    """Per row: (id, bytes, removed, runs, digest of the rest)."""
    first = {}
    raw = [(LAST if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, b in raw:
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            first[w] = min(first.get(w, key), key)
    out = []
    for key, own, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < key:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((own, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(rnd, n):
    """Documents that share passages, lines and edges in every combination."""
    pool = ["".join(rnd.choice("abcdé \n") for _ in range(rnd.randint(20, 160))) for _ in range(12)]
    return [(rnd.randint(0, n), "".join(rnd.choice(pool)[rnd.randint(0, 15) :] for _ in range(rnd.randint(1, 6)))) for _ in range(n)]


def test_removal_equals_brute_force(spark):
    rnd = random.Random(8)
    rows = passages(rnd, 150) + [(500 + i, "ab" * 200) for i in range(5)] + [(None, "ab" * 100), (600, "short"), (601, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.suffix_dedup(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_removals(rows)


def test_anchors_of_texts_end_to_end(monkeypatch):
    """Every string is in one run, under its least hash; no run leaves its text or passes the limit."""
    monkeypatch.setattr(suffix_dedup, "RUN", 64)
    monkeypatch.setattr(suffix_dedup, "TEXT_BLOCK", 700)
    rnd = random.Random(4)
    texts = [t.encode() for _, t in passages(rnd, 30)] + [b"", b"ab" * 200, b"short", b"0" * 900, b"", b"x" * 50]
    cuts = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    held = {}
    for low, high in suffix_dedup.blocks_of(cuts):
        own, first, last, text = suffix_dedup.anchors(data[cuts[low] : cuts[high]], cuts[low : high + 1] - cuts[low])
        for h, a, b, k in zip(own.tolist(), first.tolist(), last.tolist(), text.tolist()):
            assert b - a < 64
            for at in range(a, b + 1):
                place = (low + k, at + int(cuts[low] - cuts[low + k]))
                assert place not in held
                held[place] = h
    want = {}
    for k, t in enumerate(texts):
        for at in range(len(t) - 49):
            want[k, at] = int(suffix_dedup.gram_hashes(np.frombuffer(t[at : at + 50], np.uint8)).min())
    assert held == want


def test_places_of_many_documents_are_joined():
    rnd = random.Random(9)
    rows = sorted((rnd.randrange(4), rnd.randrange(2), (s := rnd.randrange(400)) << 32 | s + rnd.randrange(1, 30)) for _ in range(120))
    who, mark, ats = (np.array(x, np.int64) for x in zip(*rows))
    spans, doc = suffix_dedup.joined_arrays(ats, who, mark)
    got = defaultdict(list)
    for span, at in zip(spans.tolist(), doc.tolist()):
        got[int(who[at]), int(mark[at])].append(span)
    want = defaultdict(list)
    for w, m, at in rows:
        want[w, m].append(at)
    assert got == {k: suffix_dedup.joined(v) for k, v in want.items()}


@pytest.mark.parametrize("rows", [1, 3, 1000])
def test_keys_are_whole_in_batches_of_any_size(rows):
    rnd = random.Random(rows)
    key = sorted(rnd.choice([-5, 0, 1, 2, 3, 9]) for _ in range(40))
    table = pa.table({"key": pa.array(key), "at": pa.array(range(40))})
    found = [t.to_pylist() for t in suffix_dedup.whole_keys(iter(table.to_batches(max_chunksize=rows)))]
    assert [r for t in found for r in t] == table.to_pylist()
    keys = [{r["key"] for r in t} for t in found]
    assert sum(map(len, keys)) == len(set(key))


def test_a_shard_of_arrays_finds_every_string():
    rnd = random.Random(12)
    pieces = sorted({t.encode()[:300] for _, t in passages(rnd, 60) if len(t.encode()) >= 50})
    least = np.array([rnd.randrange(20) for _ in pieces])
    marks = [[rnd.randrange(2) for _ in range(rnd.randint(1, 3))] for _ in pieces]  # a row each
    ats = [[[rnd.randrange(50) * 1000 for _ in range(rnd.randint(1, 2))] for _ in m] for m in marks]
    shard = suffix_dedup.Shard()
    for a, b in ((0, 7), (7, len(pieces))):
        places = [[s << 32 | s + len(p) for s in at] for p, of in zip(pieces[a:b], ats[a:b]) for at in of]
        shard.add(pa.array(pieces[a:b], pa.large_binary()), least[a:b], np.array([len(m) for m in marks[a:b]]),
                  np.array(sum(marks[a:b], [])), np.array([len(p) for p in places]), np.array(sum(places, [])))
    got = {(r["id"], r["mark"]): r["ats"] for batch in shard.spans() for r in batch.to_pylist()}
    first = {}
    for p, who in zip(pieces, least.tolist()):
        for k in range(len(p) - 49):
            first[p[k : k + 50]] = min(first.get(p[k : k + 50], who), who)
    want = defaultdict(list)
    for p, who, of, at in zip(pieces, least.tolist(), marks, ats):
        for m, starts in zip(of, at):
            want[who, m] += [s + k << 32 | s + k + 50 for s in starts for k in range(len(p) - 49) if first[p[k : k + 50]] < who]
    assert got == {k: suffix_dedup.joined(v) for k, v in want.items() if v}


def test_a_long_run_of_one_byte(spark):
    """One anchor owns a run longer than a fragment and than a block of texts."""
    rows = [(1, "0" * 9000 + "a"), (2, "b" + "0" * 5000), (3, "0" * 60 + "c" + "0" * 4200), (4, "d" * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert got == {1: 0, 2: 5000, 3: 4260, 4: 0}


def test_removal_on_awkward_rows(spark):
    docs = awkward_docs(spark)
    got = suffix_dedup.suffix_dedup(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_removals([(r.doc_id, r.text) for r in docs.collect()])
    assert suffix_dedup.suffix_dedup(no_docs(spark)).count() == 0


def test_texts_without_repeats(spark):
    passage = "the same passage of text that is longer than fifty bytes, é included"
    docs = spark.createDataFrame([(1, "one " + passage, "s", "en", 3, None, None, None), (2, passage + " two", "s", "en", 3, None, None, None), (3, None, "s", "en", None, None, None, None)], SCHEMA)
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(docs).collect()}
    assert got[1].text == "one " + passage and got[2].text == " two" and got[2].n_chars == 4
    assert got[3].text is None and got[2].id is None


def brute_components(rows):
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in held[x] if j < i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(rnd, groups, copies):
    rows = []
    for g in range(groups):
        words = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(3, 120))]
        for _ in range(copies):
            own = list(words)
            for _ in range(rnd.randint(0, 3)):
                own[rnd.randrange(len(own))] = f"e{rnd.randint(0, 50)}"
            rows.append((len(rows), " ".join(own)))
    line = " ".join(f"common{i}" for i in range(8))
    return [(d, t + " " + line if d % 3 == 0 else t) for d, t in rows]


@pytest.mark.parametrize("chunk", [1024, 6])
def test_components_equal_brute_force(spark, monkeypatch, chunk):
    """Also with chunks far smaller than the groups."""
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 6)
    rows = near_copies(random.Random(3), 12, 14) + [(900, None), (901, ""), (902, "one two"), (903, "ONE two"), (None, "one two"), (904, "lonely")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_join(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components(rows)


def test_join_on_awkward_rows(spark):
    docs = awkward_docs(spark)
    got = jaccard_join.jaccard_join(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert jaccard_join.jaccard_join(no_docs(spark)).count() == 0
    kept = jaccard_join.representatives(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[104] == ids[105] == 0 and ids[0] == ids[101] == ids[107] == 1


def test_tree_bound_never_drops_a_link():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([rnd.choice(base, rnd.integers(20, 300), replace=False), rnd.integers(0, 1 << 63, 9).astype(np.uint64)])) for _ in range(60)]
    ids, n = np.arange(60), np.array([len(s) for s in sets])
    chunk = jaccard_join.Chunk(ids, n, ids.copy(), [jaccard_join.bitmap_of(s).tobytes() for s in sets])
    found = {frozenset((int(chunk.ids[a]), int(chunk.ids[b]))) for x, y, _ in jaccard_join.open_pairs(chunk, chunk) for a, b in zip(x, y)}
    for i in range(60):
        for j in range(i):
            same = len(np.intersect1d(sets[i], sets[j]))
            if 100 * same >= 80 * (n[i] + n[j] - same):
                assert frozenset((i, j)) in found


def test_shingles_follow_the_words():
    assert len(shingles.shingle_set("a b c d e f a b c d e")) == 6  # one of seven twice
    assert (shingles.shingle_set("A  B\nc") == shingles.shingle_set("a b c")).all()
    assert len(shingles.shingle_set(" \t")) == 0
    assert shingles.word_hashes("ab ab")[0] == shingles.word_hashes("ab ab")[1]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))


@pytest.mark.parametrize("block", [1, 40, 1 << 18])
def test_shingles_of_texts_end_to_end(monkeypatch, block):
    monkeypatch.setattr(shingles, "TEXT_BLOCK", block)
    texts = ["", "  ", "a", "a b c d", "x" * 300, "a b c d e f a b c d e", "É É é A a", "\t\n a\x0b b", " a", "b ", "", "q r s t u v w " * 50, "a b c d", ""]
    got = shingles.shingle_sets(pa.array(["left out", *texts]).slice(1))
    assert [s.tolist() for s in got] == [shingles.shingle_set(t).tolist() for t in texts]


def test_linked_sets_share_enough_of_their_longer_prefixes():
    rnd = random.Random(6)
    base = [rnd.getrandbits(63) for _ in range(200)]
    sets = []
    for _ in range(120):
        size = rnd.randint(1, 90)
        sets.append(np.unique(np.array([*base[:size][: size - rnd.randint(0, size // 6)], *(rnd.getrandbits(63) for _ in range(rnd.randint(0, size // 9)))] or base[:1], np.uint64)))
    known = np.sort(np.array(base[:30], np.uint64))
    prefixes = jaccard_join._prefixes(sets, np.stack([known, np.arange(30, dtype=np.uint64)]))
    met = 0
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            same = len(np.intersect1d(x, y))
            if i != j and 100 * same >= 80 * (len(x) + len(y) - same):
                met += 1
                first = [p[: jaccard_join.prefix_length(len(s))] for p, s in ((prefixes[i], x), (prefixes[j], y))]
                assert len(np.intersect1d(*first)) >= 1
                assert len(np.intersect1d(prefixes[i], prefixes[j])) >= jaccard_join.shared_length((8 * len(x) + 9) // 10)
    assert met > 100


def test_a_cell_joins_what_links():
    rnd = random.Random(7)
    base = [rnd.getrandbits(63) for _ in range(400)]
    sets = [np.unique(np.array([v for v in base[k % 3 * 50 :][:300] if rnd.random() < 0.9], np.uint64)) for k in range(60)]
    comp = np.arange(100, 160) - np.arange(60) % 2 * (np.arange(60) < 4)  # 0 and 1, 2 and 3 are joined before
    got = jaccard_join.joined(comp, sets)
    root = {c: c for c in comp.tolist()}

    def least(x):
        return x if root[x] == x else least(root[x])

    for i in range(60):
        for j in range(i):
            same = len(np.intersect1d(sets[i], sets[j]))
            if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                a, b = sorted((least(int(comp[i])), least(int(comp[j]))))
                root[b] = a
    assert got.tolist() == [least(c) for c in comp.tolist()] and 1 < len(set(got.tolist())) < 58


def test_sets_travel_once_and_only_where_they_may_link(spark, monkeypatch):
    """Not for each group or round, and not for texts that share a passage."""
    seen = []
    usual = jaccard_join.linked
    monkeypatch.setattr(jaccard_join, "linked", lambda cells, sets: (seen.append((cells.count(), sets.count())), usual(cells, sets))[1])
    rnd = random.Random(5)
    line = " ".join(f"common{i}" for i in range(25))
    alone = [(1000 + i, " ".join(f"v{rnd.getrandbits(40)}" for _ in range(100)) + " " + line) for i in range(60)]
    rows = [(d, t) for d, t in near_copies(rnd, 8, 10)] + alone
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_join(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components(rows)
    assert 0 < sum(c for c, _ in seen) <= 100 and seen[0][1] <= 90
