"""Token counting and byte-level BPE against the public libraries."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from helpers import awkward_docs, by_id, no_docs
from tokenizers import Tokenizer

from strata.llm import byte_bpe, token_count

WORDS, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = "ab'sStTreVElLmd  \n\t\r 12é日ΣςİßÁ  \x1c\x85!?.<|endoftext|>😀²½̀"


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    out = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    return out + ["a<|endoftext|>b <|startoftext|>", "x" * 3000, "'", "it's we'll 'twas", " \n\n a", "a \n "]


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library(texts):
    counts, library = token_count.word_counts(WORDS), Tokenizer.from_file(WORDS)
    assert [counts.of_text(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_merge_count_takes_lowest_rank_leftmost():
    ranks = {("a", "a"): 0, ("aa", "a"): 1}
    assert token_count.merge_count(list("aaaa"), ranks) == 2  # aa aa
    assert token_count.merge_count(list("aaa"), ranks) == 2
    assert token_count.merge_count(["a"], ranks) == 0


def test_ids_equal_the_library_and_decode(texts, tik):
    codec = byte_bpe.codec(RANKS)
    for text, (ids, first) in zip(texts, codec.encode(texts)):
        assert ids.tolist() == tik.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
        half = len(first) // 2
        cut = codec.decode_slices(ids, first, 0, half) + codec.decode_slices(ids, first, half, len(first))
        assert cut == text.encode()


def test_every_code_point_is_classed_as_the_library_has_it(tik):
    texts = [chr(c) + "'s" for c in [*range(0xD800), *range(0xE000, 0x33500), *range(0xE0000, 0xE0200)]]
    codec = byte_bpe.codec(RANKS)
    assert [t for t, (ids, _) in zip(texts, codec.encode(texts), strict=True) if ids.tolist() != tik.encode_ordinary(t)] == []


def test_long_slices_merge_alike(tik):
    codec = byte_bpe.codec(RANKS)
    for text in ("ab" * 400, "日本語" * 90, "é" * 300):
        assert next(codec.encode([text]))[0].tolist() == tik.encode_ordinary(text)


def test_scan_over_many_blocks_and_batches(monkeypatch, texts, tik):
    monkeypatch.setattr(byte_bpe, "SCAN_CHARS", 700)
    got = [ids.tolist() for ids, _ in byte_bpe.codec(RANKS).encode(texts[:600])]
    assert got == [tik.encode_ordinary(t) for t in texts[:600]]


def test_count_tokens_on_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = token_count.count_tokens(docs, WORDS, limit=3).collect()
    library = Tokenizer.from_file(WORDS)
    expected = []
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        expected.append((r.doc_id, len((r.text or "").encode()), n, n > 3))
    assert by_id(rows, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert token_count.count_tokens(no_docs(spark), WORDS).count() == 0


def test_round_trip_on_awkward_rows(spark, tik):
    docs = awkward_docs(spark)
    rows = byte_bpe.round_trip(docs, RANKS).collect()
    expected = []
    for r in docs.collect():
        ids = tik.encode_ordinary(r.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert by_id(rows, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert byte_bpe.round_trip(no_docs(spark), RANKS).count() == 0


def test_slices_not_met_before_are_merged_side_by_side(monkeypatch):
    codec = byte_bpe.Codec(RANKS)
    texts = ["banana bananas ", "жижижи 中中中 ааа", "x" * 40 + " " + "ing" * 14, "", "'ss 0123456789"]
    pieces = list(dict.fromkeys(p for found in byte_bpe.slices(texts) for p in found))
    want = {p: byte_bpe.merge_pairs(p.encode(), codec.ranks) for p in pieces}
    assert max(map(len, want.values())) > 2
    monkeypatch.setattr(byte_bpe, "merge_pairs", None)  # one slice at a time is only for long ones
    got = [ids.tolist() for ids, _ in codec.encode(texts)]
    assert got == [[i for p in found for i in want[p]] for found in byte_bpe.slices(texts)]
    assert codec.pairs.merge([p.encode() for p in pieces]) == [byte_bpe.np.array(want[p], "int32").tobytes() for p in pieces]
