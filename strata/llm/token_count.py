"""Token counts by heap-and-linked-list pair merging.

A word is a linked list of symbols.  Every adjacent pair with a rank waits in
a heap; the lowest rank (leftmost first) is popped, its two symbols become
one, and the pairs with the new neighbours are pushed.  Each merge shortens
the list by one, so the count is the initial symbols minus the merges: no
identifiers are produced.

The tokenizer file (the ``tokenizers`` JSON of a word-level BPE with an
end-of-word mark) is a parameter.  Counts equal ``encode(text,
add_special_tokens=False)`` of that library: special strings inside a text
count as one token each.

Defined cases: null text counts as empty (0 tokens); repeated rows are kept
one by one; a null id stays null; only the two named columns are read, so
other columns of any name do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_batches

#: Characters with the Unicode property White_Space (fixed values).
WHITE = "\t-\r \x85\xa0  -     　"
#: str.split() also splits at these, the tokenizer does not.
SEPARATOR_CONTROLS = re.compile("[\x1c-\x1f]")
#: Distinct words kept with their counts by one worker.
CACHE_WORDS = 500_000


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges ``symbols`` take, lowest rank first, leftmost among equals."""
    n = len(symbols)
    if n < 2:
        return 0
    symbols = list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, *pair) for i, pair in enumerate(pairwise(symbols)) if (r := ranks.get(pair)) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = left + right, ""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
        if (p := before[i]) >= 0 and (r := ranks.get((symbols[p], symbols[i]))) is not None:
            heapq.heappush(heap, (r, p, symbols[p], symbols[i]))
        merges += 1
    return merges


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value.

    Printable Latin-1 characters stand for themselves; the other values take
    the code points from 256 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordCounts(dict):
    """Tokens of each white-space separated word, worked out when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
        self.ranks = {pair: r for r, pair in enumerate(pairs)}
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.bytes = byte_symbols()
        self.known: dict[str, int] = {}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}"))
        self.special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(self.special)) if self.special else None
        self.white = re.compile(f"[{WHITE}]+")

    def __missing__(self, word: str) -> int:
        plain = unicodedata.normalize("NFC", word)
        # Lower case letter by letter: no rule that looks at a letter's place in the word.
        plain = plain.lower() if "Σ" not in plain else "".join(c.lower() for c in plain)
        total = sum(map(self.of_piece, self.pieces.findall(plain)))
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = total
        return total

    def of_piece(self, piece: str) -> int:
        """Tokens of one match of the pre-tokenizer's pattern."""
        if (known := self.known.get(piece)) is not None:
            return known
        symbols = [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        total = len(symbols) - merge_count(symbols, self.ranks)
        if len(piece) <= 64:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[piece] = total
        return total

    def of_text(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.special is not None and "<" in text and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.of_text(p) for p in parts if p)
        words = self.white.split(text) if SEPARATOR_CONTROLS.search(text) else text.split()
        return sum(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    """One cache per worker process and tokenizer."""
    return WordCounts(path)


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, and whether the tokens exceed ``limit``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(tokenizer)
        for batch in text_batches(batches):
            n = [counts.of_text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
