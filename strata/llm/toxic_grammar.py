"""Toxicity by a weighted finite-state grammar over clauses.

Every word is read as a symbol: an insult, a threat, a target (a person spoken
to or about), a negation, a reporting verb, or a plain word; trailing
punctuation ends a clause.  Four letter-to-letter transducers rewrite the
symbols of a clause:

* target    marks insults and threats that follow a target closely (AIMED);
* negation  marks those within the reach of a negation (NEGATED);
* report    marks those after a reporting verb in the same clause (REPORTED);
* matching  keeps insults, and threats that are aimed, as matches.

They are composed once into a single machine, and a clause is one run through
its table.  A match is worth the precision of its lexical entry times the
factor of its pattern; the clause counts with its best match, and clauses
combine as independent evidence.  A harmful word thus weighs less when it is
denied or quoted, and a threat without a target is no match at all.

Learning.  Entries (whole words and stems) and their precision come from the
labelled rows for which the caller's condition holds: at most ``sample_rows``
of them, a documented bound.  Sequential covering takes the entry that is least
likely by chance, sets the documents it explains aside, and goes on until
chance could explain the next one.  Pattern factors are measured on the same
rows, pulled towards the grammar's own values.

Defined cases: null and empty texts have no clause and score 0; without
labelled toxic rows there are no entries and every score is 0; repeated rows
are scored one by one and equally; with repeated ids in the labels the larger
label counts; a null id stays null; only the named columns are read; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged, text_batches

# Symbols; a harmful symbol carries marks in higher bits.
PLAIN, TARGET, NEGATION, REPORT, INSULT, THREAT = range(6)
AIMED, NEGATED, REPORTED, MATCH = 8, 16, 32, 64
HARMFUL = (INSULT, THREAT)
#: Words a negation and a target reach over.
NEGATION_REACH, TARGET_REACH = 3, 4

# Closed word classes in the four languages of the tables (fixed values).
TARGETS = "you your youre they them he she him her tu toi vous ils elle elles du dich dir ihr euch sie er tú usted ustedes ellos ellas él ella"
NEGATIONS = "not no never dont isnt arent wasnt without ne pas jamais sans nicht kein keine nie ohne nunca jamás sin tampoco"
REPORTS = "said says say called calls wrote quoted reported claimed dit disait écrit sagte sagt schrieb nannte dijo dice escribió llamó"
THREATS = "kill hurt destroy burn beat shoot stab punish tuer frapper brûler töten schlagen verbrennen matar golpear quemar"

#: What a pattern's matches are worth beside a plain insult, before learning.
FACTORS = {(INSULT, 0): 1.0, (INSULT, AIMED): 1.0, (INSULT, NEGATED): 0.6, (INSULT, REPORTED): 0.7, (THREAT, AIMED): 0.6}
#: Documents that the values above count for.
FACTOR_PRIOR = 8.0
THREAT_PRECISION = 0.6

#: Labelled rows read for learning, at most.
SAMPLE_ROWS = 16_384
#: Entries in the lexicon, at most, and stems' lengths in letters.
MAX_ENTRIES = 2_000
STEMS = (4, 5, 6)
MIN_DOCS = 3
#: Log probability at which chance no longer explains an entry.
CHANCE = -14.0

LETTERS = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:,…\"”»)\]]$")
CACHE_WORDS = 400_000


def transducer(states: int, rule) -> dict[tuple[int, int], tuple[int, int]]:
    """Steps (state, symbol) -> (state, symbol) of a rule over all symbols."""
    marks = [a | b | c for a in (0, AIMED) for b in (0, NEGATED) for c in (0, REPORTED)]
    alphabet = [PLAIN, TARGET, NEGATION, REPORT] + [h | m for h in HARMFUL for m in marks]
    return {(s, x): rule(s, x) for s in range(states) for x in alphabet}


def _kind(symbol: int) -> int:
    return symbol & 7


def _reach(trigger: int, mark: int, reach: int):
    def rule(left: int, x: int) -> tuple[int, int]:
        if x == trigger:
            return reach, x
        return max(left - 1, 0), x | mark if left and _kind(x) in HARMFUL else x

    return transducer(reach + 1, rule)


def _rest_of_clause(trigger: int, mark: int):
    return transducer(2, lambda on, x: (1, x) if x == trigger else (on, x | mark if on and _kind(x) in HARMFUL else x))


def _matching():
    def rule(state: int, x: int) -> tuple[int, int]:
        hit = _kind(x) == INSULT or (_kind(x) == THREAT and x & AIMED)
        return 0, x | MATCH if hit else x

    return transducer(1, rule)


def compose(first: dict, second: dict) -> dict[tuple[int, int], tuple[int, int]]:
    """The transducer that runs ``first`` and feeds ``second`` with what it writes.

    Pairs of states reachable from (0, 0) are numbered as they are met.
    """
    symbols = sorted({x for _, x in first})
    number, todo, out = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        a, b = pair = todo.pop()
        for x in symbols:
            a2, y = first[a, x]
            b2, z = second[b, y]
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            out[number[pair], x] = number[a2, b2], z
    return out


def grammar() -> dict[tuple[int, int], tuple[int, int]]:
    """All four transducers as one."""
    machine = _reach(TARGET, AIMED, TARGET_REACH)
    for part in (_reach(NEGATION, NEGATED, NEGATION_REACH), _rest_of_clause(REPORT, REPORTED), _matching()):
        machine = compose(machine, part)
    return machine


def word_forms(word: str) -> list[str]:
    """What an entry may be for a word: the word itself, and its stems."""
    return [word] + [f"{word[:n]}*" for n in STEMS if len(word) > n]


def letters(raw: str) -> list[str]:
    return LETTERS.findall(raw.replace("'", "").replace("’", "").lower())


@dataclass
class Grammar:
    """A fitted grammar: the composed machine, lexicon and pattern factors."""

    lexicon: dict[str, float]
    factors: dict[tuple[int, int], float] = field(default_factory=lambda: dict(FACTORS))

    def reader(self) -> Reader:
        return Reader(self)


class Reader(dict):
    """Symbols of raw words, worked out when first asked for, and the scoring run.

    A raw word maps to 0 when it is plain inside a clause; otherwise to an
    index into ``kinds``, whose rows hold the word's symbols, whether a clause
    ends after it, and the precision of its entry.
    """

    def __init__(self, model: Grammar):
        super().__init__()
        self.model = model
        self.machine = grammar()
        self.closed = {}
        for kind, listed in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            self.closed |= dict.fromkeys(listed.split(), kind)
        self.kinds: list[tuple[tuple[tuple[int, float], ...], bool]] = [(((PLAIN, 0.0),), False)]
        self.numbers = {self.kinds[0]: 0}
        self.harmful = [False]

    def symbols_of(self, raw: str) -> tuple[tuple[int, float], ...]:
        out = []
        for word in letters(raw):
            worth = max((self.model.lexicon.get(f, 0.0) for f in word_forms(word)), default=0.0)
            kind = INSULT if worth else self.closed.get(word, PLAIN)
            out.append((kind, THREAT_PRECISION if kind == THREAT else worth))
        return tuple(out) or ((PLAIN, 0.0),)

    def __missing__(self, raw: str) -> int:
        kind = self.symbols_of(raw), bool(CLAUSE_END.search(raw))
        if all(s == PLAIN for s, _ in kind[0]):
            kind = ((PLAIN, 0.0),), kind[1]
        if (number := self.numbers.get(kind)) is None:
            number = self.numbers[kind] = len(self.kinds)
            self.kinds.append(kind)
            self.harmful.append(any(s in HARMFUL for s, _ in kind[0]))
        if len(raw) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[raw] = number
        return number

    def clauses(self, text: str) -> Iterator[list[int]]:
        """Clauses that hold a harmful word, as numbers of kinds."""
        codes = list(map(self.__getitem__, text.split()))
        harmful = self.harmful
        if not any(harmful[c] for c in set(codes)):
            return
        at = 0
        for i, c in enumerate(codes):
            if self.kinds[c][1] or i == len(codes) - 1:
                clause = codes[at : i + 1]
                if any(harmful[x] for x in clause):
                    yield clause
                at = i + 1

    def matches(self, text: str) -> Iterator[list[tuple[tuple[int, int], float]]]:
        """Per clause with a match: (pattern, precision) of its matches."""
        for clause in self.clauses(text):
            state, found = 0, []
            for c in clause:
                for symbol, worth in self.kinds[c][0]:
                    state, written = self.machine[state, symbol]
                    if written & MATCH:
                        mark = next((m for m in (REPORTED, NEGATED, AIMED) if written & m), 0)
                        found.append(((_kind(written), AIMED if _kind(written) == THREAT and not mark else mark), worth))
            if found:
                yield found

    def score(self, text: str) -> float:
        """1 less the chance that none of the matched clauses is toxic."""
        clean, factors = 1.0, self.model.factors
        for found in self.matches(text):
            clean *= 1.0 - max(worth * factors.get(pattern, factors.get((pattern[0], 0), 0.5)) for pattern, worth in found)
        return 1.0 - clean


def _log_chance(toxic: np.ndarray, total: np.ndarray, share: float) -> np.ndarray:
    """Log of a bound on the chance that ``total`` draws hold ``toxic`` toxic ones."""
    p = np.clip(toxic / np.maximum(total, 1), 1e-9, 1 - 1e-9)
    share = min(max(share, 1e-6), 1 - 1e-6)
    gain = p * np.log(p / share) + (1 - p) * np.log((1 - p) / (1 - share))
    return np.where(p > share, -total * gain, 0.0)


def covering(incidence: list[np.ndarray], labels: np.ndarray, n_entries: int) -> dict[int, float]:
    """Entries taken by sequential covering, with their precision.

    ``incidence`` lists, per document, the numbers of the entries it holds.
    """
    docs = np.repeat(np.arange(len(incidence)), [len(i) for i in incidence])
    items = np.concatenate(incidence) if len(incidence) else np.zeros(0, np.int64)
    all_toxic = np.bincount(items, weights=labels[docs], minlength=n_entries)
    all_total = np.bincount(items, minlength=n_entries)
    open_docs, taken = np.ones(len(incidence), bool), {}
    while len(taken) < MAX_ENTRIES and len(items):
        keep = open_docs[docs]
        toxic = np.bincount(items[keep], weights=labels[docs[keep]], minlength=n_entries)
        total = np.bincount(items[keep], minlength=n_entries)
        chance = np.where(toxic >= MIN_DOCS, _log_chance(toxic, total, float(labels[open_docs].mean()) if open_docs.any() else 0.5), 0.0)
        best = int(np.argmin(chance))
        if chance[best] > CHANCE:
            break
        taken[best] = float((all_toxic[best] + 1.0) / (all_total[best] + 1.2))
        open_docs[docs[items == best]] = False
    return {k: v for k, v in taken.items() if v >= 0.5}


def labelled(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents, the first by a digest of the id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = known.orderBy(F.md5(F.col("id").cast("string")), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), "id")  # bounded by ``rows``


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Grammar:
    """Learn lexicon and factors from labelled rows where ``usable`` (a condition on the id) holds."""
    # Copies of a text are one witness: else every word of a copied toxic text would look like an entry.
    sample = labelled(docs, labels, usable, label_col, id_col, text_col, sample_rows)
    sample = staged(sample.groupBy(F.sha2("text", 256)).agg(F.max("label").alias("label"), F.first("text").alias("text")).select("label", "text"), "toxic-sample")

    def forms(text: str) -> set[str]:
        return {f for raw in set(text.split()) for w in letters(raw) for f in word_forms(w) if len(f) <= 40}

    def counted(known: dict[str, int] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter[str] = Counter()
            for batch in text_batches(batches):
                for text in batch.column(1).to_pylist():
                    seen.update(forms(text) if known is None else forms(text) & known.keys())
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["form", "n"])

        return run

    # Forms of toxic documents, then how often clean ones have them.
    toxic = sample.where("label = 1").mapInArrow(counted(None), "form string, n long")
    toxic = toxic.groupBy("form").agg(F.sum("n").alias("toxic")).where(F.col("toxic") >= MIN_DOCS)
    toxic = {r.form: r.toxic for r in toxic.orderBy(F.desc("toxic"), "form").limit(100_000).toLocalIterator()}
    clean = sample.where("label = 0").mapInArrow(counted(toxic), "form string, n long")
    clean = {r.form: r.n for r in clean.groupBy("form").agg(F.sum("n").alias("n")).toLocalIterator()}
    likely = sorted(f for f, n in toxic.items() if n >= clean.get(f, 0))
    number = {f: i for i, f in enumerate(likely)}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            held = [sorted(number[f] for f in forms(t) & number.keys()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.list_(pa.int32()))], ["label", "held"])

    rows = sample.mapInArrow(found, "label int, held array<int>").toArrow()
    held = [np.asarray(h, np.int64) for h in rows.column(1).to_pylist()]
    answers = np.asarray(rows.column(0).to_pylist(), np.float64)
    model = Grammar({likely[k]: v for k, v in sorted(covering(held, answers, len(likely)).items())})

    # What each pattern is worth, where all matches of a document have that pattern.
    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in text_batches(batches):
            keys, expected = [], []
            for text in batch.column(1).to_pylist():
                seen = [m for clause in reader.matches(text) for m in clause]
                one = {p for p, _ in seen}
                keys.append(",".join(map(str, *one)) if len(one) == 1 else None)
                expected.append(max((w for _, w in seen), default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.string()), pa.array(expected, pa.float64())], ["label", "pattern", "worth"])

    measured = sample.mapInArrow(patterns, "label int, pattern string, worth double").where("pattern IS NOT NULL")
    for r in measured.groupBy("pattern").agg(F.sum("label").alias("toxic"), F.sum("worth").alias("worth")).collect():  # one row a pattern
        key = tuple(map(int, r.pattern.split(",")))
        model.factors[key] = min(1.0, (r.toxic + FACTOR_PRIOR * FACTORS.get(key, 0.7)) / (r.worth + FACTOR_PRIOR))
    return model


def score_toxicity(docs: DataFrame, model: Grammar, held_out: Column, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value.reader()
        for batch in text_batches(batches):
            scores = [reader.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.mapInArrow(run, f"id {id_type}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_only(docs: DataFrame, model: Grammar, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = shared.value.reader()
        for part in texts:
            yield pd.Series([reader.score(t) if t else 0.0 for t in part], dtype="float64")

    return docs.where(score(F.col(text_col).cast("string")) < threshold)
