"""Toxicity by a weighted finite-state grammar of clauses.

A clause is read as a sequence of symbols: insult, threat, target (a word for a person), negation, verb of
reporting, other word. Three transducers rewrite it, and their composition is one transducer over clauses:

* *negation*: an insult or threat up to three words after a negation is a negated one;
* *reported speech*: after a verb of reporting, insults and threats are reported ones;
* *target*: an insult in a clause that names a target, before or after it, is a directed one.

A text's score is a logistic function of how often each kind of match occurs in its clauses, so what counts
is a matched clause, not a word by itself. Only clauses that hold an insult or threat are read; an
Aho-Corasick automaton over the lexicon finds them.

Insults are learned: word beginnings (or whole words) of a sample of labelled texts that hardly occur in clean
ones. Copies of one text would make its rare words look toxic, so support counts distinct MinHash
values of texts, not texts. The weights are fitted to the same sample around prior values that hold where
the sample says nothing, for example of negated insults.

The sample is bounded: ``TOXIC_SAMPLE`` and ``CLEAN_SAMPLE`` texts, those with the smallest hash of their id. Labels of
rows that are held out (crc32 of the id as text, modulo 4, is 2) are never used.

Defined results. Null and empty texts get the score of a text without matches. Without toxic labels
the lexicon has no insults. Several labels of an id: toxic if one is. Repeated rows get equal scores; other columns
are ignored. Whole texts are read, of any length.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourstar.llm.batches import pieces
from hourstar.session import stored

TOXIC_SAMPLE, CLEAN_SAMPLE = 3000, 9000
THRESHOLD = 0.3
LEAST_SUPPORT = 4  # distinct MinHash values of toxic texts
CHANCE = 3.0  # how many beginnings may be expected to look as telling by chance
LEAST_RATIO = 25.0  # how much more frequent in toxic texts
STEM_LENGTHS = range(3, 13)

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END = "ITPNRO#"
DIRECTED, NEGATED, REPORTED = "Dnr"
WAITING = "?"  # an insult that a later target of its clause may make a directed one
KINDS = INSULT + DIRECTED + NEGATED + REPORTED + THREAT
# Weights before any label is seen, in the order of KINDS, and the constant.
PRIOR = (2.5, 3.5, 0.5, 0.5, 2.0, -3.0)

# Words of the grammar in the corpus's four languages.
WORDS_OF = {
    THREAT: "kill killing murder hurt destroy shoot stab umbringen töten erschießen tuer tuerai frapper matar mataré golpear",
    TARGET: "you your yours u he she they them him her du dich dir dein deine ihr euch sie tu te toi ton ta vous votre vos "
            "usted ustedes tú ti tus vosotros",
    NEGATION: "not no never isn't aren't don't without nicht kein keine keinen nie niemals ohne pas jamais aucun sans nunca jamás sin ni",
    REPORT: "said says say told called claimed reported wrote sagte sagt nannte behauptete schrieb dit disait appelé écrit "
            "dijo dice llamó escribió",
}
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_WORD = re.compile(r"[^\W\d_]+")


class Transducer(NamedTuple):
    """Deterministic: ``step(state, symbol)`` gives the next state and the symbols written."""

    start: object
    step: Callable[[object, str], tuple[object, str]]

    def compose(self, after: "Transducer") -> "Transducer":
        """Reads what this one reads and writes what ``after`` makes of its output."""

        def step(state, symbol):
            own, other = state
            own, middle = self.step(own, symbol)
            written = ""
            for s in middle:
                other, more = after.step(other, s)
                written += more
            return (own, other), written

        return Transducer((self.start, after.start), step)

    def compiled(self, symbols: str) -> tuple[list[dict[str, tuple[int, str]]], int]:
        """The reachable states as a table, and the start."""
        number, table, todo = {self.start: 0}, [], [self.start]
        while todo:
            state, row = todo.pop(0), {}
            for symbol in symbols:
                following, written = self.step(state, symbol)
                if following not in number:
                    number[following] = len(number)
                    todo.append(following)
                row[symbol] = number[following], written
            table.append(row)
        return table, 0


def negation() -> Transducer:
    def step(left: int, symbol: str) -> tuple[int, str]:
        if symbol == NEGATION:
            return 4, OTHER
        if symbol in (INSULT, THREAT) and left > 1:
            return 0, NEGATED
        return max(0, left - 1), symbol

    return Transducer(0, step)


def reported_speech() -> Transducer:
    def step(reported: bool, symbol: str) -> tuple[bool, str]:
        if symbol == REPORT:
            return True, OTHER
        return reported, REPORTED if reported and symbol in (INSULT, THREAT, NEGATED) else symbol

    return Transducer(False, step)


def target() -> Transducer:
    """Insults before a clause's first target are written as waiting; the target, or the clause's end, decides on all of
    them by writing itself. So no state counts them, however many there are."""

    def step(named: bool, symbol: str) -> tuple[bool, str]:
        if symbol == TARGET:
            return True, "" if named else TARGET
        if symbol == INSULT:
            return named, DIRECTED if named else WAITING
        if symbol == END:
            return False, END
        return named, symbol if symbol in KINDS else ""

    return Transducer(False, step)


def settled(written: str) -> Counter:
    """How often each of KINDS occurs in what was written for a clause: waiting insults are directed ones
    if its target was named."""
    found = Counter(written)
    waiting, named = found.pop(WAITING, 0), found.pop(TARGET, 0)
    found.pop(END, None)
    if waiting:
        found[DIRECTED if named else INSULT] += waiting
    return found


@lru_cache(maxsize=1)
def grammar() -> list[dict[str, tuple[int, str]]]:
    whole = negation().compose(reported_speech()).compose(target())
    return whole.compiled(INSULT + THREAT + TARGET + NEGATION + REPORT + OTHER + END)[0]


class Model(NamedTuple):
    """``stems``: word beginnings, or whole words with ``$`` behind. ``weights``: by KINDS, then the constant."""

    stems: tuple[str, ...] = ()
    weights: tuple[float, ...] = PRIOR


class Reader:
    """Finds matched clauses with a model's lexicon."""

    def __init__(self, stems: Iterable[str]):
        self.symbol = {w: s for s, words in WORDS_OF.items() for w in words.split()}
        self.stems = frozenset(stems)
        self.longest = max(map(len, self.stems), default=0)
        self.automaton = ahocorasick.Automaton()
        for stem in [*self.stems, *(w + "$" for w in WORDS_OF[THREAT].split())]:
            bare = stem.removesuffix("$")
            whole = stem.endswith("$") and bare not in self.stems
            self.automaton.add_word(bare, (len(bare), whole))
        self.automaton.make_automaton()

    def hits(self, text: str) -> Iterator[int]:
        """Places of words that are insults or threats."""
        for end, (length, whole) in self.automaton.iter(text):
            at = end + 1 - length
            if (at == 0 or not text[at - 1].isalpha()) and not (whole and end + 1 < len(text) and text[end + 1].isalpha()):
                yield at

    def is_insult(self, word: str) -> bool:
        return word + "$" in self.stems or any(word[:n] in self.stems for n in range(1, min(len(word), self.longest) + 1))

    def matches(self, text: str) -> Counter:
        """How often each of KINDS occurs in the text's clauses."""
        lower, done, found = text.lower(), -1, Counter()
        if not len(self.automaton):
            return found
        table = grammar()
        for at in self.hits(lower):
            if at < done:
                continue
            # Not before the end of the clause read last, so that every character is passed over once.
            start = max(lower.rfind(c, max(done, 0), at) for c in ".!?;:\n") + 1 or max(done, 0)
            ending = _CLAUSE_END.search(lower, at)
            done = ending.start() if ending else len(lower)
            state, clause = 0, []
            for match in _TOKEN.finditer(lower, start, done):
                word = match.group()
                symbol = self.symbol.get(word) or (INSULT if self.is_insult(word) else OTHER)
                state, written = table[state][symbol]
                clause.append(written)
            clause.append(table[state][END][1])
            found.update(settled("".join(clause)))
        return found


def features(found: Counter) -> list[float]:
    return [math.log2(1 + found[k]) for k in KINDS] + [1.0]


def score(model: Model, found: Counter) -> float:
    z = sum(w * x for w, x in zip(model.weights, features(found)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


@lru_cache(maxsize=4)
def reader(stems: tuple[str, ...]) -> Reader:
    return Reader(stems)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``text, toxic`` of the labelled texts to learn from; at most TOXIC_SAMPLE + CLEAN_SAMPLE ids."""
    usable = labels.select(labels[id_col].alias("id"), labels["toxic"].alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    known = usable.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("id"), F.col("id")
    chosen = known.where("toxic = 1").orderBy(*order).limit(TOXIC_SAMPLE).union(
        known.where("toxic <> 1").orderBy(*order).limit(CLEAN_SAMPLE))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("text IS NOT NULL")
    # Of several texts of an id the smallest, so that the model does not depend on the order of rows.
    return rows.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", (F.col("toxic") == 1).alias("toxic"))


def beginnings(text: str) -> set[str]:
    out = set()
    for word in set(_WORD.findall(text.lower())):
        if len(word) >= STEM_LENGTHS.start:
            out.update(word[:n] for n in STEM_LENGTHS if n <= len(word))
            out.add(word + "$")
    return out


def min_hash(text: str) -> int:
    """Of the shingles of three words: unlike single words, texts that are no copies hardly share them."""
    words = _WORD.findall(text.lower())
    return min((xxhash.xxh32_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)


def frequent_beginnings(texts: DataFrame) -> list[tuple[str, int, int]]:
    """(beginning, distinct MinHash values of toxic texts, clean texts) for those with enough support."""

    def of_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in pieces(batches, 0):
            rows = [(b, h) for t in group for h in [min_hash(t)] for b in beginnings(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["part", "hash"])

    toxic = texts.where("toxic").select("text").mapInArrow(of_toxic, "part string, hash long")
    support = {
        r.part: r.n for r in toxic.distinct().groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_SUPPORT).collect()
    }

    def of_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for _, group in pieces(batches, 0):
            for t in group:
                counted.update(beginnings(t) & support.keys())
        yield pa.RecordBatch.from_arrays([pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], ["part", "n"])

    clean = texts.where("NOT toxic").select("text").mapInArrow(of_clean, "part string, n long")
    among = {r.part: r.n for r in clean.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    return [(part, n, among.get(part, 0)) for part, n in sorted(support.items())]


def choose_stems(counted: list[tuple[str, int, int]], toxic: int, clean: int) -> tuple[str, ...]:
    """The shortest telling beginnings, each made as long as it can be without losing support."""
    share = toxic / max(1, toxic + clean)
    telling = {
        part: n for part, n, m in counted
        if len(counted) * share**n <= CHANCE and (n + 0.5) / (toxic + 1) >= LEAST_RATIO * (m + 0.5) / (clean + 1) and m <= 0.05 * n
    }
    longer = defaultdict(list)
    for part in telling:
        longer[part[:-1]].append(part)
    chosen: list[str] = []
    for part in sorted(telling, key=lambda p: (len(p), p)):
        if any(part.startswith(c) for c in chosen):
            continue
        best = part
        while True:
            further = [p for p in longer[best] if telling[p] >= 0.9 * telling[part]]
            if not further:
                break
            best = max(further, key=lambda p: (telling[p], p))
        chosen.append(best)
    return tuple(sorted(set(chosen)))


def fit_weights(found: list[tuple[Counter, bool]]) -> tuple[float, ...]:
    """Logistic regression around PRIOR, by Newton steps."""
    if not found:
        return PRIOR
    x = np.array([features(c) for c, _ in found])
    y = np.array([t for _, t in found], float)
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Model:
    texts = stored(sample(docs, labels, id_col, text_col), "labelled")
    sizes = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not sizes.get(True):
        return Model()
    stems = choose_stems(frequent_beginnings(texts), sizes[True], sizes.get(False, 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = reader(stems)
        for piece, group in pieces(batches, 0):
            found = [own.matches(t) for t in group]
            lists = pa.array([[c[k] for k in KINDS] for c in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column(1), lists], ["toxic", "found"])

    rows = texts.select("text", "toxic").mapInArrow(count, "toxic boolean, found array<int>").collect()
    return Model(stems, fit_weights([(Counter(dict(zip(KINDS, r.found))), r.toxic) for r in rows]))


def scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = reader(model.stems)
        for piece, texts in pieces(batches, 1):
            found = pa.array([score(model, own.matches(t)) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([piece.column(0), found], ["id", "score"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    scored = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def is_toxic(model: Model) -> Callable[[Column], Column]:
    """A filter on a text column."""
    @F.pandas_udf("boolean")
    def judged(texts: pd.Series) -> pd.Series:
        own = reader(model.stems)
        return texts.map(lambda t: score(model, own.matches(t or "")) >= THRESHOLD)

    return judged
