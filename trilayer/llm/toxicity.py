"""Toxicity by a weighted finite-state grammar of clauses.

A lexicon transducer (an Aho-Corasick automaton over word beginnings and forms) reads a text and marks insults and threats;
the insults and their weights are learned from labelled documents. What it marks, and the fixed word classes of targets, negation
and reported speech, are the symbols of five small machines. They are composed: a state of the grammar is a state of each,
and reading a symbol moves all of them at once. An insult adds its weight, changed by the state it is met in. A threat waits some
words for a target on either side and adds its weight when both are there. Documents are scored by their matched clauses.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trilayer.llm.common import read, slices
from trilayer.llm.labelled import held_out, training_sample
from trilayer.operators import settle

# Word classes of the grammar, four languages. Objects can be meant wherever they stand, subjects if the verb is passive.
OBJECTS = frozenset("you your yourself him her them dich dir ihn sie euch te toi vous lui leur tú ti usted ustedes".split())
SUBJECTS = frozenset("they he she du ihr er tu ils elle ellos él ella".split())
PASSIVES = frozenset("was were is are be been being get gets got wird werden wurde wurden sera sont être fue fueron será ser".split())
NEGATIONS = frozenset("not no never nobody isn't aren't don't won't nicht kein keine nie ne pas jamais nunca jamás".split())
REPORTS = frozenset("said says wrote writes called reported quoted sagte schrieb nannte dit écrit appelé dijo escribió llamó".split())
THREATS = frozenset((
    "kill kills killed killing hurt hurts hurting destroy destroys destroyed destroying beat beats beaten beating "
    "attack attacks attacked attacking shoot shoots shot shooting töten tötet tötete getötet schlagen schlägt schlug geschlagen "
    "tuer tue tues tué tuée tués frapper frappe frappes frappé matar mata mató matado matarte golpear golpea golpeado golpearte"
).split())

# How a state changes the weight of what is met in it, and how many words a state lasts.
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 0.35, 0.5, 1.4, 2.0
NEGATION_SCOPE, THREAT_SCOPE = 4, 4

INSULT, THREAT, OBJECT, SUBJECT, PASSIVE, NEGATION, REPORT, OTHER = "insult", "threat", "object", "subject", "passive", "negation", "report", "other"


def symbol(word: str) -> str:
    """The class of a word that is neither an insult nor a threat."""
    if word in OBJECTS:
        return OBJECT
    if word in SUBJECTS:
        return SUBJECT
    if word in PASSIVES:
        return PASSIVE
    if word in NEGATIONS:
        return NEGATION
    return REPORT if word in REPORTS else OTHER


# The machines. Each is a function from its state and a symbol to its next state; all begin in 0.


def negation(state: int, read: str) -> int:
    """Words for which an open negation still holds."""
    return NEGATION_SCOPE if read == NEGATION else max(0, state - 1)


def reported_speech(state: int, read: str) -> int:
    """1 from a verb of saying on."""
    return 1 if read == REPORT else state


def target(state: int, read: str) -> int:
    """1 once somebody is spoken to or of."""
    return 1 if read in (OBJECT, SUBJECT) else state


def threatened(state: int, read: str) -> int:
    """Words for which whoever stood before is still near: 1 to scope for an object, the same and 10 for the subject of a passive.

    20 and the words left stand for a subject that waits for the passive.
    """
    if read == OBJECT:
        return THREAT_SCOPE
    if read == SUBJECT and not 0 < state <= THREAT_SCOPE:
        return 20 + THREAT_SCOPE
    if read == PASSIVE and state > 20:
        return 10 + THREAT_SCOPE
    return state - 1 if state % 10 > 1 else 0


def threat(state: int, read: str) -> int:
    """Words for which a threat still waits for its target."""
    if read == THREAT:
        return THREAT_SCOPE
    return 0 if read == OBJECT else max(0, state - 1)


MACHINES = (negation, reported_speech, target, threatened, threat)


class Composed:
    """The machines as one transducer, its transitions worked out when they are first met."""

    start = (0,) * len(MACHINES)

    def __init__(self):
        self.table: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], float, float]] = {}

    def move(self, state: tuple[int, ...], read: str) -> tuple[tuple[int, ...], float, float]:
        """Next state, factor of an insult that is read here, and weight of a threat that is complete here."""
        found = self.table.get((state, read))
        if found is None:
            negated, reported, targeted, near, waiting = state
            factor = (NEGATED if negated else 1) * (REPORTED if reported else 1) * (TARGETED if targeted else 1)
            complete = read == THREAT and 0 < near < 20 or read == OBJECT and waiting
            after = tuple(m(s, read) for m, s in zip(MACHINES, state))
            if complete:
                # A threat counts once; its target may be threatened again.
                after = (*after[:4], 0)
            found = self.table[state, read] = after, factor, THREAT_WEIGHT * factor * (not targeted and TARGETED or 1) if complete else 0.0
        return found


_CLAUSE = re.compile(r"[.!?;:\n|]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


def prefixes(word: str, shortest: int = 4, longest: int = 9) -> Iterator[str]:
    """Beginnings of a word, and the whole word marked with a final blank."""
    for n in range(shortest, min(longest, len(word)) + 1):
        yield word[:n]
    yield word + " "


@dataclass
class Grammar:
    """Lexicon (beginning or whole word to weight) and the calibration of clause scores."""

    lexicon: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0)

    def automaton(self):
        if "_automaton" not in self.__dict__:
            import ahocorasick

            found = ahocorasick.Automaton()
            entries: dict[str, list] = defaultdict(list)
            for entry, weight in self.lexicon.items():
                entries[entry.rstrip(" ")].append((entry[-1] == " ", weight))
            for form in THREATS:
                entries[form].append((True, None))
            for form, readings in entries.items():
                found.add_word(form, (len(form), readings))
            found.make_automaton()
            self.__dict__["_automaton"] = found
            self.__dict__["_grammar"] = Composed()
        return self.__dict__["_automaton"]

    def __getstate__(self):
        return {"lexicon": self.lexicon, "coefficients": self.coefficients}

    def marks(self, text: str) -> tuple[dict[int, float], set[int]]:
        """Start of each word that the lexicon knows, with the largest weight, and of each threat."""
        insults: dict[int, float] = {}
        threats: set[int] = set()
        for end, (n, readings) in self.automaton().iter(text):
            start = end - n + 1
            if start and text[start - 1].isalpha():
                continue
            inside = end + 1 < len(text) and text[end + 1].isalpha()
            for whole, weight in readings:
                if whole and inside:
                    continue
                if weight is None:
                    threats.add(start)
                else:
                    insults[start] = max(weight, insults.get(start, 0.0))
        return insults, threats

    def clause(self, words: list[tuple[int, str]], insults: dict[int, float], threats: set[int]) -> float:
        """Weight of one clause: a run of the composed transducer over its words."""
        self.automaton()
        move, state, total = self.__dict__["_grammar"].move, Composed.start, 0.0
        for at, word in words:
            weight = insults.get(at, 0.0)
            read = THREAT if at in threats else INSULT if weight else symbol(word)
            state, factor, threat_weight = move(state, read)
            total += weight * factor + threat_weight
        return total

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Largest clause, log of all clauses, matched clauses a hundred words."""
        text = (text or "").lower()
        insults, threats = self.marks(text)
        if not insults and not threats:
            return 0.0, 0.0, 0.0
        scores, at = [], 0
        for m in [*_CLAUSE.finditer(text), None]:
            end = m.start() if m else len(text)
            if (words := [(w.start(), w.group()) for w in _WORD.finditer(text, at, end)]) and (s := self.clause(words, insults, threats)):
                scores.append(s)
            at = m.end() if m else end
        if not scores:
            return 0.0, 0.0, 0.0
        return max(scores), math.log1p(sum(scores)), 100 * len(scores) / max(20, len(text) / 6)

    def score(self, values: tuple[float, float, float]) -> float:
        bias, *rest = self.coefficients
        z = bias + sum(c * v for c, v in zip(rest, values))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def learn_lexicon(sample: DataFrame, most: int = 2000, support: int = 4, purity: float = 0.8) -> dict[str, float]:
    """Word beginnings and words that toxic documents of ``sample`` (``text``, ``toxic``) hold and others do not.

    Documents are counted once each. The table of counts stays in Spark; at most ``most``
    entries reach the driver. A beginning replaces the longer entries that it covers unless
    one of them is much purer.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(found) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in (0, 1))], ["entry", "clean", "toxic"]
            )

        found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for batch in slices(batches):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_WORD.findall((text or "").lower()))
                for entry in {p for w in words for p in prefixes(w)}:
                    found[entry][toxic] += 1
            if len(found) > 300_000:
                yield part(found)
                found.clear()
        yield part(found)

    totals = sample.groupBy("toxic").count().collect()
    clean, toxic = (sum(r["count"] for r in totals if r["toxic"] == y) for y in (0, 1))
    if not clean or not toxic:
        return {}
    table = sample.select("text", F.col("toxic").cast("int")).mapInArrow(counts, "entry string, clean bigint, toxic bigint")
    table = table.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Rates, so that the share of toxic documents in the sample does not matter.
    t, c = F.col("toxic") / toxic, F.col("clean") / clean
    table = table.where((F.col("toxic") >= support) & (t / (t + c) >= purity)).withColumn("lift", F.log2((t + 0.5 / toxic) / (c + 0.5 / clean)))
    rows = table.orderBy(F.desc(F.col("lift") * F.sqrt("toxic")), "entry").limit(most).collect()
    return _shortest({r["entry"]: (r["lift"], r["toxic"]) for r in rows})


def _shortest(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Drop what a longer beginning says almost as often, then what a shorter one already covers."""
    most: dict[str, int] = defaultdict(int)
    for entry, (_, n) in found.items():
        if entry[-1] != " ":
            for i in range(1, len(entry)):
                most[entry[:i]] = max(most[entry[:i]], n)
    kept: dict[str, float] = {}
    for entry in sorted(found, key=lambda e: (len(e.rstrip(" ")), e)):
        lift, n = found[entry]
        stem = entry.rstrip(" ")
        over = [kept[stem[:i]] for i in range(1, len(entry)) if stem[:i] in kept]
        if most[entry] < 0.9 * n and (not over or lift > max(over) + 1.5):
            kept[entry] = lift
    return kept


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton steps, both classes weighted alike up to a factor of four."""
    a = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, min(4.0, (y == 0).sum() / max(1, (y == 1).sum())), 1.0)
    c = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ c, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(c))
        step = np.linalg.solve(h, a.T @ (weight * (y - p)) - ridge * c)
        c = c + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in c)


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> Grammar:
    """Learn lexicon and calibration from at most ``most_rows`` labelled documents that are not held out."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = training_sample(known, most_rows)
    sample = settle(docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", "toxic"))
    fold = F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string")).cast("binary")) % 2 == 0
    # The calibration sees scores of documents that the lexicon was not learned from.
    half = Grammar(learn_lexicon(sample.where(fold)))
    rows = sample.where(~fold).select("text", F.col("toxic").cast("int"))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [half.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in zip(*found)), batch.column(1)], ["a", "b", "c", "toxic"])

    rows = rows.mapInArrow(values, "a double, b double, c double, toxic int").collect()
    if len({r["toxic"] for r in rows}) < 2:
        return Grammar()
    coefficients = calibrate(np.array([r[:3] for r in rows]), np.array([r["toxic"] for r in rows]))
    return Grammar(learn_lexicon(sample), coefficients)


def score_documents(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with ``score`` between 0 and 1; a column of that name is replaced.

    Null and empty texts get the score of a text without a match. All rows stay.
    """
    docs = docs.drop("score")
    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType())])
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [grammar.score(grammar.features(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    return docs.mapInArrow(score, schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
