"""The grammar: threats with their targets, negation and reported speech; and what the labels teach, on rows held out."""

from __future__ import annotations

import zlib

import pytest

from trilayer.llm import toxicity
from trilayer.llm.toxicity import NEGATED, REPORTED, TARGETED, THREAT_WEIGHT

PLAIN = toxicity.Grammar({"idiot": 4.0})
FULL = THREAT_WEIGHT * TARGETED


def weight(text, grammar=PLAIN):
    return grammar.features(text)[0]


@pytest.mark.parametrize("text", [
    "I will kill you", "we are going to hurt him", "he was killed", "they were attacked", "you: you, I shoot", "ich werde dich töten",
    "er wurde getötet", "je vais te tuer", "ils sont tués", "te voy a matar", "kill them all", "you will be beaten",
])
def test_threats_find_their_target_on_either_side(text):
    assert weight(text) == pytest.approx(FULL)


@pytest.mark.parametrize("text", [
    "they kill time", "he shoots a film", "she beats the eggs", "kill the process", "a shot of rum", "the killing floor", "they said nothing",
    "kill one two three four you", "you one two three four kill", "skills you", "kill. You there", "", None, "you",
])
def test_without_a_target_near_there_is_no_threat(text):
    assert weight(text) == 0


def test_negation_and_reports_weaken_threats_and_insults():
    assert weight("never kill you") == pytest.approx(FULL * NEGATED)
    assert weight("not one two three four kill you") == pytest.approx(FULL)
    assert weight("she said kill you") == pytest.approx(FULL * REPORTED)
    assert weight("an idiot") == 4 and weight("you idiot") == pytest.approx(4 * TARGETED)
    assert weight("not an idiot") == pytest.approx(4 * NEGATED) and weight("they wrote idiot") == pytest.approx(4 * REPORTED * TARGETED)
    assert weight("patriotidiot") == 0 and weight("idiots") == 4


def test_a_threat_counts_once_for_each_verb():
    assert weight("kill you you") == pytest.approx(FULL)
    assert weight("kill you and shoot you") == pytest.approx(2 * FULL)


def test_the_composed_machine_is_its_parts():
    """Every transition met moves each machine as it would move alone."""
    weight("they said never kill you idiot he was shot not you kill them")
    for (state, read), (after, _, complete) in PLAIN.__dict__["_grammar"].table.items():
        alone = tuple(m(s, read) for m, s in zip(toxicity.MACHINES, state))
        assert after == (alone if not complete else (*alone[:4], 0))


def test_held_out_rows(spark):
    """Precision and recall on the labelled documents that nothing was learned from."""
    sf = "/root/testdata/sf0.1"
    rows = toxicity.op7_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null")
    got = {r.doc_id: r for r in rows.collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    judged = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    hits = sum(p and y for p, y in judged)
    precision, recall = hits / sum(p for p, _ in judged), hits / sum(y for _, y in judged)
    print(f"held out: precision {precision:.3f}, recall {recall:.3f}, {len(judged)} documents")
    assert precision >= 0.85 and recall >= 0.85
