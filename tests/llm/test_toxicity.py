from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from larder.llm import toxicity
from larder.llm.toxicity import INSULT, LINE, NEGATED, NOT, NOTHING, OTHER, QUOTE, REPORTED, SAYS, STOP, TARGET, THREAT, WILL, Machine

LABELS = "doc_id long, quality int, toxic int, text string, held_out string"


def kinds(text: str, stems=None) -> list[str]:
    machine = Machine(stems or {"idiot$": 4.0, "vequ": 3.0})
    return [toxicity.KINDS[kind] for _, _, kind, _ in machine.matches(text)]


def test_clauses():
    assert kinds("An idiot came by.") == ["insult"]
    assert kinds("You are an idiot.") == ["addressed"]
    assert kinds("An idiot, that is what you are.") == ["insult", "answered"]
    assert kinds("You left. An idiot came.") == ["insult"]  # the address ended with its clause
    assert kinds("You are not an idiot.") == ["negated"]
    assert kinds("You are not, as he believed for long, an idiot.") == ["addressed"]  # out of the negation's reach
    assert kinds("She said an idiot came.") == ["reported"]
    assert kinds("“Idiot. You idiot!” she cried. An idiot!") == ["reported", "reported", "insult"]
    assert kinds("I will hurt you") == ["threat"] and kinds("You will burn") == ["threat"]
    assert kinds("I will not hurt you") == [] and kinds("They burn wood") == []
    assert kinds("un VEQUETTE, vequ!") == ["insult", "insult"] and kinds("idiotic idiots") == []
    assert kinds("") == [] and kinds("...\n\"\"") == []


def test_matches_are_placed_and_weighed():
    assert Machine({"idiot$": 4.0}).matches("Sì, you idiot") == [(8, 13, toxicity.ADDRESSED, 4.0)]


def test_long_texts_are_read_in_parts(monkeypatch):
    text = "quiet words go on and on " * 30 + "you are such an idiot. " + "more quiet words " * 30 + "idiot, you"
    whole = Machine({"idiot$": 4.0}).matches(text)
    monkeypatch.setattr(toxicity, "PART", 40)
    assert Machine({"idiot$": 4.0}).matches(text) == whole and len(whole) == 3


def test_composition_equals_the_cascade():
    rng = random.Random(4)
    stages = [toxicity.negation(), toxicity.reported_speech(), toxicity.clause()]
    machine = toxicity.grammar()
    assert toxicity.negation().then(toxicity.reported_speech()).then(toxicity.clause()).arcs == machine.arcs
    for _ in range(300):
        symbols = [rng.choice([OTHER, STOP, LINE, QUOTE, NOT, SAYS, TARGET, WILL, THREAT, INSULT, INSULT]) for _ in range(40)]
        passed = symbols
        for transducer in stages:
            passed, _ = transducer.run(passed)
        assert machine.run(symbols)[0] == passed


def test_machines_are_total():
    for transducer in (toxicity.negation(), toxicity.reported_speech(), toxicity.clause(), toxicity.grammar()):
        states = {state for state, _ in transducer.arcs}
        assert all((state, symbol) in transducer.arcs for state, symbol in itertools.product(states, transducer.inputs))
        assert {to for to, _ in transducer.arcs.values()} <= states
    assert NOTHING not in range(NEGATED, REPORTED)


def test_held_out_documents_are_told_apart(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{name}.parquet") for name in ("documents", "labels"))
    scored = toxicity.score(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    toxic, clean = [r.score for r in scored if r.toxic == 1], [r.score for r in scored if r.toxic == 0]
    assert len(toxic) > 50 and len(clean) > 300
    # six of the 97 toxic texts have been overwritten by junk and hold nothing that could be found
    assert np.mean([s >= 0.5 for s in toxic]) > 0.9 and np.mean([s < 0.5 for s in clean]) > 0.99
    assert np.mean([a > b for a in toxic for b in clean]) > 0.93


def labelled(spark, cases):
    ids = [r.doc_id for r in cases.select("doc_id").distinct().collect()]
    return spark.createDataFrame([(i, 1, (i or 0) % 2 if i != 5 else None, "clash", "clash") for i in ids], LABELS)


def test_cases(spark, cases, empty):
    labels = labelled(spark, cases)
    rows = toxicity.score(cases, labels).collect()
    assert len(rows) == cases.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {r.doc_id: r.held_out for r in rows} == {r.doc_id: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows}
    assert toxicity.score(empty, labels).isEmpty()
    plain = toxicity.score(cases, labels.limit(0)).collect()
    assert len({r.score for r in plain}) == 1 and plain[0].predicted == 0
    by_text = {}
    for r in toxicity.score(cases, labels).collect():
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())


def test_held_out_labels_have_no_part(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert a.stems == b.stems and a.weights.tolist() == pytest.approx(b.weights.tolist())


def test_copies_of_a_text_give_no_evidence():
    toxic = {"idiot$": 40, "rare$": 2, "the$": 400}
    kept = toxicity.choose_stems(toxic, {"the$": 3000}, 5000, 40000)
    assert list(kept) == ["idiot$"]
