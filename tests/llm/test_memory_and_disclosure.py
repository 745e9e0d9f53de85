"""Memory of packing tasks, and disclosing terms against pointwise mutual information computed in plain Python."""

from __future__ import annotations

import gc
import math
import random
import re
import weakref

import public_tokenizers
from tokenizers import Tokenizer

from larder.llm import packing, pii


def test_a_dropped_tokenizer_is_freed_without_the_collector():
    gc.collect()
    gc.disable()
    try:
        tokenize = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
        tokenize(b"some words, more words")
        model = weakref.ref(tokenize.parts.make)
        del tokenize
        assert model() is None
    finally:
        gc.enable()


def test_memory_is_bounded_in_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenize, plain = packing.WordTokenizer(path, 20_000), Tokenizer.from_file(path)
    rng = random.Random(2)
    for _ in range(60):
        text = " ".join("".join(rng.choice("abcdefgé,.-<|>") for _ in range(rng.randint(1, 9))) for _ in range(50))
        ids = plain.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(tokenize(text.encode())[4 * i : 4 * i + 4], "little") for i in range(len(ids))] == ids
        assert tokenize.known.size < 20_000 + 60 * 400 and tokenize.parts.size < 20_000 + 60 * 400


def test_pieces_are_passed_on_in_parts(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "some words and more words " * (i % 90)) for i in range(400)], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = sorted(map(tuple, packing.pack(frame, path, with_ids=True).drop("sequence_id", "offset").collect()))
    monkeypatch.setattr(packing, "PASSED_ON", 100)
    assert sorted(map(tuple, packing.pack(frame, path, with_ids=True).drop("sequence_id", "offset").collect())) == whole


LETTERS = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*"


def plain_terms(docs):
    """For each text the terms whose PMI with one of its entities is at least the limit of that entity's information."""
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    holds, entity_of = [], []
    for text in docs:
        rest = mail.sub(lambda m: " " * len(m[0]), text)
        holds.append({t.lower() for t in re.findall(LETTERS, rest)})
        entity_of.append({m.lower() for m in mail.findall(text)})
    n, out = len(docs), [set() for _ in docs]
    for entity in set().union(*entity_of):
        with_it = [i for i in range(n) if entity in entity_of[i]]
        if len({docs[i] for i in with_it}) < 2:
            continue
        information = math.log2(n / len(with_it))
        for term in set().union(*[holds[i] for i in with_it]):
            both = [i for i in with_it if term in holds[i]]
            alone = sum(term in h for h in holds)
            if len({docs[i] for i in both}) >= 2 and math.log2(len(both) * n / (len(with_it) * alone)) / information >= 0.8:
                for i in both:
                    out[i].add(term)
    return out


def test_terms_equal_plain_mutual_information(spark):
    rng = random.Random(8)
    common = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    names = ["Zaphod", "Li", "O'Hara", "Smith/Jones", "Anna-Maria", "Trillian", "Ng", "X"]
    docs = []
    for i in range(240):
        words = rng.choices(common, k=40)
        if i % 6 == 0:
            who = (i // 6) % len(names)
            words.insert(7, f"p{who}@example.org")
            words.insert(rng.randrange(40), names[who])
            words.append(names[rng.randrange(len(names))] if rng.random() < 0.3 else "end")
        elif i % 31 == 0:
            words.insert(3, rng.choice(names))
        docs.append(" ".join(words))
    docs += docs[:6]  # copies count in frequencies, not as different texts
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5)
    want = plain_terms(docs)
    assert sum(map(len, want)) > 40 and any("li" in w for w in want) and any("jones" in w for w in want)
    for r in pii.detect(frame).collect():
        assert {docs[r.doc_id][t.start : t.end].lower() for t in r.terms} == want[r.doc_id], docs[r.doc_id]
