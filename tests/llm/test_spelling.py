from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from larder.llm import spelling


def lower(run: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def plain_words(rows, every=31, min_length=7, min_count=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words, ratio=10):
    """Every two words compared."""
    names = sorted(words)
    near = {w: [] for w in names}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in names:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in names}


def got(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def corpus(seed: int, n_words: int, docs: int):
    """Texts over a vocabulary of syllables, with misspelt copies of some words, chains of them among these."""
    rng = np.random.default_rng(seed)
    syllables = ["th", "an", "er", "in", "ou", "st", "é", "ÿa", "ß", "tion"]
    vocabulary = ["".join(rng.choice(syllables, rng.integers(3, 7))) for _ in range(n_words)]
    letters = "abcdeéñ"
    for w in list(vocabulary[: n_words // 2]):
        at = int(rng.integers(len(w)))
        vocabulary.append([w[:at] + w[at + 1 :], w[:at] + letters[rng.integers(7)] + w[at:], w[:at] + letters[rng.integers(7)] + w[at + 1 :]][rng.integers(3)])
    shares = 1 / np.arange(1, len(vocabulary) + 1) ** 1.3
    return [(i, " ".join(rng.choice(vocabulary, 300, p=shares / shares.sum())).title() if i % 3 else None if i % 2 else "1 2 3") for i in range(docs)]


@pytest.mark.parametrize("options", [{}, {"list_size": 2}, {"list_size": 1}, {"longest": 3}])
def test_equals_brute_force(spark, options):
    rows = corpus(1, 250, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(plain_words(rows))
    assert sum(1 for r in want if r[1] is not None) > 5 and max(r[4] for r in want) > 2
    assert got(spelling.variants(df, **options)) == want


def test_a_pruned_dictionary_changes_nothing(spark, monkeypatch):
    rows = corpus(2, 250, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(spelling, "DICTIONARY", 20)
    monkeypatch.setattr(spelling, "RARE", 3)
    assert got(spelling.variants(df)) == plain(plain_words(rows))


def test_hot_gram_shared_by_a_third_of_all_words(spark):
    rng = np.random.default_rng(5)
    words = ["internat" + "".join(rng.choice(list("aeiou"), 3)) for _ in range(120)] + ["".join(rng.choice(list("klmnop"), 9)) for _ in range(240)]
    rows = [(i, " ".join(words)) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spelling.variants(df, list_size=4)) == plain(plain_words(rows))


def test_chains_of_forms_lead_to_their_end(spark):
    words = {"abcdefgh": 5000, "abcdefg": 400, "abcdefx": 30, "abcdexx": 2}
    rows = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.word: (r.form, r.root) for r in spelling.variants(df, every=10**9).collect()}
    assert found == {"abcdefgh": (None, "abcdefgh"), "abcdefg": ("abcdefgh", "abcdefgh"), "abcdefx": ("abcdefg", "abcdefgh"), "abcdexx": ("abcdefx", "abcdefgh")}


def test_cases(cases, empty, spark):
    rows = [(r.doc_id, r.text) for r in cases.collect()]
    assert got(spelling.variants(cases)) == plain(plain_words(rows))
    assert spelling.variants(empty).isEmpty()
    with pytest.raises(ValueError):
        spelling.variants(cases, min_length=6)


def test_long_texts_are_cut_where_no_run_is(monkeypatch):
    monkeypatch.setattr(spelling, "PART", 10)
    text = "Abcdefghijklmnopqrst uvw xyzabcdefghijklmnopqr. aé ÿ " * 20
    cut = list(spelling.parts(text, 10))
    assert "".join(cut) == text and len(cut) > 20
    assert [r for p in cut for r in spelling.RUN.findall(p)] == spelling.RUN.findall(text)
