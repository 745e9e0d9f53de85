"""Operators on texts against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import llm_cases
import numpy as np
import public_tokenizers
import pytest
from llm_cases import words

from larder.llm import language_id, lm_scoring, near_dedup, packing, pii, substring_dedup
from larder.llm.graph import components

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["cases", "corpus"])
def test_substring_dedup(table, request):
    docs = request.getfixturevalue(table)
    first = {}
    late = lambda i: math.inf if i is None else i
    for i, t in sorted(rows_of(docs), key=lambda r: late(r[0])):
        ws = words(t)
        for at in range(len(ws) - 19):
            place = (late(i), at)
            first[tuple(ws[at : at + 20])] = min(place, first.get(tuple(ws[at : at + 20]), place))
    expected = Counter()
    for i, t in rows_of(docs):
        ws = words(t)
        gone = {at + k for at in range(len(ws) - 19) if first[tuple(ws[at : at + 20])] != (late(i), at) for k in range(20)}
        kept = b" ".join(w for k, w in enumerate(ws) if k not in gone)
        expected[i, len(ws), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    got = substring_dedup.remove_repeats(docs, with_text=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("table", ["cases", "corpus"])
def test_packing(table, request):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(table)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = packing.pack(docs, TOKENIZER, with_ids=True).toPandas()
    assert [zlib.crc32(x) for x in got["ids"]] == got["ids_crc32"].tolist()
    assert (got["ids"].str.len() == 4 * got["length"]).all()
    expected = Counter((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows_of(docs))
    joined = Counter()
    for (i, _), own in got.groupby([got["doc_id"].fillna(-1), "doc_tokens"]):
        copies = int((own["start"] == 0).sum())
        own = own.sort_values(["start"], kind="stable")
        text = b"".join(own["ids"].iloc[k] for k in range(0, len(own), copies))
        joined[None if i < 0 else int(i), text] += copies
    assert joined == expected
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"])[:-1]]
        assert s["length"].sum() <= 2048
    assert got["sequence_id"].nunique() == got["sequence_id"].max() + 1
    if table == "corpus":
        assert got["length"].sum() >= 0.98 * 2048 * got["sequence_id"].nunique()


def shingles(text, size):
    ws = [w.lower() for w in words(text)]
    return frozenset(tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))) if ws else frozenset()


@pytest.mark.parametrize("table", ["cases", "corpus"])
def test_near_dedup(table, request):
    docs = request.getfixturevalue(table)
    sets = {i: shingles(t, 4) for i, t in rows_of(docs)}
    low = {i: i for i in sets}
    for _ in range(4):
        for a in sets:
            for b in sets:
                if None not in (a, b) and a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    got = near_dedup.link(docs, shingle=4).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), low[r.doc_id])
        assert r.kept == (r.doc_id == low[r.doc_id])
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).count() == 0


def test_near_dedup_of_a_large_star(spark):
    """Copies of one text with different edits are linked by the text alone; a region of them is larger than any neighbourhood."""
    base = [f"w{i}" for i in range(150)]
    docs = [(0, " ".join(base))]
    for i in range(1, 200):
        copy = list(base)
        for k in range(4):
            copy[(i * 7 + 37 * k) % 150] = f"edit{i}x{k}"
        docs.append((i, " ".join(copy)))
    got = near_dedup.link(spark.createDataFrame(docs, "doc_id long, text string"), shingle=4).collect()
    assert {r.component_id for r in got} == {0}


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 201), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


TRICKY = [
    "a@b.c@d.e x@@y.z q@w .@. a.b+c@d-e.f.g, @x.y a@b", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1..2.3.4 12.3.4", "4111 1111 1111 1111-4111111111111111 4111111111111112",
    "+1 (499) 555-6503, +1+2+33 4455667788 +123 +12345678901234567890", "é中 x@y.zz 中 +49 30 1234567", "1" * 500 + "." + "2" * 400 + " " + "x" * 900 + "@", "4" * 16,
]


def test_identifiers(spark, cases, corpus):
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    docs = cases.select("doc_id", "text").union(corpus.select("doc_id", "text")).union(extra)
    expected = Counter()
    for i, t in rows_of(docs):
        found = {k: [m.span() for m in re.finditer(p, t or "") if holds(k, m[0])] for k, p in PATTERNS.items()}
        listed = ",".join(f"{k}:{a}:{b}" for k, spans in found.items() for a, b in spans)
        expected[i, *[len(s) for s in found.values()], hashlib.sha256(listed.encode()).hexdigest()] += 1
    got = pii.detect(docs).collect()
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == expected


def test_disclosing_terms(spark):
    """A name that stands by one address in different surroundings is a term; everyday words and words of copies are not."""
    filler = ["the meeting was held on", "please send the report to", "contact for the garden club", "questions about rent go to", "written and signed by"]
    docs = [(i, f"{f} Zaphod zaph@example.org today and the rest {i}") for i, f in enumerate(filler)]
    docs += [(100 + i, f"the meeting of the club number {i} was held on monday and the rest") for i in range(60)]
    docs += [(300 + i, "copied Vogon note vog@example.org unchanged") for i in range(9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detect(frame).collect()}
    for i in range(len(filler)):
        at = docs[i][1].index("Zaphod")
        assert f"term:{at}:{at + 6}" in got[i].spans
    assert all(not r.terms for i, r in got.items() if i >= 100)
    clean = {r.doc_id: r.text for r in pii.sanitize(frame).collect()}
    assert "Zaphod" not in clean[0] and "[EMAIL]" in clean[0] and clean[0].startswith("the meeting was held on")
    assert clean[100] == docs[5][1] and "Vogon" in clean[300] and "vog@" not in clean[300]


def test_sanitize_keeps_rows(cases):
    clean = pii.sanitize(cases)
    assert clean.columns == cases.columns
    assert clean.exceptAll(cases).count() == 0 and clean.count() == cases.count()


def ppm(counts, order, word):
    """Log10 probability of a word by the definition, context by context."""
    table = [defaultdict(Counter) for _ in range(order + 1)]
    for w, n in counts.items():
        s = b" " * order + w + (b"" if w == b"\n" else b" ")
        for i in range(order, len(s)):
            for k in range(order + 1):
                table[k][s[i - k : i]][s[i]] += n
    s, total = b" " * order + word + (b"" if word == b"\n" else b" "), 0.0
    for i in range(order, len(s)):
        out = set()
        for k in range(order, -1, -1):
            seen = {x: n for x, n in table[k][s[i - k : i]].items() if x not in out}
            if not seen:
                continue
            mass = sum(seen.values()) + len(seen)
            if s[i] in seen:
                total += math.log10(seen[s[i]] / mass)
                break
            total += math.log10(len(seen) / mass)
            out |= set(seen)
        else:
            total -= math.log10(256 - len(out))
    return total


def test_lm_scoring(cases):
    docs = rows_of(cases)
    held = {i for i, _ in docs if i is not None and zlib.crc32(str(i).encode()) % 5 == 1}
    tokens = [(i, [w.lower() for w in words(t)] + [b"\n"]) for i, t in docs]
    counts = Counter(w for i, ws in tokens if i not in held for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = sorted(lm_scoring.score(cases).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    expected = sorted(tokens, key=lambda r: (r[0] is None, r[0] or 0))
    for r, (i, ws) in zip(got, expected, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, i in held, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        if len(ws) < 10:
            assert r.score == pytest.approx(sum(ppm(counts, lm_scoring.ORDER, w) for w in ws))


def test_lm_probabilities_add_up(spark):
    words_ = spark.createDataFrame([(bytearray(w), n) for w, n in ((b"ab", 5), (b"abc", 2), (b"b", 1), (b"\n", 4))], "word binary, n_train bigint")
    model = lm_scoring.train(words_)
    first = [model.log10([bytes([c])])[0] - model.log10([bytes([c]) + b"x"])[0] for c in (97, 98)]
    assert all(math.isfinite(x) for x in first)
    heads = sum(10 ** ppm({b"ab": 5, b"abc": 2, b"b": 1, b"\n": 4}, 5, bytes([c])) for c in range(256) if c not in (9, 10, 11, 12, 13, 32))
    assert heads <= 1


def test_language_id(spark, cases):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    own = {r.doc_id: r for r in language_id.identify(cases).collect()}
    assert len(own) == len({i for i, *_ in llm_cases.texts()})
    assert all(own[i].lang_pred == "und" and own[i].score == 0 for i in (4, 5, 6))
    assert all(0 <= r.score <= 1 and r.lang_pred for r in own.values())


def test_language_spans_of_mixed_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    part = {r.lang: r.text for r in docs.filter("doc_id % 5 = 2 and length(text) > 900 and not text like '%|%' and lang in ('en', 'fr')").collect()}
    halves = [" ".join(part[x].split()[:60]) for x in ("en", "fr")]
    mixed = spark.createDataFrame([(100_000, " ".join(halves), None)], "doc_id long, text string, lang string")
    row = language_id.identify(docs.union(mixed)).filter("doc_id = 100000").first()
    assert [s.lang for s in row.spans] == ["en", "fr"]
    assert abs(row.spans[0].end - 60) <= 3


def test_scripts_narrow_candidates(spark):
    rows = [(i, "привет мир это текст" if i % 2 else "hello world this is text", "ru" if i % 2 else "en") for i in range(40)]
    rows += [(900, "мир xyz", None), (901, "這是", None)]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [s.lang for s in got[900].spans][0] == "ru"
    assert got[901].lang_pred in ("en", "ru")


def test_viterbi_is_exact():
    import itertools

    rng = np.random.default_rng(0)
    lengths = np.array([5, 1, 0, 7, 3])
    scores = rng.normal(size=(16, 3)).astype(np.float32) * 3
    path, at = language_id.viterbi(scores, lengths, 2.0), 0
    for n in lengths:
        s = scores[at : at + n]
        value = lambda q, s=s: sum(s[i, x] for i, x in enumerate(q)) - 2 * sum(x != y for x, y in itertools.pairwise(q))
        assert tuple(path[at : at + n]) == max(itertools.product(range(3), repeat=int(n)), key=value)
        at += n


def test_empty_tables(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert packing.pack(empty, TOKENIZER).count() == 0
    assert near_dedup.link(empty).count() == 0
    assert pii.detect(empty).count() == 0
    assert pii.sanitize(empty).columns == empty.columns
    assert lm_scoring.score(empty).count() == 0
    assert language_id.identify(empty).count() == 0
