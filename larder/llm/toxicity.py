"""Toxicity by a weighted finite-state grammar over clauses.

A text becomes a sequence of symbols: insults from a learned lexicon, words of the fixed lists below, quotation marks, ends of clauses and lines.
Three deterministic transducers read it, composed into one machine: negation (an insult shortly after a negation is a negated one, a negated threat
none), reported speech (what stands after a reporting verb in its clause, or between quotation marks, is reported), and the clause grammar, which puts out
a match where a clause insults, insults someone it addresses, or threatens. A match weighs what its insult weighs in the lexicon. The score of a text is a
logistic function of its matches by kind; words outside matched clauses have no part in it.

Learning takes two passes over at most ``SAMPLE`` labelled rows, those of smallest hash, outside the held-out share:

- The lexicon holds stems (the first ``STEM`` letters or more, or a whole word) that are more frequent in toxic texts by ``LEAST_RATIO`` and beyond chance, by
  a Chernoff bound over all candidates. Toxic evidence is counted in different neighbourhoods (word before, word after), so copies of a text count once.
- The weights of the kinds of match come from a logistic regression with a normal prior around ``PRIOR``, which a kind without evidence keeps.

Everything that reaches the driver or all tasks is bounded by the sample: candidates, stems, and a few numbers per sampled text.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, with_rows

SAMPLE = 20_000
HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"
STEM, LONGEST_STEM = 4, 7
LEAST_CONTEXTS, LEAST_RATIO, CHANCE = 3, 4.0, 0.01
#: Words after a negation that it reaches, and its own symbol aside.
REACH = 3
#: Code points of a text that become symbols at once; words whose symbol a task remembers.
PART, REMEMBERED = 1_000_000, 400_000

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"«»„“”]")
BLANK = re.compile(r"\s")

#: Symbols. Those from THREAT on can begin a match; insults of the lexicon are numbered from INSULT on.
OTHER, STOP, LINE, QUOTE, NOT, SAYS, TARGET, WILL, THREAT, INSULT, NEGATED, REPORTED, REPORTED_THREAT = range(13)
#: What the clause grammar puts out, beside nothing.
NOTHING = -1
KINDS = ("insult", "addressed", "answered", "threat", "negated", "reported")
BARE, ADDRESSED, ANSWERED, THREATENED, DENIED, QUOTED = range(6)
#: Weights of a kind of match, and of an empty text, before any evidence.
PRIOR = np.array([1.0, 1.5, 0.5, 1.5, 0.0, 0.2, -2.0])
PRIOR_SPREAD = 2.0

#: Words of English, German, French and Spanish that the grammar knows, by symbol.
WORDS = {
    NOT: "not no never neither nor without hardly isn aren wasn don doesn didn won nicht kein keine keinen keiner keineswegs nie niemals weder"
    " pas jamais ni aucun aucune ne nunca tampoco ningún ninguna jamás",
    SAYS: "said says say saying told tells called calls wrote writes claims claimed quoted sagte sagt sagen behauptet schrieb nannte dit disait"
    " dire affirme écrit appelait dijo dice decir afirma escribió llamó",
    TARGET: "you your yours yourself u ur he she they him her them these those du dich dir dein deine deiner ihr euch euer sie er tu te toi ton ta tes vous"
    " votre vos ils elles tú ti tus usted ustedes vosotros ellos ellas",
    WILL: "will gonna going shall must hope ll werde werden wirst wird muss soll hoffe vais va vas allons doit espère voy vas vamos debe espero",
    THREAT: "kill hurt beat destroy murder stab shoot burn strangle punch töten umbringen verletzen schlagen zerstören ermorden erschießen tuer frapper"
    " détruire assassiner brûler blesser matar golpear destruir asesinar quemar herir",
}
MARKS = {"\n": LINE, **dict.fromkeys(".!?;:", STOP), **dict.fromkeys('"«»„“”', QUOTE)}


@dataclass
class Transducer:
    """A total deterministic transducer: ``arcs[state, symbol]`` is (next state, symbol put out); state 0 is the first."""

    arcs: dict[tuple[int, int], tuple[int, int]]
    inputs: range

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one puts out is read by ``other``. Only states that can be reached are made."""
        number, arcs, left = {(0, 0): 0}, {}, [(0, 0)]
        while left:
            a, b = pair = left.pop()
            for symbol in self.inputs:
                to_a, passed = self.arcs[a, symbol]
                to_b, out = other.arcs[b, passed]
                if (to_a, to_b) not in number:
                    number[to_a, to_b] = len(number)
                    left.append((to_a, to_b))
                arcs[number[pair], symbol] = (number[to_a, to_b], out)
        return Transducer(arcs, self.inputs)

    def run(self, symbols: list[int], state: int = 0) -> tuple[list[int], int]:
        out = []
        for symbol in symbols:
            state, said = self.arcs[state, symbol]
            out.append(said)
        return out, state


def negation() -> Transducer:
    """States count the words that a negation still reaches."""
    inputs, arcs = range(INSULT + 1), {}
    for state in range(REACH + 1):
        for symbol in inputs:
            after = REACH if symbol == NOT else 0 if symbol in (STOP, LINE) else state if symbol == QUOTE else max(state - 1, 0)
            said = {INSULT: NEGATED, THREAT: OTHER}.get(symbol, symbol) if state else symbol
            arcs[state, symbol] = (after, said)
    return Transducer(arcs, inputs)


def reported_speech() -> Transducer:
    """State 0 is plain, 1 after a reporting verb in its clause, 2 between quotation marks, which a line end closes."""
    inputs, arcs = range(NEGATED + 1), {}
    for state in range(3):
        for symbol in inputs:
            if symbol == LINE:
                after = 0
            elif symbol == QUOTE:
                after = 0 if state == 2 else 2
            elif state == 2:
                after = 2
            else:
                after = 0 if symbol == STOP else 1 if symbol == SAYS else state
            arcs[state, symbol] = (after, {INSULT: REPORTED, THREAT: REPORTED_THREAT}.get(symbol, symbol) if state else symbol)
    return Transducer(arcs, inputs)


def clause() -> Transducer:
    """State 0 is a clause so far without parts; bits: someone is addressed (1), an insult waits for its target (2), an intent (4), a threat waits (8)."""
    inputs, arcs = range(REPORTED_THREAT + 1), {}
    for state in range(16):
        for symbol in inputs:
            after, said = state, NOTHING
            if symbol in (STOP, LINE):
                after = 0
            elif symbol == TARGET:
                said = THREATENED if state & 8 else ANSWERED if state & 2 else NOTHING
                after = (state | 1) & ~(2 | 8)
            elif symbol == WILL:
                after = state | 4
            elif symbol == THREAT:
                said = THREATENED if state & 1 and state & 4 else NOTHING
                after = state if said == THREATENED or not state & 4 else state | 8
            elif symbol == INSULT:
                said = ADDRESSED if state & 1 else BARE
                after = state if state & 1 else state | 2
            elif symbol == NEGATED:
                said = DENIED
            elif symbol in (REPORTED, REPORTED_THREAT):
                said = QUOTED
            arcs[state, symbol] = (after, said)
    return Transducer(arcs, inputs)


def grammar() -> Transducer:
    return negation().then(reported_speech()).then(clause())


class Symbols(dict):
    """The symbol of a token, found once per different token: INSULT + i for the stem i of the lexicon."""

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.stems = {stem: i for i, stem in enumerate(stems)}
        self.weights = list(stems.values())
        self.fixed = {word: symbol for symbol, words in WORDS.items() for word in words.split()}

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = MARKS.get(token)
        if found is None:
            hits = [self.stems[s] for s in stems_of(token.lower()) if s in self.stems]
            found = INSULT + max(hits, key=lambda i: (self.weights[i], -i)) if hits else self.fixed.get(token.lower(), OTHER)
        self[token] = found
        return found


def stems_of(word: str) -> list[str]:
    """The word as a whole, marked, and its beginnings of ``STEM`` to ``LONGEST_STEM`` letters."""
    return [word + "$", *[word[:k] for k in range(STEM, min(len(word), LONGEST_STEM) + 1)]]


def parts(text: str) -> Iterator[tuple[int, str]]:
    """(offset, part) of a text, cut at blanks."""
    begin = 0
    while len(text) - begin > PART:
        end = BLANK.search(text, begin + PART)
        if end is None:
            break
        yield begin, text[begin : end.start()]
        begin = end.start()
    yield begin, text[begin:] if begin else text


@dataclass
class Machine:
    stems: dict[str, float]
    symbols: Symbols = field(init=False)

    def __post_init__(self) -> None:
        self.symbols = Symbols(self.stems)
        self.arcs = grammar().arcs

    def matches(self, text: str) -> list[tuple[int, int, int, float]]:
        """(start, end, kind, weight) of each match, in code points: the token that completes it."""
        found, state = [], 0
        symbols, arcs, weights = self.symbols, self.arcs, self.symbols.weights
        for offset, part in parts(text):
            codes = list(map(symbols.__getitem__, TOKEN.findall(part)))
            if len(part) == len(text) and max(codes, default=0) < THREAT:
                break
            last = 1.0
            places = None
            for i, code in enumerate(codes):
                symbol = min(code, INSULT)
                state, said = arcs[state, symbol]
                if symbol == INSULT:
                    last = weights[code - INSULT]
                if said != NOTHING:
                    if places is None:
                        places = [m.span() for m in TOKEN.finditer(part)]
                    weight = last if symbol == INSULT or said == ANSWERED else 1.0
                    found.append((offset + places[i][0], offset + places[i][1], said, weight))
        return found


def features(found: list[tuple[int, int, int, float]]) -> np.ndarray:
    """What matches of each kind weigh, damped, and a constant 1."""
    sums = np.zeros(len(KINDS) + 1)
    for _, _, kind, weight in found:
        sums[kind] += weight
    out = np.log1p(sums)
    out[-1] = 1.0
    return out


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, context) of toxic texts, each pair once a batch. A context is a checksum of the words before and after."""
    for batch in batches:
        pairs = set()
        for text in batch.column("text"):
            words = [w.lower() for w in TOKEN.findall(text.as_py() or "") if w not in MARKS]
            for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                place = zlib.crc32(f"{before} {after}".encode())
                pairs.update((stem, place) for stem in stems_of(word))
        if pairs:
            stems, places = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_pydict({"stem": pa.array(stems, pa.string()), "context": pa.array(places, pa.int64())})


def count_clean(candidates: set[str]):
    """(stem, n): places of the candidates in clean texts, and of all words under the empty stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                words = Counter(w.lower() for w in TOKEN.findall(text.as_py() or "") if w not in MARKS)
                counts[""] += words.total()
                for word, n in words.items():
                    for stem in stems_of(word):
                        if stem in candidates:
                            counts[stem] += n
        yield pa.RecordBatch.from_pydict({"stem": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    return run


def beyond_chance(toxic: int, clean: int, share: float) -> float:
    """The exponent of a Chernoff bound on ``toxic`` of all places being toxic by chance, if ``share`` of words are."""
    n = toxic + clean
    p = toxic / n
    if p <= share:
        return 0.0
    return n * (p * math.log(p / share) + (0.0 if clean == 0 else (1 - p) * math.log((1 - p) / (1 - share))))


def choose_stems(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """The lexicon: stems beyond chance and their log odds; of a stem and its extensions the longest with nine tenths of its places."""
    share = n_toxic / max(n_toxic + n_clean, 1)
    need = math.log(max(len(toxic), 1) / CHANCE)
    good = {}
    for stem, n in toxic.items():
        weight = math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean.get(stem, 0) + 0.5) / (n_clean + 1))
        if weight >= math.log(LEAST_RATIO) and beyond_chance(n, clean.get(stem, 0), share) >= need:
            good[stem] = weight
    children: dict[str, list[str]] = {}
    for stem in good:
        children.setdefault(stem[:-1], []).append(stem)
    kept: dict[str, float] = {}
    for stem in sorted(good, key=lambda s: (len(s), s)):
        beginnings = [stem[:k] for k in range(1, len(stem))]
        if any(b in kept and kept[b] >= good[stem] - math.log(2) for b in beginnings):
            continue
        while further := [c for c in children.get(stem, []) if toxic[c] >= 0.9 * toxic[stem]]:
            stem = max(further, key=lambda c: (toxic[c], c))
        kept[stem] = good[stem]
    return kept


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of largest posterior probability, by Newton's method."""
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (y - p) - (w - PRIOR) / PRIOR_SPREAD**2
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / PRIOR_SPREAD**2
        step = np.linalg.solve(bend, gradient)
        w += step * min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    stems: dict[str, float]
    weights: np.ndarray


def measure(stems: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(stems)
        for batch in batches:
            rows = [features(machine.matches(t.as_py() or "")).tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "features": pa.array(rows, pa.list_(pa.float64()))})

    return run


def train(docs: DataFrame, labels: DataFrame, held_out: str = HELD_OUT, sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` labelled documents. Labels other than 0 and 1 and null ids are left out; of several labels of an id the largest holds."""
    label = with_rows(labels).select(F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["toxic"].cast("int").alias("toxic"))
    label = label.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).filter(~F.expr(held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    label = stage(label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "toxicity-labels")
    texts = with_rows(docs).select(F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("string").alias("text"))
    texts = stage(texts.join(F.broadcast(label), "doc_id").select("text", "toxic"), "toxicity-texts")  # at most ``sample`` ids are sent out

    pairs = texts.filter("toxic = 1").select("text").mapInArrow(contexts, "stem string, context bigint").distinct()
    counted = stage(pairs.groupBy("stem").agg(F.count("*").alias("n")), "toxicity-stems")
    n_toxic = counted.filter(F.col("stem").endswith("$")).agg(F.sum("n")).first()[0] or 0
    toxic = {r["stem"]: r["n"] for r in counted.filter(F.col("n") >= LEAST_CONTEXTS).toLocalIterator()}
    clean = texts.filter("toxic = 0").select("text").mapInArrow(count_clean(set(toxic)), "stem string, n bigint").groupBy("stem").agg(F.sum("n").alias("n"))
    clean = {r["stem"]: r["n"] for r in clean.toLocalIterator()}
    stems = choose_stems(toxic, clean, n_toxic, clean.get("", 0))
    rows = texts.mapInArrow(measure(stems), "toxic int, features array<double>").collect()  # a few numbers per sampled text
    if not rows:
        return Model(stems, PRIOR.copy())
    rows.sort()  # so that sums don't depend on the order of tasks
    return Model(stems, fit(np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows], float)))


def judge(model: Model):
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(model.stems)
        for batch in batches:
            scores, matched = [], []
            for text in batch.column("text"):
                found = machine.matches(text.as_py() or "")
                scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, float(features(found) @ model.weights))))))
                matched.append([{"start": a, "end": b, "kind": KINDS[kind], "weight": w} for a, b, kind, w in found])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(scores, pa.float64()),
                "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32()), "matches": pa.array(matched, spans),
            })

    return run


def score(docs: DataFrame, labels: DataFrame, held_out: str = HELD_OUT, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, matches (start, end, kind, weight; code points, end exclusive).

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; other columns don't matter. ``held_out`` is SQL over doc_id, and false for a null id. A null text is
    an empty one, whose score is that of a text without a match. Repeated rows are scored alike. Without labels the prior weights and an
    empty lexicon hold. An empty table gives an empty result. A match is placed at the token that completes it.
    """
    model = train(docs, labels, held_out, sample)
    rows = with_rows(docs).select(F.col("row")["doc_id"].cast("bigint").alias("doc_id"), F.col("row")["text"].cast("string").alias("text"))
    rows = rows.select("doc_id", F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"), "text")
    schema = "doc_id bigint, held_out boolean, score double, predicted int, matches array<struct<start: bigint, end: bigint, kind: string, weight: double>>"
    return rows.mapInArrow(judge(model), schema)
