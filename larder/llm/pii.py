"""Personal data: identifiers by pattern, and the terms around them that give them away.

Patterns find the protected entities: e-mail addresses, IP addresses, card and phone numbers. A term near an entity can disclose
it even where the entity itself is gone. How much, the corpus tells: with ``p`` the share of documents, the information an entity
``e`` carries is ``IC(e) = -log2 p(e)``, and a term ``t`` gives away ``PMI(e, t) = log2 p(e, t) / (p(e) p(t))`` of it. Terms with
``PMI / IC`` from ``GENERALISE`` on are replaced by a placeholder, from ``REMOVE`` on they are removed.

A document is a row, and a term and an entity are together where one document holds both. A pair counts as evidence only if ``TEXTS``
different texts hold it: copies of one text are one, so their rare words are left alone. A disclosing term goes wherever it stands
in the documents that hold its entity. What is found depends on a text and the corpus alone, so rows are told apart by a digest of their
text, not by doc_id, which can be null or repeated. A term is a run of letters, of any length; a word may hold several.

Document frequencies of the candidate terms are counted over all documents. A bitmap of fixed size, in which each candidate sets
two bits, lets the tasks pass over the words that can't be candidates; further terms on the same bits are counted in vain, no more.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larder.llm.common import stage, tidy, with_rows

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGITS = {c: None for c in range(128) if not chr(c).isdigit()}

#: So many different texts must hold both an entity and a term.
TEXTS = 2
GENERALISE, REMOVE = 0.8, 0.95
BITS = 1 << 22
#: Terms with places that a task holds before it passes them on, and words it remembers the terms of.
NOTED, REMEMBERED = 50_000, 100_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CORE = re.compile(r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain: one look at each @, back over the local part, on over the domain."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = last + len(text[last:at].rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    numbers = [int(d) for d in digits[::-1]]
    return (sum(numbers[0::2]) + sum(n // 5 + 2 * n % 10 for n in numbers[1::2])) % 10 == 0


def identifiers(text: str) -> list[list[tuple[int, int]]]:
    """Per kind the (start, end) of its matches that hold, in code points."""
    found = [emails(text) if "@" in text else [], [], [], []]
    if DIGIT.search(text):
        found[1] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(digits := m[0].translate(NOT_DIGITS)) <= 19 and luhn(digits):
                found[2].append(m.span())
        if "+" in text:
            found[3] = [m.span() for m in PHONE.finditer(text) if 8 <= len(m[0].translate(NOT_DIGITS)) <= 15]
    return found


def number(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value.encode()) >> 1


def bits_of(term: str) -> tuple[int, int]:
    """The two bits of a term, one in each half of the bitmap."""
    n = number(term)
    return n % BITS, BITS + (n >> 31) % BITS


def entities(text: str, found: list[list[tuple[int, int]]]) -> list[int]:
    """The different protected entities of a text, as numbers."""
    values = set()
    for kind, spans in zip(KINDS, found, strict=True):
        for a, b in spans:
            value = text[a:b].lower() if kind == "email" else text[a:b] if kind == "ip" else text[a:b].translate(NOT_DIGITS)
            values.add(number(f"{kind}:{value}"))
    return sorted(values)


def terms_of(text: str, found: list[list[tuple[int, int]]]) -> Iterator[tuple[str, int, int]]:
    """The terms of a text with their places; what lies in an entity is no term."""
    taken = sorted(span for spans in found for span in spans)
    starts = [a for a, _ in taken]
    latest = list(accumulate((b for _, b in taken), max))
    for m in CORE.finditer(text):
        x, y = m.span()
        i = bisect_left(starts, y) - 1
        if i < 0 or latest[i] <= x:
            yield m[0].lower(), x, y


PLACES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
TERM_TYPE = pa.list_(pa.struct([("term", pa.string()), ("bits", pa.list_(pa.int64())), ("places", PLACES)]))
FOUND_SCHEMA = (
    "doc_id bigint, digest binary, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, base_sha256 string, "
    "entities array<bigint>, words array<struct<term string, bits array<bigint>, places array<struct<start bigint, end bigint>>>>"
)


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The finds of each text, passed on after every ``NOTED`` terms."""
    names = ["doc_id", "digest", *[f"n_{kind}" for kind in KINDS], "base", "base_sha256", "entities", "words"]
    kinds = [pa.int64(), pa.binary(), *[pa.int64()] * len(KINDS), pa.string(), pa.string(), pa.list_(pa.int64()), TERM_TYPE]
    columns: list[list] = [[] for _ in names]
    noted = 0

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)
        for column in columns:
            column.clear()
        return out

    for batch in batches:
        for doc_id, digest, text in zip(batch.column("doc_id"), batch.column("digest"), batch.column("text"), strict=True):
            text = text.as_py() or ""
            found = identifiers(text)
            listed = ",".join(f"{kind}:{a}:{b}" for kind, spans in zip(KINDS, found, strict=True) for a, b in spans)
            own: dict[str, list] = {}
            for term, x, y in terms_of(text, found) if listed else ():
                own.setdefault(term, []).append({"start": x, "end": y})
                noted += 1
            words = [{"term": t, "bits": [1 + b for b in bits_of(t)], "places": own[t]} for t in sorted(own)]
            row = [doc_id.as_py(), digest.as_py(), *map(len, found), listed, hashlib.sha256(listed.encode()).hexdigest(), entities(text, found), words]
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            if noted >= NOTED:
                yield flush()
                noted = 0
    if columns[0]:
        yield flush()


def frequencies(bitmap: bytes):
    """(term, n): in how many documents of a task each term stands whose bit is set. Counts are passed on early beyond ``REMEMBERED`` terms."""
    wanted = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: dict[str, tuple[str, ...]] = {}
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                own: set[str] = set()
                for word in set(WORD.findall(text.as_py() or "")):
                    if word not in terms:
                        lowered = [t.lower() for t in CORE.findall(word)]
                        terms[word] = tuple(t for t in lowered if all(wanted[b] for b in bits_of(t)))
                    own.update(terms[word])
                counts.update(own)
                if len(terms) > REMEMBERED:
                    terms.clear()
            if len(counts) > REMEMBERED:
                yield flush()
        if counts:
            yield flush()

    return run


def disclosing(rows: DataFrame, found: DataFrame) -> DataFrame | None:
    """(digest, terms): for the texts that hold them the places (start, end, remove) of the terms that give away at least ``GENERALISE``
    of one of their entities; None if no entity stands in ``TEXTS`` different texts. No text is moved: the places of all terms of a
    text with an entity were noted when it was read."""
    texts = found.select("digest", F.explode("entities").alias("entity")).groupBy("digest", "entity").agg(F.count("*").alias("copies"))
    known = texts.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("texts")).filter(F.col("texts") >= TEXTS)
    held = stage(texts.join(known.drop("texts"), "entity"), "entities")
    own = found.select("digest", "words").join(held.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])
    words = stage(own.select("digest", F.explode("words").alias("w")).select("digest", "w.*"), "candidate-terms")
    total = float(found.count())

    # A pair can't be together more often than either is alone, so log2(total / n_term) must reach the share that is asked for of the entity's
    # information, which bounds n_term per entity. Texts with an entity alone tell that most words are beyond it. What is left, and stands
    # with the entity in enough texts, is counted over all documents.
    bound = F.lit(total) / F.pow(F.lit(total) / F.col("n_entity"), F.lit(GENERALISE)) * (1 + 1e-9)
    held = held.withColumn("bound", bound)
    own = held.groupBy("digest").agg(F.max("bound").alias("most"), F.max("copies").alias("own"))
    least = words.select("digest", "term").join(own, "digest").groupBy("term").agg(F.sum("own").alias("least"), F.count("*").alias("texts"))
    least = least.filter(F.col("texts") >= TEXTS).drop("texts")
    rare = words.select("digest", "term").join(least, "term").join(own.drop("own"), "digest").filter("least <= most")
    together = held.select("digest", "entity", "bound").join(rare, "digest").filter("least <= bound").groupBy("entity", "term").agg(F.count("*").alias("texts"))
    together = stage(together.filter(F.col("texts") >= TEXTS).select("entity", "term"), "entity-terms")
    wanted = words.join(together.select("term").distinct(), "term")
    wanted = stage(wanted, "wanted-terms")
    parts = wanted.select(F.explode("bits").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    if not parts:
        return None
    bitmap = bytearray(BITS // 4 + 4096)  # numbers and buckets count from 1; a bucket holds 4096 bytes
    for part in parts:
        at = max(part.part - 1, 0) * 4096
        bitmap[at : at + 4096] = bytes(x | y for x, y in zip(bitmap[at : at + 4096], part.bits, strict=True))
    terms = rows.select("text").mapInArrow(tidy(frequencies(bytes(bitmap))), "term string, n bigint")
    terms = stage(terms.groupBy("term").agg(F.sum("n").alias("n_term")), "term-frequencies")

    information = F.log2(F.lit(total) / F.col("n_entity"))

    def share(n_both: Column) -> Column:
        return F.when(information > 0, F.log2(n_both * F.lit(total) / (F.col("n_entity") * F.col("n_term"))) / information)

    pairs = wanted.select("digest", "term").join(together, "term").join(held.drop("bound"), ["digest", "entity"]).join(terms, "term")
    pairs = stage(pairs, "entity-term-texts")
    both = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(F.sum("copies").alias("n_both"), F.count("*").alias("texts"))
    both = both.filter(F.col("texts") >= TEXTS).select("entity", "term", share(F.col("n_both")).alias("share")).filter(F.col("share") >= GENERALISE)
    marks = pairs.select("digest", "entity", "term").join(both, ["entity", "term"]).groupBy("digest", "term").agg(F.max("share").alias("share"))
    placed = words.select("digest", "term", "places").join(stage(marks, "disclosing-terms"), ["digest", "term"])
    place = F.col("place")
    one = F.struct(place["start"].alias("start"), place["end"].alias("end"), (F.col("share") >= REMOVE).alias("remove"))
    each = placed.select("digest", "share", F.explode("places").alias("place")).select("digest", one.alias("one"))
    return each.groupBy("digest").agg(F.sort_array(F.collect_list("one")).alias("terms"))  # at most the words of one text


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def find_all(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The identifiers of every row, and (digest, terms) with the places of disclosing terms, one row per text that has some."""
    text = F.col("row")["text"]
    rows = with_rows(docs).select(F.col("row")["doc_id"].cast("bigint").alias("doc_id"), text.alias("text"), digest_of(text).alias("digest"))
    found = stage(rows.mapInArrow(tidy(find), FOUND_SCHEMA), "identifiers")
    places = disclosing(rows, found)
    return found, None if places is None else stage(places, "term-places")


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, terms.

    ``docs`` has doc_id and text; other columns don't matter. ``spans`` lists kind:start:end of all finds, identifiers by kind,
    then terms (kind ``term``) by start; places are code points, ends exclusive. ``terms`` holds (start, end, remove) of the terms.
    A null or empty text has no finds. An empty table gives an empty result.
    """
    found, places = find_all(docs)
    none = F.array().cast("array<struct<start:bigint,end:bigint,remove:boolean>>")
    marked = found.withColumn("terms", none) if places is None else found.join(places, "digest", "left").withColumn("terms", F.coalesce("terms", none))
    listed = F.transform("terms", lambda t: F.format_string("term:%d:%d", t["start"], t["end"]))
    spans = F.array_join(F.filter(F.concat(F.array("base"), listed), lambda s: s != ""), ",")
    return marked.select("doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", spans.alias("spans"), "terms")


def cleaned(text: str | None, terms: list | None) -> str | None:
    """Each find of a text replaced by its kind in brackets; a term to remove by nothing. Overlapping finds are one, named by the first."""
    if text is None:
        return text
    finds = [(a, b, f"[{kind.upper()}]") for kind, spans in zip(KINDS, identifiers(text), strict=True) for a, b in spans]
    finds += [(t["start"], t["end"], "" if t["remove"] else "[TERM]") for t in (terms or ())]
    out, last = [], 0
    for a, b, new in sorted(finds, key=lambda f: (f[0], -f[1])):
        if a >= last:
            out += [text[last:a], new]
        last = max(last, b)
    return "".join([*out, text[last:]])


@F.arrow_udf(StringType())
def redacted(text: pa.Array, terms: pa.Array) -> pa.Array:
    """The cleaned texts, a few hundred of which are Python strings at a time."""
    parts = [pa.array([], pa.string())]
    for at in range(0, len(text), 256):
        parts.append(pa.array([cleaned(t.as_py(), m.as_py()) for t, m in zip(text[at : at + 256], terms[at : at + 256], strict=True)], pa.string()))
    return pa.concat_arrays(parts)


def sanitize(docs: DataFrame) -> DataFrame:
    """``docs`` with the finds in ``text`` replaced or removed; rows and columns stay as they are.

    Identifiers are found in each row's own text; only the places of terms are joined, by the digest of the text.
    """
    _, places = find_all(docs)
    rows = with_rows(docs)
    if places is None:
        joined = rows.withColumn("terms", F.lit(None).cast("array<struct<start:bigint,end:bigint,remove:boolean>>"))
    else:
        joined = rows.withColumn("digest", digest_of(F.col("row")["text"])).join(places, "digest", "left")
    return joined.select(F.col("row").withField("text", redacted(F.col("row")["text"], "terms")).alias("row")).select("row.*")
