"""Documents that every operator must take: nulls, empty and long texts, repeated rows, clashing column names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, ws string, kept string, votes string, bucket string, `of` string, marks string, id string, `a.b` string"


def texts() -> list[tuple]:
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["th", "an", "er", "in", "ou", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(120), prose(40)
    edited = base.split()
    edited[10] = "edited"
    rows = [
        (1, base, "en", "s1"), (2, base, "en", "s1"), (2, base, "en", "s1"), (3, " ".join(edited), "en", "s2"),
        (4, None, "en", "s1"), (5, "", "de", None), (6, " \t\n\x0b ", None, "s2"), (7, "one two", "de", "s3"), (8, "one two", "de", "s3"),
        (9, prose(30) + "\n" + passage + "\n" + prose(30), "en", "s1"), (10, passage, "en", "s1"),
        (11, prose(60) + " " + passage.replace(" ", "  "), "de", "s2"), (12, prose(9000), "en", "s1"), (13, "same " * 80, "en", "s2"),
        (14, "ERR!! " * 70, "en", "s3"), (15, "der die*** und$$$ " * 30 + prose(20), "de", "s3"), (None, base + " tail", "en", None),
        (16, "É̀tait À l’été ÿ 中文字 <|endoftext|> 12ab  x", "fr", "s2"), (17, "a" * 3000, "en", "s2"), (18, "line one\n" * 40 + prose(60), "en", "s1"),
    ]
    return [(i, t, lang, s, len(t or ""), *["clash"] * 9) for i, t, lang, s in rows]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
