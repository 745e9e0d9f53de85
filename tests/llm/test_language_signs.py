"""Texts with control characters."""

from __future__ import annotations

from larder.llm import language_id


def test_null_characters_are_signs_like_others(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the and of\x00it \x00 \x00\x00 that", "en"), ("der die\x00 und das", "de"), ("\x00", "en"), ("the and of it", "en"), ("der die und das", "de")] * 4)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id % 5 == 2} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id % 5 == 0} == {"en"} and {r.lang_pred for r in got if r.doc_id % 5 == 1} == {"de"}
