"""Notices as files hold them, wrapped over several lines, and a sample that copies do not use up."""

from __future__ import annotations

from larder.llm import license_scan

WRAPPED = [
    (201, "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation", "gpl"),
    (202, "Some words before.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n\nand after", "bsd"),
]


def test_wrapped_notices(spark, cases):
    docs = cases.select("doc_id", "text").union(spark.createDataFrame([w[:2] for w in WRAPPED], "doc_id long, text string"))
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert {i: (got[i].license, got[i].n_notices) for i, _, _ in WRAPPED} == {i: (family, 1) for i, _, family in WRAPPED}


def test_copied_lines_are_sampled_once(spark, monkeypatch):
    """With room for all distinct lines each is sampled, however often one of them stands."""
    monkeypatch.setattr(license_scan, "NEGATIVES", 40)
    staged = {}

    def stage(df, label, _stage=license_scan.stage):
        staged[label] = _stage(df, label)
        return staged[label]

    monkeypatch.setattr(license_scan, "stage", stage)
    lines = [f"ordinary line about matter {chr(97 + i)}" for i in range(26)]
    license_scan.train(spark.createDataFrame([(i, x) for i, x in enumerate(lines + lines[:13] * 30)], "doc_id long, text string"))
    assert staged["license-negatives"].count() == 26


def test_any_wrapping_is_found(spark, cases):
    """One word a line, with comment marks, up to the whole notice on one line, between ordinary lines."""
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    words, docs = notice.split(), []
    for per in (1, 2, 3, 5, 8, 13, 40):
        for k, mark in enumerate(("", " *    ", "// ", "#")):
            lines = [mark + " ".join(words[i : i + per]) for i in range(0, len(words), per)]
            docs.append((300 + 10 * per + k, "\n".join(["ordinary words in a first line", *lines, "and other words at the end"])))
    frame = cases.select("doc_id", "text").union(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r.doc_id: r for r in license_scan.scan(frame).collect()}
    assert {i: (got[i].license, got[i].n_notices) for i, _ in docs} == {i: ("mit", 1) for i, _ in docs}


def test_texts_without_a_gate_word_are_passed_over(spark):
    model = license_scan.train(spark.createDataFrame([(1, "ordinary words in a line")], "doc_id long, text string"))
    gate = model.gate()
    notices = [text for texts in license_scan.TEMPLATES.values() for text in texts]
    frame = spark.createDataFrame([(n,) for n in notices], "text string")
    assert frame.filter(license_scan.speaks(frame["text"], gate)).count() == len(notices)


def test_texts_without_a_mark_of_a_template_are_passed_over(spark, monkeypatch):
    """No line without a mark can be confirmed, and words of the templates alone bring no text to the scan."""
    staged = {}

    def stage(df, label, _stage=license_scan.stage):
        staged[label] = _stage(df, label)
        return staged[label]

    monkeypatch.setattr(license_scan, "stage", stage)
    docs = [(1, "You may use this file or copy it, and it can work for all of you."), (2, "Any program has a code that is not free."), (3, "one line\nAll rights reserved")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = license_scan.train(docs)
    marks = set(model.marks())
    for grams in (set(t) for ts in model.templates.values() for t in ts):
        assert len(grams - marks) / len(grams) < license_scan.CONTAINMENT
    got = {r.doc_id: r.license for r in license_scan.scan(docs, model).collect()}
    assert got == {1: "unknown", 2: "unknown", 3: "proprietary"}
    assert [r.doc_id for r in staged["license-texts"].select("doc_id").collect()] == [3]
