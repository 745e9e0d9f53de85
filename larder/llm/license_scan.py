"""License scan: a trained paragraph classifier whose predictions are confirmed against templates.

Lines of text are paragraphs, and so is each seam of two lines: the end of a line with what follows it, either as long as the longest
template may be, so that a notice wrapped over several lines is whole in one seam. Comment marks and indents at the edges of a line are dropped first, and
a seam reaches over as many lines as the longest template has words, so any wrapping is found. A seam counts only if no line there is a notice of the
family by itself, and seams in a row are one notice. A sparse multinomial logistic regression over word uni- and bigrams, with an L1 penalty, tells license
families apart and knows one more class, ``unknown``. It is trained on variants of the templates below and on a bounded sample
of the corpus's own lines (``NEGATIVES`` of them, those with the smallest hash) that resemble no template. Its confidence is
calibrated: a temperature is chosen on lines held out of training. A prediction counts if the calibrated probability reaches
``CONFIDENCE`` and a template of the predicted family is found in the line to a share of ``CONTAINMENT`` of its bigrams.

Every line of every document is looked at. A line without any n-gram that speaks for some family rather than for ``unknown`` can't be
predicted as a family, as ``unknown`` has the largest intercept. So a text that holds no word of such an n-gram anywhere is passed over before it is
cut into lines, and of the other texts, which are stored once, a line or seam without one before it is cut into words. Nor can a prediction be
confirmed unless the line has one of the rarest bigrams of a template, all but as many as ``CONTAINMENT`` may leave out; texts, lines and seams that
hold no word of those are passed over too, and only lines that hold such a bigram are rated.

Training and scan are DataFrame operations and built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import bind, stage, with_rows

#: Notices as the licenses or their users word them.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
        "This project is released under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License",
        "This project is licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0",
    ),
    "proprietary": (
        "All rights reserved",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential",
    ),
}
UNKNOWN = "unknown"
NEGATIVES = 8000
#: Characters on each side of a seam: more than the longest template. Lines that a notice can be wrapped to: the words of the longest template.
SEAM = 240
LINES = max(len(text.split()) for texts in TEMPLATES.values() for text in texts)
#: What a line may begin or end with that belongs to no notice.
EDGE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
#: An n-gram that more than this share of the sampled lines has is no feature.
COMMON = 0.01
CONFIDENCE, CONTAINMENT = 0.5, 0.6
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 4.5)


def strings(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"), F.lit(0))


def bigrams(ws: Column) -> Column:
    """Neighbouring words; the word itself if it is the only one."""
    pairs = F.zip_with(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(ws) < 2, ws).otherwise(F.array_distinct(pairs))


def ngrams(ws: Column) -> Column:
    return F.array_distinct(F.concat(ws, bigrams(ws)))


def containment(grams: Column, templates: dict[str, list[list[str]]], family: Column) -> Column:
    """The largest share of a template's bigrams that a line has, over the templates of a family."""
    known = F.create_map(*[x for f, ts in templates.items() for x in (F.lit(f), F.array(*[strings(t) for t in ts]))])
    shares = F.transform(known[family], lambda t: F.size(F.array_intersect(t, grams)) / F.size(t))
    return F.coalesce(F.array_max(shares), F.lit(0.0))


@dataclass
class Model:
    families: list[str]  # the last one is ``unknown``
    weights: dict[str, list[float]]  # by n-gram, those that tell families apart
    intercepts: list[float]
    temperature: float
    templates: dict[str, list[list[str]]]
    in_text: dict[str, int]  # by word, in how many sampled lines it stands

    def gate(self) -> list[str]:
        """Of each n-gram that speaks for some family rather than for ``unknown`` the word that is rarest in ordinary lines."""
        speaking = [g.split(" ") for g, w in self.weights.items() if max(w[:-1]) > w[-1]]
        return sorted({min(ws, key=lambda w: (self.in_text.get(w, 0), w)) for ws in speaking})

    def marks(self) -> list[str]:
        """Of each template its rarest bigrams, so many that no line has the share ``CONTAINMENT`` of the template without one of them."""
        found = set()
        for grams in (set(t) for ts in self.templates.values() for t in ts):
            needed = next((n for n in range(1, len(grams) + 1) if n / len(grams) >= CONTAINMENT), 0)
            found.update(sorted(grams, key=lambda g: (self.rarity(self.rarest(g)), g))[: len(grams) - needed + 1])
        return sorted(found)

    def rarity(self, word: str) -> tuple[int, int, str]:
        return self.in_text.get(word, 0), -len(word), word

    def rarest(self, gram: str) -> str:
        return min(gram.split(" "), key=self.rarity)

    def logits(self, grams: Column) -> Column:
        table = F.create_map(*[x for g, w in self.weights.items() for x in (F.lit(g), F.array(*[F.lit(v) for v in w]))])
        start = F.array(*[F.lit(x) for x in self.intercepts])
        found = F.filter(F.transform(F.array_intersect(grams, strings(self.weights)), lambda g: table[g]), lambda w: w.isNotNull())
        return F.aggregate(found, start, lambda total, w: F.zip_with(total, w, lambda x, y: x + y))

    def probabilities(self, logits: Column) -> Column:
        def shares(powers: Column) -> Column:
            total = F.aggregate(powers, F.lit(0.0), lambda s, p: s + p)
            return bind(total, lambda t: F.transform(powers, lambda p: p / t))

        def powers(z: Column) -> Column:
            largest = F.array_max(z)
            return bind(largest, lambda top: F.transform(z, lambda x: F.exp((x - top) / self.temperature)))

        return bind(logits, lambda z: bind(powers(z), shares))


def lines_of(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def speaks(text: Column, gate: list[str]) -> Column:
    """Whether one of the words stands in a text, also as part of another: a cheap look before the text is cut into words."""
    return bind(F.lower(text), lambda t: F.exists(strings(gate), lambda g: F.contains(t, g)))


def seams_of(rows: DataFrame, gate: list[str]) -> DataFrame:
    """The end of each line with the start of what follows; none for the last line, and none where no word of ``gate`` is near."""
    lines = rows.select("doc_id", F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, EDGE, "")).alias("lines"))
    lines = lines.withColumn("hits", F.transform("lines", lambda x: speaks(x, gate)))

    def seam(line: Column, i: Column) -> Column:
        after = F.array_join(F.transform(F.slice("lines", i + 2, LINES - 1), lambda x: F.left(x, F.lit(SEAM))), " ")
        joined = F.concat_ws(" ", F.right(line, F.lit(SEAM)), F.left(after, F.lit(SEAM)))
        return F.when(F.exists(F.slice("hits", i + 1, LINES), lambda hit: hit), joined)

    seams = F.transform(F.slice("lines", 1, F.greatest(F.size("lines") - 1, F.lit(0))), seam)
    return lines.select("doc_id", F.posexplode(seams).alias("line_no", "line")).filter("line is not null")


def train(rows: DataFrame) -> Model:
    """The model for a corpus (doc_id, text)."""
    spark: SparkSession = rows.sparkSession
    wording = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    notices = spark.createDataFrame(wording, "family string, line string").select("family", tokens(F.col("line")).alias("ws"))
    templates: dict[str, list[list[str]]] = {}
    for row in notices.select("family", bigrams(F.col("ws")).alias("grams")).collect():
        templates.setdefault(row.family, []).append(row.grams)
    lettered = lines_of(rows).filter(F.col("line").rlike(r"\p{L}")).select("line", F.xxhash64("line").alias("hash"))
    chosen = stage(lettered.select("hash").distinct().orderBy("hash").limit(NEGATIVES), "license-sample")  # copies of a line are one
    sample = lettered.join(chosen, "hash", "left_semi").select("line").distinct()
    sample = stage(sample.select(F.lit(UNKNOWN).alias("family"), tokens(F.col("line")).alias("ws")), "license-negatives")
    alike = [containment(bigrams(F.col("ws")), templates, F.lit(f)) for f in TEMPLATES]
    negatives = sample.filter((F.greatest(*alike) < CONTAINMENT / 2) & (F.size("ws") > 0))
    cut = lambda a, b: F.slice("ws", F.greatest(F.lit(1), F.floor(F.size("ws") * a).cast("int") + 1), F.greatest(F.lit(2), F.ceil(F.size("ws") * (b - a)).cast("int")))
    variants = F.explode(F.array(F.col("ws"), cut(0.0, 0.7), cut(0.3, 1.0), cut(0.15, 0.85), F.concat(F.array(F.lit("the"), F.lit("project")), F.col("ws"))))
    positives = notices.select("family", variants.alias("ws")).withColumn("h", F.lit(0))
    rated = negatives.select("family", "ws", F.pmod(F.xxhash64("ws"), F.lit(4)).alias("h")).unionByName(positives)
    rated = stage(rated.withColumn("grams", ngrams(F.col("ws"))).coalesce(1), "license-training")

    n = max(1, rated.filter(F.col("family") == UNKNOWN).count())
    seen = rated.select("family", F.explode("grams").alias("gram")).groupBy("gram")
    seen = seen.agg(F.count_if(F.col("family") == UNKNOWN).alias("in_text"), F.count_if(F.col("family") != UNKNOWN).alias("in_notices"))
    seen = seen.filter("in_notices > 0").orderBy("gram").collect()  # the n-grams of the templates
    vocabulary = [r.gram for r in seen if r.in_text <= COMMON * n]
    families = [*sorted(TEMPLATES), UNKNOWN]
    number = F.create_map(*[F.lit(x) for i, f in enumerate(families) for x in (f, float(i))])
    weight = F.when(F.col("family") == UNKNOWN, 1.0).otherwise(4.0)
    rated = rated.withColumn("label", number[F.col("family")]).withColumn("weight", weight)
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)
    counted = vectors.transform(rated)
    fitted = LogisticRegression(weightCol="weight", family="multinomial", regParam=0.0005, elasticNetParam=0.5, maxIter=30, standardization=False)
    fitted = fitted.fit(counted.filter("h <> 1"))
    matrix, intercepts = fitted.coefficientMatrix.toArray().T.tolist(), fitted.interceptVector.toArray().tolist()
    missing = len(families) - len(intercepts)  # without any negative line there is no last class
    intercepts += [max(intercepts) + 1.0] * missing
    weights = {g: [*w, *[0.0] * missing] for g, w in zip(vocabulary, matrix, strict=True) if any(w)}
    intercepts[-1] = max(intercepts)  # an empty line is unknown
    model = Model(families, weights, intercepts, 1.0, templates, {r.gram: r.in_text for r in seen})

    held = rated.filter((F.col("h") == 1) | (F.col("family") != UNKNOWN)).select("label", "weight", model.logits(F.col("grams")).alias("z"))
    losses = []
    for t in TEMPERATURES:
        p = F.get(replace(model, temperature=t).probabilities(F.col("z")), F.col("label").cast("int"))
        losses.append(F.sum(-F.col("weight") * F.log(F.greatest(p, F.lit(1e-12)))))
    loss = held.agg(*losses).first()
    model.temperature = min(zip(loss, TEMPERATURES, strict=True), key=lambda x: x[0])[1]
    return model


def find_notices(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, line_no, family, confidence, containment) of the notices: lines, and the first of the lines that one is wrapped to."""
    gate = sorted({model.rarest(g) for g in model.marks()})
    spoken = stage(rows.filter(speaks(F.col("text"), gate)), "license-texts")
    single = stage(rate(lines_of(spoken).filter(speaks(F.col("line"), gate)), model), "license-lines")
    seams = stage(rate(seams_of(spoken, gate), model), "license-seams")

    def without(found: DataFrame, taken: DataFrame) -> DataFrame:
        taken = taken.select(F.col("doc_id").alias("of"), F.col("line_no").alias("at"), F.col("family").alias("as")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("line_no") == F.col("at")) & (F.col("family") == F.col("as"))
        return found.join(taken, same, "left_anti")

    near = F.explode(F.sequence(F.col("line_no") - LINES + 1, F.col("line_no")))
    seams = without(seams, single.withColumn("line_no", near))
    return single.unionByName(without(seams, seams.withColumn("line_no", F.col("line_no") + 1)))


def rate(lines: DataFrame, model: Model) -> DataFrame:
    """Those of (doc_id, line_no, line) that are notices."""
    gate = strings(model.gate())
    lines = lines.withColumn("ws", tokens(F.col("line"))).filter(F.arrays_overlap("ws", gate))
    lines = lines.withColumn("pairs", bigrams(F.col("ws"))).filter(F.arrays_overlap("pairs", strings(model.marks())))
    rated = lines.select("doc_id", "line_no", ngrams(F.col("ws")).alias("grams"), "pairs")
    rated = rated.withColumn("p", model.probabilities(model.logits(F.col("grams"))))
    best = F.array_max("p")
    names = F.array(*[F.lit(f) for f in model.families])
    rated = rated.withColumn("confidence", best).withColumn("family", F.element_at(names, F.array_position("p", best).cast("int")))
    rated = rated.filter((F.col("family") != UNKNOWN) & (F.col("confidence") >= CONFIDENCE))
    rated = rated.withColumn("containment", containment(F.col("pairs"), model.templates, F.col("family")))
    return rated.filter(F.col("containment") >= CONTAINMENT).select("doc_id", "line_no", "family", "confidence", "containment")


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_notices, license (of the most confident notice, else ``unknown``), licenses
    (all families, sorted), confidence (0 without a notice).

    ``docs`` has doc_id and text; other columns don't matter. A null or empty text has no notice. Rows of one doc_id share their
    notices; the same line of repeated rows counts once. A null doc_id is a document like any other. An empty table gives an empty result.
    """
    rows = with_rows(docs).select(F.col("row")["doc_id"].alias("doc_id"), F.col("row")["text"].alias("text"))
    if model is None:
        model = train(rows)
    notices = stage(find_notices(rows, model), "license-notices")
    notices = notices.groupBy("doc_id", "line_no", "family").agg(F.max("confidence").alias("confidence"))
    best = F.max(F.struct("confidence", "family"))
    by_doc = notices.groupBy(F.col("doc_id").alias("of")).agg(
        F.count("*").alias("n"), best.alias("best"), F.sort_array(F.collect_set("family")).alias("licenses")
    )
    by_doc = stage(by_doc, "licensed-documents")
    out = rows.select("doc_id").join(by_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return out.select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("n_notices"), F.coalesce("best.family", F.lit(UNKNOWN)).alias("license"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"), F.coalesce("best.confidence", F.lit(0.0)).alias("confidence"),
    )
