"""Licence scan: a trained paragraph classifier, confirmed by templates.

Sparse word n-grams of a paragraph go through a multinomial logistic regression over the
licence families and an unknown class. A second fit on held-back rows calibrates how far
a family beats the unknown class. A paragraph counts if a template of the family then
confirms it. Only column expressions and Spark ML are used.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkyield.llm.common import checkpointed

# Usual statements of well-known licences by family.
TEMPLATES = {
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without written permission.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is available under the terms of the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "public-domain": [
        "This work is dedicated to the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
}
FAMILIES = ["unknown", *sorted(TEMPLATES)]

#: words of a piece; longer paragraphs are cut into pieces that overlap
PIECE, STEP = 80, 50
#: paragraphs of the corpus that stand for the unknown class, at most
SAMPLE_ROWS = 20_000
#: variants of each template
VARIANTS = 48
BUCKETS = 1 << 14
#: share of a template's word pairs that confirms it
CONFIRM = 0.6


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def pairs_of(words: Column) -> Column:
    """The different neighbouring words; of a single word that word."""
    n = F.size(words)
    both = F.zip_with(
        F.slice(words, 1, F.greatest(n - 1, F.lit(1))),
        F.slice(words, 2, F.greatest(n - 1, F.lit(1))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(both)


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, body, words)`` of every paragraph with a word, long ones in overlapping pieces.

    A paragraph is the lines between two blank ones, so wrapped statements stay whole.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = docs.select(
        F.col(f"`{id_col}`").alias("doc"),
        F.xxhash64(value).alias("body"),
        F.explode(F.split(value, r"\n\s*\n")).alias("line"),
    )
    # through a generator, so that the words are found once and not again by the filter
    once = F.explode(F.array(words_of(F.col("line"))))
    words = lines.select("doc", "body", once.alias("all")).where(F.size("all") > 0)
    last = F.greatest(F.size("all") - PIECE + STEP - 1, F.lit(0))
    starts = F.sequence(F.lit(1), 1 + last, F.lit(STEP))
    cut = words.select("doc", "body", "all", F.explode(starts).alias("i"))
    return cut.select("doc", "body", F.slice("all", F.col("i"), PIECE).alias("words"))


def vectors(rows: DataFrame) -> DataFrame:
    """Add ``features``, which of the hashed words and word pairs ``words`` has."""
    n = F.greatest(F.size("words") - 1, F.lit(0))
    both = F.zip_with(F.slice("words", 1, n), F.slice("words", 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    terms = rows.withColumn("_terms", F.concat("words", both))
    hashed = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_terms", outputCol="features")
    return hashed.transform(terms).drop("_terms")


def templates(spark: SparkSession) -> DataFrame:
    """``(family, template, own, words, pairs)``; a fixed, small table.

    ``own`` are the pairs that no template of another family has.
    """

    def plain(text: str) -> set[str]:
        words = re.findall("[a-z0-9]+", text.lower())
        return {f"{a} {b}" for a, b in zip(words, words[1:])}

    of = {f: set().union(*map(plain, ts)) for f, ts in TEMPLATES.items()}
    others = {f: set().union(*(p for g, p in of.items() if g != f)) for f in of}
    rows = [(f, t, sorted(plain(t) - others[f])) for f, ts in TEMPLATES.items() for t in ts]
    table = spark.createDataFrame(rows, "family string, template string, own array<string>")
    table = table.withColumn("words", words_of(F.col("template")))
    return table.withColumn("pairs", pairs_of(F.col("words")))


def training_rows(spark: SparkSession, sample: DataFrame, variants: int = VARIANTS) -> DataFrame:
    """``(label, words)``: ``sample (words)`` as unknown, and variants of the templates.

    A variant drops about a twelfth of a template's words and stands between words of
    sampled paragraphs, or alone. Half of those between words have up to 12 on each side,
    half up to as many as fill a piece, split anywhere.
    """
    known = templates(spark)
    seeds = known.select("family", "words", "template", F.explode(F.sequence(F.lit(1), F.lit(variants))).alias("seed"))
    kept = F.filter(
        F.col("words"), lambda w, i: F.pmod(F.xxhash64(w, i, F.col("seed")), F.lit(12)) != 0
    )
    whole = (F.col("seed") % 3 == 0) | (F.size(kept) < 2)
    seeds = seeds.withColumn("core", F.when(whole, F.col("words")).otherwise(kept))
    slot = F.pmod(F.xxhash64("template", "seed"), F.lit(1024))
    around = sample.select(F.pmod(F.xxhash64("words"), F.lit(1024)).alias("slot"), F.col("words").alias("c"))
    # a few contexts for each variant
    around = around.dropDuplicates(["slot"])
    placed = seeds.withColumn("slot", slot).join(around, "slot", "left")
    room = F.greatest(PIECE - F.size("core"), F.lit(0))
    total = F.pmod(F.xxhash64("seed", "template"), room + 1).cast("int")
    first = F.pmod(F.xxhash64("template", "seed", F.lit(1)), total + 1).cast("int")
    few = (F.col("seed") % 13).cast("int")
    sides = [
        F.when(F.col("seed") % 2 == 0, F.lit(0)).when(F.col("seed") % 4 == 1, few).otherwise(many)
        for many in (first, total - first)
    ]
    context = F.coalesce("c", F.array().cast("array<string>"))
    mixed = F.concat(F.slice(context, 1, sides[0]), F.col("core"), F.slice(F.reverse(context), 1, sides[1]))
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    positive = placed.select(label.cast("double").alias("label"), mixed.alias("words"))
    return positive.unionByName(sample.select(F.lit(0.0).alias("label"), "words"))


def resembling(words: Column, share: float = CONFIRM) -> Column:
    """True if a paragraph has that share of the word pairs of any template."""
    pairs = pairs_of(words)
    found = F.lit(False)
    for texts in TEMPLATES.values():
        for text in texts:
            mine = F.lit(text)
            wanted = pairs_of(words_of(mine))
            found = found | (F.size(F.array_intersect(pairs, wanted)) >= F.lit(share) * F.size(wanted))
    return found


class Scanner:
    """The fitted classifier and its calibration."""

    def __init__(self, model: LogisticRegressionModel, slope: float, offset: float):
        self.model, self.slope, self.offset = model, slope, offset

    def score(self, rows: DataFrame) -> DataFrame:
        """Add ``likely``: ``family``, ``confidence`` that it isn't unknown, and whether it
        is the ``best``, of each family whose confidence is at least a half."""
        # through a generator, so that the model runs once for each row and not at every use of p
        once = F.explode(F.array(vector_to_array("probability")))
        out = self.model.transform(vectors(rows)).withColumn("p", once)
        names = F.array(*map(F.lit, FAMILIES[1:]))
        p, tiny = F.col("p"), F.lit(1e-12)
        _, best = _margin(p)
        known = F.slice(p, 2, len(FAMILIES) - 1)

        def certain(share: Column) -> Column:
            margin = F.log(F.greatest(share, tiny)) - F.log(F.greatest(p[0], tiny))
            return 1 / (1 + F.exp(-(F.lit(self.slope) * margin + F.lit(self.offset))))

        def rated(name: Column, i: Column) -> Column:
            return F.struct(name.alias("family"), certain(F.get(p, i + 1)).alias("confidence"), (i + 1 == best).alias("best"))

        likely = F.filter(F.transform(names, rated), lambda x: x["confidence"] >= 0.5)
        # the confidence rises or falls with the share, so one family tells if any reaches a half
        most = certain(F.array_max(known) if self.slope >= 0 else F.array_min(known))
        out = out.withColumn("likely", F.when(most >= 0.5, likely).otherwise(F.array()))
        return out.drop("features", "p", *[c for c in ("rawPrediction", "probability", "prediction")])


def _margin(p: Column) -> tuple[Column, Column]:
    """Log odds of the best family against unknown, and its place from 1."""
    known = F.slice(p, 2, len(FAMILIES) - 1)
    top = F.array_max(known)
    tiny = F.lit(1e-12)
    return F.log(F.greatest(top, tiny)) - F.log(F.greatest(p[0], tiny)), F.array_position(known, top).cast("int")


def fit(spark: SparkSession, pieces: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Scanner:
    """Train on the templates and at most ``sample_rows`` different paragraphs.

    The paragraphs are taken by hash order, without those that resemble a template. A
    fifth of all rows is held back for the calibration.
    """
    words = pieces.select("words").withColumn("o", F.xxhash64("words"))
    # only hashes are shuffled; the words of the few paragraphs up to the last one follow
    last = words.select("o").distinct().orderBy("o").limit(sample_rows).agg(F.max("o")).first()[0]
    sample = words.where(F.col("o") <= F.lit(last).cast("long")).dropDuplicates(["o"]).drop("o")
    sample = checkpointed(sample.where(~resembling(F.col("words"), 0.5)))
    rows = training_rows(spark, sample).withColumn("part", F.pmod(F.xxhash64("words", "label"), F.lit(5)))
    rows = checkpointed(rows)
    ready = vectors(rows)
    learner = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=40, standardization=False)
    model = learner.fit(ready.where("part > 0").select("features", "label"))
    held = model.transform(ready.where("part = 0")).withColumn("p", vector_to_array("probability"))
    margin, _ = _margin(F.col("p"))
    known = (F.col("label") > 0).cast("double")
    scale = held.select(array_to_vector(F.array(margin)).alias("features"), known.alias("label"))
    scale = checkpointed(scale)
    if scale.select("label").distinct().count() < 2:
        return Scanner(model, 1.0, 0.0)
    fitted = LogisticRegression(regParam=1e-4, maxIter=40).fit(scale)
    return Scanner(model, float(fitted.coefficients[0]), float(fitted.intercept))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Licences of every document.

    ``licenses`` are the confirmed families in order, ``n_found`` the confirmed pieces,
    ``n_unconfirmed`` those of which no likely family is confirmed, and ``confidence``
    the best of a confirmed family, 0 without one. A piece can have several families;
    one that is not its likeliest needs a word pair that only its own templates have.
    Whole texts are looked at. Null and empty texts have no licence. Rows repeated with
    id and text get the same result.
    """
    spark = docs.sparkSession
    pieces = paragraphs(docs, id_col, text)
    scanner = fit(spark, pieces, sample_rows)
    likely = checkpointed(scanner.score(pieces).where(F.size("likely") > 0))
    # the templates are a fixed table of a few dozen rows
    known = F.broadcast(templates(spark).select("family", "pairs", "own"))
    numbered = likely.select("doc", "body", "words", F.inline("likely")).withColumn("mine", pairs_of(F.col("words")))
    shared = F.size(F.array_intersect("mine", "pairs")) / F.size("pairs")
    sure = (shared >= CONFIRM) & (F.col("best") | F.arrays_overlap("mine", "own"))
    rated = numbered.join(known, "family").withColumn("sure", sure)
    best = rated.groupBy("doc", "body", "words").agg(
        F.collect_set(F.when(F.col("sure"), F.col("family"))).alias("families"),
        F.max(F.when(F.col("sure"), F.col("confidence"))).alias("confidence"),
    )
    sure = F.size("families") > 0
    found = best.groupBy("doc", "body").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("families")))).alias("licenses"),
        F.count_if(sure).alias("n_found"),
        F.count_if(~sure).alias("n_unconfirmed"),
        F.max("confidence").alias("confidence"),
    )
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    left = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(value).alias("body")).alias("l")
    joined = left.join(found.alias("r"), F.expr("l.body = r.body and l.doc <=> r.doc"), "left")
    return joined.select(
        F.col("l.doc").alias(id_col),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"),
        F.coalesce("n_unconfirmed", F.lit(0)).cast("long").alias("n_unconfirmed"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )
