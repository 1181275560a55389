import math
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkyield.llm import licenses


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(1, 8))) for _ in range(n))


def corpus():
    """Documents and the families planted in them."""
    rng = random.Random(1)
    rows, want = [], {}
    texts = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts]
    for i in range(150):
        lines = [prose(rng, rng.randint(1, 60)) for _ in range(rng.randint(1, 4))]
        families = set()
        if i % 2:
            family, text = texts[i // 2 % len(texts)]
            families.add(family)
            if i % 3 == 0:
                text = prose(rng, 4) + " " + text.upper() + " " + prose(rng, 4)
            lines.insert(rng.randrange(len(lines) + 1), text)
        rows.append((i, "\n".join(lines)))
        want[i] = families
    long = prose(rng, 3000) + " Licensed under the Apache License, Version 2.0. " + prose(rng, 3000)
    rows += [(200, None), (201, ""), (202, " \n"), (203, long), (204, "free software for the public"), (None, "Released under the MIT License.")]
    rows += [(205, "Released under the MIT License."), (205, "Released under the MIT License.")]
    want |= {200: set(), 201: set(), 202: set(), 203: {"apache"}, 204: set(), None: {"mit"}, 205: {"mit"}}
    return rows, want


def test_planted_statements_are_found(make):
    rows, want = corpus()
    docs = make(rows).withColumn("words", F.lit("clash")).withColumn("label", F.lit(1))
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["confidence"] <= 1 and (r["confidence"] > 0) == (r["n_found"] > 0) for r in got)
    assert all(set(r["licenses"]) <= set(licenses.FAMILIES[1:]) for r in got)
    # templates of near relatives (CC BY and CC BY-SA) may both be confirmed
    missed = [r for r in got if not want[r["doc_id"]] <= set(r["licenses"])]
    wrong = [r for r in got if not want[r["doc_id"]] and r["licenses"]]
    assert len(missed) <= 0.05 * len(rows) and not wrong
    assert {r["doc_id"] for r in missed}.isdisjoint({203, 205, None})


def test_pieces_cover_every_paragraph(make):
    words = [f"w{i}" for i in range(333)]
    docs = make([(1, " ".join(words)), (2, "a b\n\nc"), (3, None)])
    got = licenses.paragraphs(docs).collect()
    mine = [r["words"] for r in got if r["doc"] == 1]
    assert all(len(m) <= licenses.PIECE for m in mine)
    assert {(a, b) for m in mine for a, b in zip(m, m[1:])} == set(zip(words, words[1:]))
    assert sorted(r["words"] for r in got if r["doc"] == 2) == [["a", "b"], ["c"]]
    # a statement of up to PIECE - STEP words stands in one piece as a whole
    size = licenses.PIECE - licenses.STEP
    whole = {tuple(m[i : i + size]) for m in mine for i in range(len(m) - size + 1)}
    assert all(tuple(words[i : i + size]) in whole for i in range(333 - size + 1))


def test_wrapped_dual_and_embedded_statements(make):
    rng = random.Random(7)
    rows, want = [(i, prose(rng, rng.randint(1, 60))) for i in range(150)], {}
    texts = [
        ("bsd", "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met"),
        ("gpl", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation"),
        ("mit apache", "SPDX-License-Identifier: MIT OR Apache-2.0"),
        ("mit apache", "Licensed under the MIT License or\nthe Apache License, Version 2.0."),
        ("apache", "SPDX-License-Identifier: Apache-2.0"),
        ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ]
    texts += [(f, f"{prose(rng, 24)} {max(ts, key=len)} {prose(rng, 24)}") for f, ts in licenses.TEMPLATES.items()]
    for i, (families, text) in enumerate(texts):
        rows.append((1000 + i, prose(rng, 20) + "\n\n" + text + "\n\n" + prose(rng, 20)))
        want[1000 + i] = set(families.split())
    got = {r["doc_id"]: set(r["licenses"]) for r in licenses.scan(make(rows)).collect()}
    assert {i: got[i] for i in want} == want
    assert not any(got[i] for i in range(150))


def test_the_sample_counts_different_paragraphs(spark, make, monkeypatch):
    """Repeated lines do not use up the sample."""
    kept = []
    monkeypatch.setattr(licenses, "training_rows", lambda _, sample: kept.append(sample) or sample.missing)
    rows = [(i, "the same line of words" if i % 4 else f"line number {i}") for i in range(200)]
    with pytest.raises(AttributeError):
        licenses.fit(spark, licenses.paragraphs(make(rows)), 40)
    assert kept[0].distinct().count() == kept[0].count() == 40


@pytest.mark.parametrize("text,pairs", [("One", ["one"]), ("a b a b", ["a b", "b a"])])
def test_word_pairs(spark, text, pairs):
    row = spark.createDataFrame([(text,)], "t string")
    assert row.select(licenses.pairs_of(licenses.words_of(F.col("t")))).first()[0] == pairs


def test_no_documents(make):
    assert licenses.scan(make([(1, "a")]).where("doc_id < 0")).collect() == []


def test_words_of_a_paragraph_are_found_once(make):
    """The filter on paragraphs without a word does not repeat the search for words."""
    plan = licenses.paragraphs(make([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") == 1
    rows = [(1, "--One, 2two\t(three)!"), (2, "İx Été"), (3, "-\n\n?"), (4, "\nz")]
    got = {r["doc"]: r["words"] for r in licenses.paragraphs(make(rows)).collect()}
    assert got == {1: ["one", "2two", "three"], 2: ["i", "x", "t"], 4: ["z"]}


@pytest.mark.parametrize("slope", [1.5, -0.5])
def test_a_family_is_likely_from_a_half(spark, make, slope):
    """Scored by the best share (the least one if confidence falls with it)."""
    shares = [[0.9] + [0.01] * 10, [0.05] * 10 + [0.5], [0.0] + [0.1] * 10]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(shares)], "i int, p array<double>")

    class Model:
        def transform(self, rows):
            return rows.withColumn("probability", array_to_vector("p")).drop("p")

    rows = rows.withColumn("words", F.array(F.lit("a")))
    got = {r["i"]: {x["family"] for x in r["likely"]} for r in licenses.Scanner(Model(), slope, 0.2).score(rows).collect()}
    for i, p in enumerate(shares):
        margins = [math.log(max(x, 1e-12)) - math.log(max(p[0], 1e-12)) for x in p[1:]]
        want = {f for f, m in zip(licenses.FAMILIES[1:], margins) if 1 / (1 + math.exp(-(slope * m + 0.2))) >= 0.5}
        assert got[i] == want
