import random

import pytest
from pyspark.sql import functions as F

from sparkyield.llm import decontaminate as dc


def distance(item, text):
    """Smallest edit distance of the item to a substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def masks(p):
    return {c: sum(1 << i for i, x in enumerate(p) if x == c) for c in p}


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert dc.nearest(p, masks(p), t) == distance(p, t)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyz")
        elif kind == 1:
            chars.insert(at, rng.choice("xyz"))
        else:
            del chars[at]
    return "".join(chars)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))
    items = [(i, prose(rng.randint(2, 25))) for i in range(12)]
    items += [(12, None), (13, " \n"), (14, "Short"), (3, items[3][1]), (None, prose(9))]
    docs = []
    for i in range(40):
        text = prose(rng.randint(0, 40))
        if i % 2:
            item = rng.choice([x for _, x in items if x and x.strip()])
            n = rng.randint(0, len(item) // 8)
            text += " " + edited(rng, item, n).replace(" ", rng.choice([" ", " \n"])).upper() + " " + prose(5)
        docs.append((i, text))
    docs += [(90, None), (91, ""), (92, items[0][1] + " " + items[1][1]), (92, items[0][1]), (None, items[2][1])]
    docs += [(93, "w " * 50000 + items[0][1])]
    return items, docs


@pytest.mark.parametrize("block_chars", [60, 2_000_000])
def test_every_occurrence_within_budget(spark, make, data, block_chars):
    items, docs = data
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, t in docs:
        for i, x in items:
            a, b = dc.normal(x or ""), dc.normal(t or "")
            if not a or not b:
                continue
            n = distance(a, b) if len(b) < 5000 or a not in b else 0
            if n <= len(a) // dc.CHARS_PER_EDIT:
                want.append((d, i, n))
    table = make(docs).withColumn("matches", F.lit("clash")).withColumn("item_id", F.lit(7))
    got = [tuple(r) for r in dc.contaminations(table, bench, block_chars=block_chars).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    hit = {d for d, _, _ in want}
    kept = dc.clean(table, bench, block_chars=block_chars)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda x: x or -1) == sorted(
        (d for d, _ in docs if d not in hit), key=lambda x: x or -1
    )


def test_empty_tables(spark, make, data):
    items, docs = data
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = make(docs)
    assert dc.contaminations(table.where("doc_id < 0"), bench).collect() == []
    assert dc.contaminations(table, bench.where("item_id < 0")).collect() == []
    assert dc.clean(table, bench.where("item_id < 0")).count() == len(docs)
