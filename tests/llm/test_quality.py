import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkyield.llm import quality
from sparkyield.llm.quality import Limits

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    return text.encode().split()


def plain(text):
    """Base figures, written as the contract says them."""
    words = split(text or "")
    n = len(words)
    seen = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    covered = set()
    for i in range(n - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if split(x)]
    return {
        "n_words": n,
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def odd_texts():
    rng = random.Random(3)
    return [
        None, "", "\n \t\n", "one", "a b c d e", "a b c d e " * 2, "a b c d e " * 3 + "f g",
        "x\ny\nx\n x\n\nx", "é# ü* <>|&%$ ß", "\x0b\x0c\r\x1c a", "w " * 30000,
        " ".join(str(rng.randrange(4)) for _ in range(500)),
        " ".join(str(rng.randrange(10**6)) for _ in range(500)),
    ]


def test_base_figures(spark, make):
    rows = [(i, t, None if i % 3 else "s") for i, t in enumerate(odd_texts())] + [(1, "", "s")]
    docs = make(rows).withColumn("kept", F.lit("clash")).withColumn("frequent", F.lit(1))
    got = quality.apply_rules(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(r["text"])
        assert {k: r[k] for k in want} == want
        assert r["kept"] is not r["base_failed"] and r["frequent"] == 1
    assert quality.apply_rules(docs.where("doc_id < 0")).collect() == []


def test_removal_and_rejection_by_host(spark, make):
    """Against a plain count over all documents."""
    rng = random.Random(4)
    limits = Limits(line_docs=3, line_share=0.2)
    words = [f"w{i}" for i in range(4000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(120):
        host = rng.choice(["a", "a", "b", None])
        lines = [prose(12) for _ in range(rng.randint(0, 2))]
        lines += rng.sample(["Share  this PAGE 12 now", "All rights are ours here", "rare one"], 2)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), host))
    rows += [(200 + i, rows[0][1], "a") for i in range(30)]  # copies count once
    docs = make(rows)
    hosts, seen = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        data = split(text)
        doc = tuple(sorted({tuple(data[i : i + 5]) for i in range(max(1, len(data) - 4))}))
        hosts[host].add(doc)
        for line in text.split("\n"):
            seen[host, quality.line_hash(line.encode())].add(doc)
    frequent = {
        k for k, d in seen.items() if len(d) > 3 and len(d) > 0.2 * len(hosts[k[0]])
    }
    got = quality.apply_rules(docs, limits=limits, left=True).collect()
    original = {i: t for i, t, _ in rows}
    removed = rejected = 0
    for r in got:
        lines = original[r["doc_id"]].split("\n")
        left = [x for x in lines if (r["source"], quality.line_hash(x.encode())) not in frequent]
        n, m = len(split("\n".join(lines))), len(split("\n".join(left)))
        assert r["text"] == "\n".join(left)
        assert (r["n_removed_lines"], r["n_left_words"]) == (len(lines) - len(left), m)
        depleted = len(left) < len(lines) and (m < 10 or m < 0.2 * n)
        assert r["kept"] == (not r["base_failed"] and not depleted)
        removed += len(left) < len(lines)
        rejected += depleted
    assert removed > 50 and rejected > 5


@pytest.mark.parametrize("footers", [1, 5])
def test_pages_of_mostly_boilerplate_are_rejected(spark, make, footers):
    """Different pages count each, however much of their text is the same."""
    rng = random.Random(footers)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    footer = [prose(100 // footers) for _ in range(footers)]
    rows = [(i, prose(60), "h") for i in range(100)]
    rows += [(100 + i, "\n".join([prose(12), *footer]), "h") for i in range(50)]
    rows += [(150 + i, rows[0][1], "h") for i in range(50)]  # copies count once
    got = quality.apply_rules(make(rows), left=True).collect()
    for r in got:
        page = 100 <= r["doc_id"] < 150
        assert r["kept"] is not page
        assert (r["n_removed_lines"], r["n_left_words"]) == ((footers, 12) if page else (0, 60))


@pytest.mark.parametrize("line", ["Ab  12\tc", "ab 99 C"])
def test_lines_are_normalised(line):
    assert quality.line_hash(line.encode()) == quality.line_hash(b"ab 34 c")
