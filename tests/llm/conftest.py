"""Small tables for the operators: every edge case the docstrings define."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A ``documents`` table from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def build(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return build
