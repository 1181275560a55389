"""The entry works without the training-data folder and without a library that it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
CODE = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{gone!r}] = None
import __spark_entry__ as e
names = e.queries()
print(len(names), any(n.startswith("op") for n in names), "pipeline" in names, set(e.oracle_sql()) <= set(names))
"""


@pytest.mark.parametrize("gone", ["public_tokenizers", "xxhash", "corpus_pipeline", "sparkyield.llm"])
def test_queries_without_a_module(gone):
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, gone=gone)], capture_output=True, text=True, check=True)
    n, ops, pipeline, known = out.stdout.split()
    assert int(n) > 150 and pipeline == "False" and known == "True"
    if gone != "corpus_pipeline":
        assert ops == "False"
    assert ("is left out" in out.stderr) == (gone in ("public_tokenizers", "xxhash"))
