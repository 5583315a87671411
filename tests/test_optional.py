"""The entry works without the libraries that only the training-data operators need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
assert "fraud_report" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
"""


@pytest.mark.parametrize("name", ["xxhash", "tokenizers", "ahocorasick", "zstandard", "fraudmart.llm", "corpus_pipeline"])
def test_entry_without(name):
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
