"""The entry works without the corpus operators, whatever of them is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

from stockflow.plans.oracles import ORACLES
from stockflow.plans.registered import QUERIES

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == sys.argv[1] or name.startswith(sys.argv[1] + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""
PACKAGES = ["public_tokenizers", "zstandard", "stockflow.llm", "corpus_pipeline"]


@pytest.mark.parametrize("package", PACKAGES)
def test_the_other_queries_stay(package):
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, package], cwd=ROOT, capture_output=True, text=True, check=True
    )
    assert run.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


def test_a_broken_core_is_not_hidden():
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, "stockflow.plans"], cwd=ROOT, capture_output=True, text=True
    )
    assert run.returncode and "stockflow.plans" in run.stderr
