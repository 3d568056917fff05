"""The driver's entry without the training-data subpackage or what it imports."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["placelens.llm", "corpus_pipeline", "xxhash"])
def test_core_queries_load_without(missing):
    """A module that is None in sys.modules can't be imported."""
    code = f"""
import sys, warnings
sys.modules[{missing!r}] = None
warnings.simplefilter("ignore")
import __spark_entry__ as entry
from placelens.plans.catalog import QUERIES
assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
