"""The entry module without the optional text operators."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["millrace.llm", "zstandard", "corpus_pipeline"])
def test_other_queries_stand_without_the_text_operators(missing):
    """A module that cannot be imported takes no query outside the text operators with it."""
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
from millrace.registry import all_queries, all_twins
assert len(all_queries()) > 150 and set(all_queries()) <= set(entry.queries())
assert set(all_twins()) <= set(entry.oracle_sql()) <= set(entry.queries())
assert "pipeline" not in entry.queries()
"""
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, check=True, timeout=120)
