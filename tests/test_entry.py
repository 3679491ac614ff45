"""The entry without what the text operators need, each in a process of its own."""

import subprocess
import sys
from pathlib import Path

import pytest

from barloom.catalog.oracle import ORACLE
from barloom.catalog.queries import QUERIES

CODE = """
import sys, warnings
sys.modules[{name!r}] = None
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
own = [str(w.message) for w in seen if "text operators" in str(w.message)]
print(len(entry.queries()), len(entry.oracle_sql()), len(own))
"""


def entry_without(name):
    """Numbers of queries, of SQL counterparts and of warnings if a module cannot be imported."""
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(name=name)], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]
    return [int(n) for n in done.stdout.split()]


@pytest.mark.parametrize("name", ["corpus_pipeline", "barloom.llm"])
def test_the_other_queries_stay(name):
    assert entry_without(name) == [len(QUERIES), len(ORACLE), 0]
