"""The entry points without the operators of training data."""

import subprocess
import sys

from conftest import ROOT

_PROBE = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
from innmetrics.checks.registry import QUERIES
assert set(entry.queries()) == set(QUERIES), "only the core queries are left"
assert set(entry.oracle_sql()) <= set(QUERIES)
"""


def test_core_queries_stay_without_the_training_data_operators():
    for missing in ("innmetrics.llm", "corpus_pipeline", "xxhash"):
        done = subprocess.run([sys.executable, "-c", _PROBE.format(missing=missing)], cwd=ROOT, capture_output=True)
        assert done.returncode == 0, done.stderr.decode()
