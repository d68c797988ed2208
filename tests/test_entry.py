"""What the entry module offers when a part of the repository or a library is missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, {root!r})

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), set(entry.oracle_sql()) <= set(entry.queries()))
"""


def offered(name):
    code = CODE.format(root=str(ROOT), name=name)
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("name", ["cohortlake.llm", "corpus_pipeline", "tokenizers_of_another_kind", "numpy"])
def test_plain_queries_stay(name):
    from cohortlake.plans.catalog import QUERIES

    done = offered(name)
    count, whole = done.stdout.split()
    assert int(count) >= len(QUERIES) and whole == "True"
    if name in ("cohortlake.llm", "corpus_pipeline"):
        assert int(count) == len(QUERIES)


def test_a_module_of_the_plain_part_is_not_missed_silently():
    done = offered("cohortlake.sinks.tables")
    assert done.returncode and "cohortlake.sinks.tables" in done.stderr
