"""The entry points stand without the corpus operators and without the libraries that only those need."""

import subprocess
import sys
from pathlib import Path

import pytest

from shoplens.operators import interactions as I
from shoplens.plans import jobs
from shoplens.plans.workspace import workspace
from shoplens.session import pin_utc

HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] in {0!r} or name in {0!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
from shoplens.plans import queries as registry
assert set(registry.QUERIES) <= set(entry.queries()), 'core queries are missing'
print(len(entry.queries()) - len(registry.QUERIES), sorted(set(entry.oracle_sql()) - set(registry.ORACLES)))
"""


@pytest.mark.parametrize("hidden", [["sentencepiece"], ["zstandard"], ["tokenizers"], ["shoplens.llm"], ["corpus_pipeline", "shoplens.llm"]])
def test_core_queries_without(hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden)], capture_output=True, text=True, timeout=120,
                          cwd=Path(__file__).resolve().parent.parent)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == "0 []"


def test_pairs_are_split_once(spark, small, capsys):
    """Readers of train and test read what was written instead of hashing every pair again."""
    ws = workspace(pin_utc(spark), small)
    for part, plain in zip(jobs.train_test(ws), I.split_pairs(ws.table("interaction_matrix"))):
        assert part.exceptAll(plain).isEmpty() and plain.exceptAll(part).isEmpty()
        part.explain()
    assert "md5" not in capsys.readouterr().out
