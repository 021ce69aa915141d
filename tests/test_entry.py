"""The core queries stand whatever is missing of the operators on documents."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

CODE = """
import sys, warnings
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {root!r})
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
names = set(entry.queries())
assert "order_metrics" in names and "load_row_counts" in names and len(names) > 80, names
assert not any(n.startswith("op") or n == "pipeline" for n in set(names) - {{"order_metrics", "order_texts"}}), names
assert set(entry.oracle_sql()) <= names
assert bool([w for w in said if "left out" in str(w.message)]) == {warned}, said
"""


@pytest.mark.parametrize(
    "names, warned",
    [(["bazaarframe.llm"], False), (["corpus_pipeline"], False), (["public_tokenizers"], True), (["bazaarframe.llm.words"], True)],
)
def test_entry_without(names, warned):
    code = CODE.format(names=set(names), root=str(ROOT), warned=warned)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=ROOT)
    assert done.returncode == 0, done.stderr
