"""The entry points with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__
import pytest

HIDE = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if any(f"{name}.".startswith(f"{x}.") for x in HIDDEN):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
names = set(e.queries())
assert names and not any(n.startswith("op") and n[2].isdigit() for n in names), names
assert "pipeline" not in names
assert set(e.oracle_sql()) <= names
"""


@pytest.mark.parametrize("hidden", [("tallyline.llm",), ("tallyline.llm", "corpus_pipeline")])
def test_queries_without_the_optional_subpackage(hidden):
    root = Path(__file__).resolve().parent.parent
    run = subprocess.run([sys.executable, "-c", f"HIDDEN = {hidden!r}\n{HIDE}"], cwd=root, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr


def test_a_broken_module_is_not_taken_for_an_absent_one(tmp_path, monkeypatch):
    (tmp_path / "needs_absent_library.py").write_text("import no_such_library_anywhere\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        __spark_entry__._optional("needs_absent_library", "QUERIES")


def test_every_statement_belongs_to_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
