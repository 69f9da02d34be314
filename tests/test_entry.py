"""The entry point without the corpus operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

WITHOUT = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("fieldledger.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
assert entry.queries() and not [k for k in entry.queries() if k == "pipeline" or k[:2] == "op" and k[2].isdigit()]
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_entry_without_corpus_operators():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_them():
    for path in ROOT.glob("**/*.py"):
        parts = path.relative_to(ROOT).parts
        if "llm" not in parts and parts[-1] not in ("__spark_entry__.py", "corpus_pipeline.py", "test_entry.py"):
            assert "fieldledger.llm" not in path.read_text("utf-8"), path
