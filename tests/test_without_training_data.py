"""The registry without the training-data package: only its own queries, no error."""

import subprocess
import sys
from pathlib import Path

CODE = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("haulmetric.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
assert set(entry.queries()) == set(entry.telemetry_queries()) == set(entry.oracle_sql())
"""


def test_entry_imports_without_it():
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", CODE], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_it():
    root = Path(__file__).resolve().parents[1]
    for path in [*root.glob("haulmetric/**/*.py"), *root.glob("*.py")]:
        if "llm" in path.parts or path.name in ("corpus_pipeline.py", "__spark_entry__.py"):
            continue
        assert "haulmetric.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
