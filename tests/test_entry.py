"""The entry module with and without the subpackage of text operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
WITHOUT = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("geohealth.llm"):
            raise ModuleNotFoundError(name, name="corpus_pipeline" if name == "corpus_pipeline" else "geohealth.llm")
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert set(e.queries()) == set(e.oracle_sql()) and not any(n == "pipeline" or n.startswith("op") for n in e.queries())
print(len(e.queries()))
"""


def test_entry_without_the_subpackage():
    out = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, check=True)
    assert int(out.stdout) >= 80


def test_library_does_not_import_the_subpackage():
    for path in (ROOT / "geohealth").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "geohealth").parts:
            assert "geohealth.llm" not in path.read_text(), path
