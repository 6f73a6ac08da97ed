"""The library and its checked queries stand without the corpus subpackage."""

import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.modules["murmullo.llm"] = None
import __spark_entry__ as entry
assert entry.corpus is None
assert entry.queries() and not any(n.startswith("op1_") or n == "pipeline" for n in entry.queries())
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_entry_without_the_subpackage():
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", CODE], cwd=root, check=True, timeout=120)


def test_nothing_else_imports_it():
    root = Path(__file__).resolve().parents[1]
    files = [p for top in ("murmullo", "checks") for p in (root / top).rglob("*.py")]
    files = [p for p in files if "llm" not in p.relative_to(root).parts]
    assert files and not any("murmullo.llm" in p.read_text() for p in files)
