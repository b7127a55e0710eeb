"""The entry point must load whatever is left of the optional operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
CODE = """import __spark_entry__ as entry
from rescuelens import catalog
assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())
assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_corpus_operators(tmp_path, pipeline):
    shutil.copytree(ROOT / "rescuelens", tmp_path / "rescuelens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline:
        (tmp_path / "corpus_pipeline.py").write_text("from rescuelens.llm import packing\n")
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
