"""The driver's file without the folders of the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q); assert not [n for n in q if n == 'pipeline' or n.startswith('op1')]"


@pytest.mark.parametrize("kept", [True, False])
def test_imports_without_the_folders(tmp_path, kept):
    """With both folders gone, and with or without corpus_pipeline.py, the other queries are registered."""
    shutil.copytree(ROOT / "cargolume", tmp_path / "cargolume", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if kept:
        (tmp_path / "corpus_pipeline.py").write_text("import cargolume.llm\n")
    made = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True)
    assert made.returncode == 0, made.stderr
