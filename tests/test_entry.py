"""The entry works on an export without the subpackage of text operators, with or without the pipeline's file."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [False, True])
def test_without_llm(tmp_path, pipeline):
    shutil.copytree(ROOT / "segloom", tmp_path / "segloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 100 and set(s) <= set(q); assert not [n for n in q if n.startswith('op') and n[2].isdigit()]; assert 'pipeline' not in q"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
