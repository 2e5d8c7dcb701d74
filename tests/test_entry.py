"""The optional subpackage can be left out."""

import os
import shutil
import subprocess
import sys

from .conftest import ROOT


def test_entry_without_the_training_data_operators(tmp_path):
    keep = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=keep)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q, set(e.oracle_sql()) == set(q))"
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, *flags = out.stdout.split()
    assert int(n) >= 70 and flags == ["False", "False", "True"]
