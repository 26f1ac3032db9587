"""The entry file where the training-data operators are not installed."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_entry_without_the_training_data_operators(tmp_path, with_pipeline):
    left_out = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(f"{REPO}/podium", tmp_path / "podium", ignore=left_out)
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    if with_pipeline and os.path.exists(f"{REPO}/corpus_pipeline.py"):
        shutil.copy(f"{REPO}/corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    names = run.stdout.split()
    assert names and all(name.startswith("q_") for name in names)
