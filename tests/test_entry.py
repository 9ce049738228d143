"""The entry point without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left", ["nothing", "caches", "pipeline"])
def test_all_other_queries_are_registered_without_them(tmp_path, left):
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "tests", "__pycache__")
    shutil.copytree(REPO, tmp_path / "repo", ignore=skip)
    if left != "nothing":
        (tmp_path / "repo/stratafold/llm/__pycache__").mkdir(parents=True)
    if left == "pipeline":
        shutil.copy(REPO / "corpus_pipeline.py", tmp_path / "repo")
    code = "import __spark_entry__ as e; names = set(e.queries()); assert len(names) > 60 and not [n for n in names if n.startswith('op')]; assert set(e.oracle_sql()) <= names"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, timeout=120)
