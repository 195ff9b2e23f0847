"""The rest works where the corpus operators and their tests are absent."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_operators(tmp_path):
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".*")
    for name in ("tidemark", "oracle"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=left_out)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    for with_pipeline in (False, True):
        if with_pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
            shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
        n_queries, n_sql = map(int, done.stdout.split())
        assert n_queries > 80 and n_sql == n_queries - 1
