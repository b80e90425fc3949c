"""The entry file with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_operators(tmp_path):
    """On a copy without tidemark/llm and tests/llm, with corpus_pipeline.py and without it, the engine's queries and SQL remain."""
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "bench.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e, bench; from tidemark.plans import catalogue as c; assert set(e.queries()) == set(c.QUERIES) and set(e.oracle_sql()) == set(c.ORACLES)"
    for _ in range(2):
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
