"""The entry points without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_queries_without_the_subpackage(tmp_path):
    place = tmp_path / "copy"
    shutil.copytree(ROOT, place, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json"))
    assert (place / "corpus_pipeline.py").exists() and not (place / "tidemark" / "llm").exists()
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q); print(len(q), 'pipeline' in q)"
    for drop in (False, True):
        if drop:
            (place / "corpus_pipeline.py").unlink()
        out = subprocess.run([sys.executable, "-c", code], cwd=place, capture_output=True, text=True)
        assert out.returncode == 0, out.stderr
        count, pipeline = out.stdout.split()
        assert int(count) > 100 and pipeline == "False"
