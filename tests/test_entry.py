"""The driver contract, with and without the training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def copied(folder: Path, *left_out: str) -> str:
    """Names of all queries in a copy of the library without some of its folders."""
    skip = shutil.ignore_patterns("__pycache__", *left_out)
    shutil.copytree(ROOT / "tradeloom", folder / "tradeloom", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and (ROOT / name).exists():
            shutil.copy(ROOT / name, folder / name)
    code = "import __spark_entry__ as e; print(*e.queries()); assert e.oracle_sql().keys() <= e.queries().keys()"
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_without_the_training_data_part(tmp_path):
    names = copied(tmp_path, "llm")
    assert "mart_top_sellers" in names
    assert not [n for n in names if n.startswith("op") or n == "pipeline"]


def test_without_it_and_its_pipeline(tmp_path):
    assert "mart_top_sellers" in copied(tmp_path, "llm", "corpus_pipeline.py")
