"""The driver's contract, with and without the corpus subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__
from terraflux.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def test_registry():
    assert __spark_entry__.queries().keys() >= QUERIES.keys() and __spark_entry__.queries().keys() >= __spark_entry__.oracle_sql().keys()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_without_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "terraflux", tmp_path / "terraflux", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"}, check=True)
    assert int(said.stdout.split()[-1]) == len(QUERIES)
