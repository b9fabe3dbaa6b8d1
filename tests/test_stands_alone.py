"""The library without its corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

REPORT = """
import __spark_entry__ as driver
from coterie.plans.catalog import ALL_QUERIES
assert set(driver.queries()) == set(ALL_QUERIES), set(driver.queries()) ^ set(ALL_QUERIES)
assert set(driver.oracle_sql()) <= set(ALL_QUERIES)
"""


def copied(target, *left_out):
    shutil.copytree(ROOT / "coterie", target / "coterie", ignore=shutil.ignore_patterns(*left_out))
    shutil.copy(ROOT / "__spark_entry__.py", target)


def report(folder):
    run = subprocess.run([sys.executable, "-c", REPORT], cwd=folder, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr


def test_entry_without_the_corpus_package(tmp_path):
    copied(tmp_path, "llm")
    report(tmp_path)


def test_entry_without_the_package_but_with_the_pipeline(tmp_path):
    copied(tmp_path, "llm")
    (tmp_path / "corpus_pipeline.py").write_text("import coterie.llm\n")
    report(tmp_path)
