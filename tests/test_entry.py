"""The driver contract holds with the corpus package and its pipeline deleted."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

NAMES = """
import __spark_entry__ as contract
from billscope.plans import catalog
assert set(contract.queries()) == set(catalog.QUERIES), set(contract.queries()) ^ set(catalog.QUERIES)
assert set(contract.oracle_sql()) == set(catalog.QUERIES)
"""


@pytest.mark.parametrize("also_the_pipeline", [False, True])
def test_billing_queries_stay_without_the_corpus_package(tmp_path, also_the_pipeline):
    def gone(folder, names):
        at = Path(folder).relative_to(ROOT)
        left_out = {name for name in names if name == "__pycache__" or (at / name) in {Path("billscope/llm"), Path(".git"), Path("tests")}}
        return left_out | ({"corpus_pipeline.py"} & set(names) if also_the_pipeline else set())

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=gone)
    assert not (copy / "billscope/llm").exists()
    ran = subprocess.run([sys.executable, "-c", NAMES], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
