"""The library and its entry points without the training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from checks.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
PART = ("creditlake/llm", "tests/llm", "corpus_pipeline.py")


@pytest.mark.parametrize("kept", [(), ("corpus_pipeline.py",)])
def test_the_rest_imports_and_its_tests_are_found(tmp_path, kept):
    left_out = {str(ROOT / p) for p in PART if p not in kept}

    def skipped(folder, names):
        return [n for n in names if f"{folder}/{n}" in left_out or n in (".git", "__pycache__", ".pytest_cache")]

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skipped)
    listed = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()), sep='\\n')"],
        cwd=copy, capture_output=True, text=True, check=True,
    )
    assert listed.stdout.split() == sorted(QUERIES)
    found = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"],
        cwd=copy, capture_output=True, text=True,
    )
    assert found.returncode == 0, found.stdout
