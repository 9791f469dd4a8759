"""The driver contract with and without the training-data subpackage."""

import importlib.util
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sorted(n for n in e.queries() if n[:2] == 'op' and n[2].isdigit() or n == 'pipeline'))"


def listed(folder):
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(folder)})


@pytest.fixture()
def bare(tmp_path):
    """A copy of the package as it is without the subpackage."""
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/fabspark", tmp_path / "fabspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return tmp_path


def test_without_subpackage(bare):
    alone = listed(bare)
    assert alone.returncode == 0 and alone.stdout.split(" ", 1)[1].strip() == "[]", alone.stderr
    (bare / "corpus_pipeline.py").write_text("from fabspark.llm import mixing\n")
    left = listed(bare)
    assert left.returncode == 0 and left.stdout == alone.stdout, left.stderr


def test_other_errors_are_not_hidden(bare):
    (bare / "corpus_pipeline.py").write_text("import a_module_that_nobody_has\n")
    assert "a_module_that_nobody_has" in listed(bare).stderr
    if importlib.util.find_spec("fabspark.llm"):
        (bare / "corpus_pipeline.py").unlink()
        (bare / "fabspark" / "llm").mkdir()
        (bare / "fabspark" / "llm" / "__init__.py").write_text("")
        (bare / "fabspark" / "llm" / "queries.py").write_text("from fabspark.llm import nothing_there\n")
        assert listed(bare).returncode != 0
