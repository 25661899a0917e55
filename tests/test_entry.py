"""The entry points without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def copied(folder, *gone):
    """The code, without what is gone."""
    skipped = shutil.ignore_patterns("__pycache__", *gone)
    shutil.copytree(os.path.join(ROOT, "corpusengine"), folder / "corpusengine", ignore=skipped)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in gone and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), folder)
    return folder


@pytest.mark.parametrize("gone", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_entry_imports_without_the_optional_parts(tmp_path, gone):
    folder = copied(tmp_path, *gone)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op1_') for n in q), set(e.oracle_sql()) <= set(q))"
    env = {**os.environ, "PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, pipeline, first, known = done.stdout.split()
    assert int(n) > 80 and (pipeline, first, known) == ("False", "False", "True")


def test_other_missing_modules_are_errors(tmp_path):
    folder = copied(tmp_path, "minhash.py")
    if not os.path.exists(folder / "corpusengine/llm"):
        pytest.skip("the optional part is left out")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0
