"""The entry file with and without the training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from checks.registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
# A package that cannot be imported.
BLOCKED = "import sys; sys.modules['ahocorasick'] = None; "


def shown(folder, code):
    # Nothing is found by way of the tests' own path.
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


@pytest.mark.parametrize("left_out", [
    ["visitlog/llm", "tests/llm", "corpus_pipeline.py"], ["visitlog/llm", "tests/llm"], ["corpus_pipeline.py"], [],
])
def test_without_parts(tmp_path, left_out):
    def ignored(folder, names):
        rest = Path(folder).relative_to(ROOT)
        return [n for n in names if str(rest / n) in left_out or n in (".git", "__pycache__")]

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=ignored)
    queries, sql, pipeline = shown(copy, SHOW)
    present = (ROOT / "visitlog/llm").exists() and "visitlog/llm" not in left_out
    assert int(queries) == len(QUERIES) and int(sql) == len(QUERIES) or present and int(queries) > len(QUERIES)
    assert (pipeline == "True") == (present and (ROOT / "corpus_pipeline.py").exists() and "corpus_pipeline.py" not in left_out)


def test_without_a_library():
    queries, sql, pipeline = shown(ROOT, BLOCKED + SHOW)
    assert int(queries) == int(sql) == len(QUERIES) and pipeline == "False"
