"""The rest works without the optional subpackage, and without a library that only it needs."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAID = "import __spark_entry__ as e; print('queries', len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def said(folder, first=""):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", first + SAID], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()[1:], done.stderr


@pytest.fixture(scope="module")
def copy(tmp_path_factory):
    folder = tmp_path_factory.mktemp("without") / "repo"
    left_out = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py")
    shutil.copytree(ROOT, folder, ignore=left_out)
    return folder


def test_without_the_folders(copy):
    (n, oracles, pipeline), errors = said(copy)
    assert int(n) > 80 and int(oracles) > 70 and pipeline == "False" and "left out" in errors


def test_without_a_library():
    blocked = "import sys; sys.modules['zstandard'] = None; "
    (n, _, pipeline), errors = said(ROOT, blocked)
    assert int(n) > 80 and pipeline == "False" and "zstandard" in errors


def test_nothing_else_imports_it():
    for folder, _, files in os.walk(os.path.join(ROOT, "ledgerlens")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "ledgerlens.llm" not in f.read(), name
