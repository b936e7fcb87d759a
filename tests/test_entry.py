"""The driver's entry without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(root, code="import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"):
    got = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert got.returncode == 0, got.stderr
    return [set(line.split()) for line in got.stdout.splitlines()[-2:]]


def test_entry_without_llm(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    leave = {os.path.join(REPO, "hirelens"): {"llm"}, os.path.join(REPO, "tests"): {"llm"}, REPO: {".git"}}
    shutil.copytree(REPO, copy, ignore=lambda folder, names: leave.get(folder, set()) | {"__pycache__"})
    queries, sql = _names(copy)
    assert len(queries) >= 65 and queries == sql
    assert not any(n.startswith("op") or n == "pipeline" for n in queries)
    pipeline = os.path.join(copy, "corpus_pipeline.py")
    if os.path.exists(pipeline):
        os.unlink(pipeline)
        assert _names(copy) == [queries, sql]
    from hirelens.plans.registry import QUERIES
    assert queries == set(QUERIES)


def test_nothing_outside_llm_imports_it():
    for folder, _, files in os.walk(os.path.join(REPO, "hirelens")):
        for f in files:
            if f.endswith(".py") and not folder.endswith(os.sep + "llm"):
                with open(os.path.join(folder, f)) as text:
                    assert "llm" not in "".join(line for line in text if line.lstrip().startswith(("import", "from"))), f
