"""The entry module with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

LISTED = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def _copy(tmp, *left_out):
    skipped = {os.path.normpath(os.path.join(ROOT, x)) for x in left_out}

    def ignore(folder, names):
        return [n for n in names if n in (".git", "__pycache__", "tests") or os.path.join(folder, n) in skipped]

    return shutil.copytree(ROOT, os.path.join(tmp, "copy"), ignore=ignore)


def _listed(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-B", "-c", LISTED], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    return [set(line.split()) for line in out.stdout.splitlines()]


@pytest.mark.parametrize("left_out", [("pricepanel/llm",), ("pricepanel/llm", "corpus_pipeline.py")])
def test_panel_queries_stay_without_the_optional_subpackage(tmpdir_path, left_out):
    from pricepanel.plans import catalog
    queries, oracles = _listed(_copy(tmpdir_path, *left_out))
    assert queries == set(catalog.QUERIES) and oracles == set(catalog.ORACLES)


def test_only_the_entry_and_the_pipeline_name_the_optional_subpackage():
    named = []
    for folder, _, names in os.walk(os.path.join(ROOT, "pricepanel")):
        if os.path.basename(folder) != "llm":
            named += [n for n in names if n.endswith(".py") and "llm" in open(os.path.join(folder, n)).read()]
    assert named == []
