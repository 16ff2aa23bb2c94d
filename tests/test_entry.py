"""The driver's entry module with and without what may be left out."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def names(root: str) -> list[str]:
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("left_out", [("tidemark/llm",), ("tidemark/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without_optional_parts(folder, left_out):
    root = f"{folder}/tree"
    hidden = {os.path.join(ROOT, x) for x in left_out} | {os.path.join(ROOT, x) for x in (".git", "tests")}
    shutil.copytree(ROOT, root, ignore=lambda at, found: [x for x in found if os.path.join(at, x) in hidden])
    count, sql, pipeline = names(root)
    from tidemark.plans import ORACLES, QUERIES

    assert pipeline == "False"
    if "tidemark/llm" in left_out:
        assert (int(count), int(sql)) == (len(QUERIES), len(ORACLES))
    else:
        assert int(count) > len(QUERIES)


def test_an_error_inside_an_operator_is_not_swallowed(folder):
    root = f"{folder}/tree"
    shutil.copytree(ROOT, root, ignore=lambda at, found: [x for x in found if x in (".git", "tests", "llm")])
    os.makedirs(f"{root}/tidemark/llm")
    for name, text in (("__init__", ""), ("queries", "import a_library_that_is_missing")):
        with open(f"{root}/tidemark/llm/{name}.py", "w") as file:
            file.write(text)
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "a_library_that_is_missing" in done.stderr


def test_a_pipeline_of_another_tree_is_not_taken(folder, monkeypatch):
    root = f"{folder}/tree"
    shutil.copytree(ROOT, root, ignore=lambda at, found: [x for x in found if x in (".git", "tests", "corpus_pipeline.py")])
    monkeypatch.setenv("PYTHONPATH", ROOT)
    assert names(root)[2] == "False"
    assert names(ROOT)[2] == "True"
