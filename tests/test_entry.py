"""The entry file with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(set(e.oracle_sql()) - set(e.queries())))"


def counts(folder):
    done = subprocess.run(
        [sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, check=True,
        env={**os.environ, "PYTHONPATH": ""},
    )
    return done.stdout.strip()


def copy_without(tmp_path, *left_out):
    target = tmp_path / "copy"
    skipped = shutil.ignore_patterns("__pycache__", ".git", *left_out)
    shutil.copytree(ROOT, target, ignore=skipped)
    return target


def test_all_queries_but_those_of_the_operators_stay(tmp_path):
    """With the operators' folders gone, and with or without the pipeline file."""
    from checks import all_queries, all_sql

    rest = f"{len(all_queries())} {len(all_sql())} []"
    bare = copy_without(tmp_path, "llm")
    assert counts(bare) == rest
    os.remove(bare / "corpus_pipeline.py") if (bare / "corpus_pipeline.py").exists() else None
    assert counts(bare) == rest
    (bare / "eventloom" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion may leave
    assert counts(bare) == rest
