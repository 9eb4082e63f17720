"""Driver contract: entry runs, every query has a callable, oracle keys are queries."""
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 1 and "total_providers" in df.columns


def test_registry():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 90
    assert set(o) <= set(q)


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_registry_without_the_optional_parts(tmp_path, with_pipeline):
    # a copy without the training-data subpackage, with and without the pipeline file
    shutil.copytree(os.path.join(ROOT, "dirlens"), tmp_path / "dirlens",
                    ignore=lambda at, names: [n for n in names if n == "llm" or n == "__pycache__"])
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * with_pipeline:
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    code = ("import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); assert set(o) <= set(q) and len(q) >= 90; "
            "assert 'pipeline' not in q and not any(x.startswith('op') for x in q)")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
