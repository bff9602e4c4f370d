"""The driver's gate, locally: every registered query equals its DuckDB
oracle (row count, column names, multiset of values) on sf0.001; queries
without an oracle must at least run."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as entry
from histlake.plans import registry

SF = "/root/testdata/sf0.001"
# the library's own queries; those of optional parts have tests of their own
QUERIES = {name: fn for name, fn in entry.queries().items() if name in registry.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_salary" in df.columns


def test_entry_works_without_the_training_data_subpackage(tmp_path):
    """In a checkout that has only the library: its queries and nothing else."""
    root = Path(entry.__file__).resolve().parent
    for name in ("histlake", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).is_dir():
            shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    code = ("import __spark_entry__ as e; from histlake.plans import registry as r; import test_registry; "
            "assert set(e.queries()) == set(r.QUERIES) and set(e.oracle_sql()) == set(r.ORACLES)")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env=os.environ | {"PYTHONPATH": f"{tmp_path}:{tmp_path}/tests"})
    assert done.returncode == 0, done.stderr


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, msg
