"""Every registered query beside its SQL on the smallest tables."""

import pathlib
import re
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tools import check

from conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


OWN = [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)]


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    want = con.execute(entry.oracle_sql()[name])
    columns, expected = check.rows_of([d[0] for d in want.description], want.fetchall())
    assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == (columns, expected)


def test_entry_works_without_the_training_data_operators(tmp_path):
    """Neither absent folders nor a left-over cache folder of them stops the import."""
    root = pathlib.Path(entry.__file__).parent
    for leave_cache in (False, True):
        copy = tmp_path / str(leave_cache)
        shutil.copytree(root / "noticeworks", copy / "noticeworks", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(root / "__spark_entry__.py", copy)
        if leave_cache:
            (copy / "noticeworks" / "llm" / "__pycache__").mkdir(parents=True)
        code = "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 70; print(sorted(e.queries())[0])"
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr


def test_entry(spark):
    assert entry.entry(spark).count() > 0
