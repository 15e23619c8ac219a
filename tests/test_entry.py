import collections
import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.10g}") if not math.isnan(v) else "NaN"
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "averagePlayCount" in df.columns


def test_every_report_query_has_an_oracle():
    assert set(E.report_queries()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_training_data_operators(tmp_path):
    """The folders of the optional part may be missing: nothing else needs them."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(E.__file__)
    shutil.copytree(os.path.join(root, "logcube"), tmp_path / "logcube", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.report_queries()) == set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_entry_works_without_a_library_of_the_operators():
    import subprocess
    import sys

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; assert set(e.queries()) == set(e.report_queries()) == set(e.oracle_sql())"
    found = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(E.__file__), check=True, capture_output=True, text=True)
    assert "xxhash" in found.stderr  # and says why


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(E.report_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    so = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    do = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    s = collections.Counter(tuple(norm(r[i]) for i in so) for r in df.collect())
    d = collections.Counter(tuple(norm(r[i]) for i in do) for r in rel.fetchall())
    assert s == d
