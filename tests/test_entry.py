"""Every registered query with SQL must give the same rows in DuckDB on the smallest tables."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

DATA = Path("/root/testdata/sf0.001")
spec = importlib.util.spec_from_file_location("entry_module", Path(__file__).resolve().parent.parent / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")

from voxelflux.plans.queries import ORACLES, QUERIES  # noqa: E402


def test_all_core_queries_have_sql():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) >= 35
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    ours = QUERIES[name](spark, str(DATA)).toPandas()
    theirs = con.execute(ORACLES[name]).df()
    cols = sorted(theirs.columns)
    assert sorted(ours.columns) == cols
    a, b = (df[cols].sort_values(cols).reset_index(drop=True) for df in (ours, theirs))
    assert len(a) == len(b) > 0
    for c in cols:
        if a[c].dtype.kind == "f" or b[c].dtype.kind == "f":
            assert (a[c].isna() == b[c].isna()).all() and ((a[c] - b[c]).abs().max() or 0) < 1e-6 * max(1, a[c].abs().max()), c
        else:
            assert a[c].astype(str).tolist() == b[c].astype(str).tolist(), c
