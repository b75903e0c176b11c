"""Every query with SQL against DuckDB on the smallest tables; skipped where those are absent."""

import pathlib
import sys

import pytest

DATA = pathlib.Path("/root/testdata/sf0.001")
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")

from check_oracle import TABLES, canonical  # noqa: E402
from tidemark.plans import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, str(DATA)).toPandas()
    want = duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got).equals(canonical(want))


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as spark_entry

    out = spark_entry.entry(spark)
    assert out.columns == ["lang", "n", "mean_current", "psi", "drift", "band"] and out.count() == 4
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
