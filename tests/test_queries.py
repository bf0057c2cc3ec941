"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract
from quayline.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_keys():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    # Queries of the library itself all have an equivalent.
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query(spark, duck, key):
    result = contract.queries()[key](spark, str(DATA))
    columns = sorted(result.columns)
    rows = Counter(tuple(r) for r in result.select(*columns).collect())
    cursor = duck.execute(
        f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[key]})"
    )
    assert rows == Counter(cursor.fetchall())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["slot", "slot_date", "line_no", "value"]
    assert result.count() > 0
