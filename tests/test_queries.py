"""Every registered query against its DuckDB text at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from arriero.plans.oracle import ORACLE
from arriero.plans.registry import QUERIES
from arriero.plans.sql import run_script, statements
from tools.check_oracle import TABLES, compare


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    ok, text = compare(spark, duck, name, sf)
    assert ok, text


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 17 and df.count() > 0


def test_script(spark, tmp_path):
    path = tmp_path / "s.sql"
    path.write_text("CREATE OR REPLACE TEMP VIEW t AS SELECT 'a;b' AS x, 1 AS n;\n\nSELECT * FROM t WHERE n >= :minimo;\n", encoding="utf-8")
    assert len(statements(path.read_text())) == 2
    assert run_script(spark, str(path), {"minimo": 1})[-1].collect()[0].x == "a;b"
