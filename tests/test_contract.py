import duckdb
import pytest

import __spark_entry__ as contract

NAMES = sorted(contract.library_queries())


@pytest.fixture(scope="module")
def con(sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    return con


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["doc_a", "doc_b", "jaccard"] and df.count() > 0


def test_every_query_has_sql():
    assert NAMES == sorted(contract.library_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf_small, name):
    got = contract.library_queries()[name](spark, sf_small).toArrow()
    want = con.sql(contract.library_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    order = [(c, "ascending") for c in columns]
    assert got.select(columns).sort_by(order).to_pylist() == (
        want.select(columns).sort_by(order).to_pylist()
    )
