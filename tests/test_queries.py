"""Every query with SQL gives, over whole tables, the rows that DuckDB gives."""

import os

import duckdb
import pytest

from quillgraph import catalog


def shown(frame):
    """Rows as sorted text: floats exactly, nulls alike, dates without a midnight."""
    frame = frame[sorted(frame.columns)]
    text = frame.apply(lambda s: s.map(lambda v: "~" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v).replace(" 00:00:00", "")))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in os.listdir(small):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{small}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, spark, small, duck):
    frame = catalog.queries()[name](spark, small)
    assert len(set(frame.columns)) == len(frame.columns)
    got = frame.toPandas()
    if name not in catalog.oracle_sql():
        assert len(got)
        return
    want = duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = shown(got), shown(want)
    assert len(got) == len(want)
    assert (got.values == want.values).all()
