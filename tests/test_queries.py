"""Every registered query against its SQL twin, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(SF_DIR).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def ordered(columns, rows):
    places = [i for _, i in sorted((c, i) for i, c in enumerate(columns))]
    return sorted(tuple(repr(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    rows = df.collect()
    if name not in entry.oracle_sql():
        assert rows
        return
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.columns, rows) == ordered(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "gene_accession"
    assert set(entry.oracle_sql()) <= set(entry.queries())
