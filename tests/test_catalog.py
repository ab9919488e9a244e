"""Every registered query of the engine against its SQL, over the smallest tables."""

import glob
import os

import duckdb
import pytest

from readloom.plans import catalog, catalog_files, catalog_genome, catalog_more  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def norm(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    cell = lambda v: None if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else v
    return sorted((tuple(cell(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SF)
    want = con.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert norm(got.columns, [tuple(r) for r in got.collect()]) == norm(columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
