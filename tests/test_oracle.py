"""Every query with SQL against DuckDB on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table([tuple(r) for r in df.collect()], df.columns)
    answer = duck.execute(SQL[name])
    assert got == table(answer.fetchall(), [c[0] for c in answer.description])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 20


@pytest.mark.parametrize("name", ["email_author_fixpoint", "recluster_components"])
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0 and df.count() == df.dropDuplicates([df.columns[0], df.columns[-1]]).count()
