"""Every registered query against its SQL oracle on the smallest tables."""

import glob
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toArrow()
    expected = con.execute(ORACLES[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(expected.column_names)
    assert got.num_rows == expected.num_rows > 0
    con.register("got", got.select(columns))
    con.register("expected", expected.select(columns))
    for a, b in (("got", "expected"), ("expected", "got")):
        left = con.execute(f"SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b} LIMIT 3").fetchall()
        assert left == []


def test_svd_queries_equal_numpy(spark):
    entries = QUERIES["ppmi_matrix"](spark, SF).collect()
    n = QUERIES["assoc_items"](spark, SF).count()
    m = np.zeros((n, n))
    for r in entries:
        m[r.i, r.j] = r.value
    full_u, full_s, _ = np.linalg.svd(m)
    sigma = [r.sigma for r in QUERIES["svd_sigma"](spark, SF).orderBy("k").collect()]
    assert len(sigma) == min(64, n - 1) and np.allclose(sigma, full_s[:len(sigma)], atol=1e-5)
    rows = QUERIES["svd_factors"](spark, SF).orderBy("card_id").collect()
    u = np.array([r.u for r in rows])
    assert np.allclose(np.abs(u[:, :3]), np.abs(full_u[:, :3]), atol=1e-4)
    kept = (u[:, :16] * sigma[:16]).var(axis=0).sum() / m.var(axis=0).sum()
    got = QUERIES["explained_variance"](spark, SF).head()["explained_variance"]
    assert abs(got - kept) < 1e-5


def test_entry_has_rows(spark):
    assert not entry_points.entry(spark).isEmpty()
