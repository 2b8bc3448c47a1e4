"""Every registered query against its DuckDB oracle on the smallest data set.

Same comparison as the driver's correctness gate: column names, row count and the
order-insensitive multiset of rows (doubles compared to 9 significant digits).
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from folio.plans import registry
from folio.sources.tables import DRIVER_TABLES, table_path

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE  # the optional queries have tests of their own


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = table_path(SF, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["title", "author", "ratings_cnt", "avg_rating", "weighted_rating"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows, scols = df.collect(), df.columns
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(scols, srows) == _canon(dcols, drows)
