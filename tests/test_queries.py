"""Every query with SQL gives what DuckDB gives on the same tables; the others run."""

import math
import os

import duckdb
import pytest

from utterframe.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "inf" if math.isinf(value) else repr(value)
    return repr(float(value)) if hasattr(value, "normalize") else str(value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert rows
    if name in catalog.ORACLE_SQL:
        result = duck.execute(catalog.ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert rows == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
