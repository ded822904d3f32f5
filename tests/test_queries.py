import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__

ORACLES = __spark_entry__.oracle_sql()
CORE = [n for n in __spark_entry__.queries() if not (n[0] == "p" and n[1].isdigit())]


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for file in glob.glob(f"{small}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", CORE)
def test_query_equals_sql(spark, small, duck, name):
    df = __spark_entry__.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert got
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        order = [d[0] for d in result.description]
        assert sorted(order) == columns
        assert got == Counter(tuple(plain(r[order.index(c)]) for c in columns) for r in result.fetchall())
