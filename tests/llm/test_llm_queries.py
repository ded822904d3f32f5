import glob
import os

import duckdb
import pytest

pytest.importorskip("hortulus.llm.queries")
from hortulus.llm.oracles import oracle_sql  # noqa: E402
from hortulus.llm.queries import queries  # noqa: E402


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, small, name):
    df = queries()[name](spark, small)
    columns = sorted(df.columns)
    got = sorted(map(str, df.select(*columns).collect()))
    if name in oracle_sql():
        connection = duckdb.connect()
        for file in glob.glob(f"{small}/*.parquet"):
            connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
        result = connection.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall()
        assert got == sorted(f"Row({', '.join(f'{c}={v!r}' for c, v in zip(columns, r))})" for r in result)
    else:
        assert got or name == "p2_restored"
