import glob
import math
import os

import duckdb
import pytest

from storyspark.plans.oracle import ORACLE
from storyspark.plans.queries import QUERIES

DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return repr(round(float(v), 6))
        return str(v)

    return sorted(tuple(plain(r[k]) for k in order) for r in data), [columns[k] for k in order]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    rel = duck.execute(ORACLE[name])
    want = rows([d[0] for d in rel.description], rel.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[1] == want[1]
    assert got[0] == want[0]
