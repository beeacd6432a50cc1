"""Every query of the log library beside its SQL, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from topicflow.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


def rows(frame):
    cols = sorted(frame.columns)

    def plain(v):
        v = v.item() if hasattr(v, "item") else v
        if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return None
        return round(float(v), 6) if isinstance(v, int | float) and not isinstance(v, bool) else v

    return cols, sorted((tuple(map(plain, r)) for r in frame[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert name in SQL
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{DATA}/events.parquet'")
    got, want = rows(QUERIES[name](spark, DATA).toPandas()), rows(con.sql(SQL[name]).df())
    assert got == want
