"""Operators that SQL can express beside their SQL, on the smallest tables."""

import duckdb
import pytest

from tests.test_queries import rows
from topicflow.llm.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    assert rows(queries()[name](spark, DATA).toPandas()) == rows(con.sql(oracle_sql()[name]).df())
