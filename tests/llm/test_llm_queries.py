import pytest

from compare import database, rows_of
from graphloom.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, small, name):
    assert rows_of(queries.queries()[name](spark, small).toPandas()) == rows_of(database(small).execute(SQL[name]).df())


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in SQL])
def test_query_runs_over_the_whole_table(spark, small, name):
    table, key = ("pages", "page_id") if name.startswith("op4") else ("documents", "doc_id")
    want = {r[0] for r in spark.read.parquet(f"{small}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in queries.queries()[name](spark, small).select(key).collect()} == want
