import re
from pathlib import Path

import pytest

from compare import database, rows_of
from graphloom.plans import oracle, queries

REPO = Path(__file__).resolve().parent.parent
SQL = oracle.oracle_sql()


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_its_sql(spark, small, name):
    got = queries.queries()[name](spark, small).toPandas()
    if name in SQL:
        assert rows_of(got) == rows_of(database(small).execute(SQL[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["src", "dst"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_llm_subpackage():
    for p in (REPO / "graphloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"graphloom\.llm|corpus_pipeline", p.read_text()), p
