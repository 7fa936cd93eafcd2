import pytest
from pyspark.sql import functions as F

from graphloom.llm.common import NO_ID, by_range


@pytest.mark.parametrize("ids", [list(range(300)), [5] * 100 + list(range(200)), [NO_ID, 0, *range(1 << 40, (1 << 40) + 200), (1 << 63) - 1], [-3, -2, -1, 0, 1, 2] * 20])
def test_ranges_are_even_and_ascending(spark, ids):
    docs = spark.createDataFrame([(i, "x" * 10) for i in ids], "d long, text string").repartition(3)
    out, points = by_range(docs, F.col("d"), target=200)
    rows = sorted((r.d, r._bucket) for r in out.collect())
    assert [b for _, b in rows] == sorted(b for _, b in rows)
    assert len(rows) == len(ids)
    by = {}
    for d, b in rows:
        by.setdefault(b, []).append(d)
    assert max(by) <= len(points)
    assert all(len(v) <= 20 or len(set(v)) == 1 for v in by.values())
    assert all(len(by[b]) + len(by[b + 1]) > 20 for b in range(max(by)) if b in by and b + 1 in by)
    assert by_range(docs.repartition(5), F.col("d"), target=200)[1] == points
