from graphloom.llm.line_dedup import line_dedup


def test_by_hand(spark):
    common = "  This Line is in many documents\t"
    rows = [(1, f"a\n{common}\nb"), (2, common.upper()), (3, f"{common}\n{common}\nshort"), (4, "short"), (5, "short"), (6, ""), (7, None), (8, "\n\n")]
    got = {r.doc_id: (r.kept_text, r.n_lines, r.n_dropped) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("a\nb", 3, 1)
    assert got[2] == ("", 1, 1)
    assert got[3] == (f"{common}\n{common}\nshort", 3, 0)
    assert got[5] == ("short", 1, 0)
    assert got[6] == got[7] == ("", 1, 0)
    assert got[8] == ("\n\n", 3, 0)


def test_a_repeated_document_counts_once(spark):
    line = "exactly the same line of text"
    rows = [(1, line), (1, line), (2, line)]
    assert all(r.n_dropped == 0 for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    rows.append((None, line))
    assert sorted(r.n_dropped for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [0, 1, 1, 1]


def test_many_lines_in_a_document(spark):
    n = 40_000
    rows = [(d, "\n".join(f"a line that all three documents hold, number {i}" if i % 3 else f"{d}, {i}" for i in range(n))) for d in range(3)]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d in (0, 1):
        assert got[d].kept_text == "\n".join(f"{d}, {i}" for i in range(0, n, 3))
        assert got[d].n_dropped == n - len(range(0, n, 3))
    assert got[2].kept_text == rows[2][1]


def test_only_ascii_is_folded(spark):
    rows = [(i, t) for i, t in enumerate(["É" * 25, "é" * 25, "É" * 25])]
    assert all(r.n_dropped == 0 for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_odd_rows(odd):
    out = line_dedup(odd)
    assert out.count() == 12
    assert dict(out.dtypes)["n_lines"] == "bigint"
    assert line_dedup(odd.limit(0)).count() == 0


def test_no_python_in_the_plan(odd):
    plan = line_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan
