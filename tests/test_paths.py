from graphloom.operators import retrieval


def found(spark, edges, starts, longest=10):
    e = spark.createDataFrame(edges, "src string, dst string")
    out = retrieval.paths(e, spark.createDataFrame([(s,) for s in starts], "id string"), longest)
    return sorted("".join(r.path) for r in out.collect() if r.start == r.path[0] and r.end == r.path[-1] and r.length == len(r.path) - 1)


def brute(edges, starts, longest):
    out, edges = [], set(edges)

    def walk(path, used):
        out.append("".join(path))
        for a, b in edges:
            if a == path[-1] and (a, b) not in used and len(used) < longest:
                walk([*path, b], used | {(a, b)})

    for s in set(starts):
        walk([s], frozenset())
    return sorted(out)


def test_paths_by_brute_force(spark):
    for edges in (
        [("a", "b"), ("b", "c"), ("b", "d"), ("d", "a"), ("a", "b"), ("c", "c")],
        [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b"), ("a", "c")],
        [],
    ):
        for longest in (0, 1, 6):
            assert found(spark, edges, ["a", "x", "a"], longest) == brute(edges, ["a", "x"], longest)


def test_null_ends_and_documents(spark):
    assert found(spark, [("a", None), (None, "a")], ["a", None]) == ["a"]
    chunks = spark.createDataFrame([("d", 0, "a"), ("d", 1, "b"), ("e", 1, "c"), ("f", 0, "g")], "document_uuid string, chunk_index int, chunk_uuid string")
    stale = spark.createDataFrame([("a", "b"), ("a", "c"), ("g", "z")], "src string, dst string")
    assert sorted(r.path for r in retrieval.sequence_paths(chunks).collect()) == ["a", "a>b", "g"]
    assert sorted((r.document_uuid, r.path) for r in retrieval.sequence_paths(chunks, edges=stale).collect()) == [("d", "a"), ("d", "a>b"), ("d", "a>c"), ("f", "g"), ("f", "g>z")]
