import numpy as np

from lodestrata.llm import nearest as N


def brute(rows, k, ask):
    out = {}
    for q, v in rows:
        if not ask(q):
            continue
        scored = sorted((-float(np.dot(v, w) / (np.sqrt(np.dot(v, v)) * np.sqrt(np.dot(w, w)))), i) for i, w in rows if i != q)
        out[q] = scored[:k]
    return out


def test_recall_and_scores(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = [(r["vec_id"], np.array(r["embedding"], dtype=np.float64)) for r in rows.collect()]
    want = brute(data, 5, lambda q: q % 10 == 0)
    found = N.search(rows, rows.where("vec_id % 10 = 0"), k=5).collect()
    hit = sum((r["vec_id"] in [i for _, i in want[r["query_id"]]]) for r in found)
    assert len(found) == 5 * len(want) and hit / len(found) >= 0.99
    by = dict(data)
    for r in found:
        assert abs(r["score"] - float(N.cosine(by[r["query_id"]][None], by[r["vec_id"]][None])[0])) < 1e-15


def test_edges(spark):
    kind = "vec_id long, embedding array<float>, label int, v string, query_id long"
    rows = [(0, [1.0, 0.0], 1, "x", 1), (1, [2.0, 0.0], 1, "x", 1), (2, [3.0, 0.0], 1, "x", 1), (3, [0.0, 1.0], 1, None, 1), (3, [0.0, 1.0], 1, None, 1), (4, None, 1, "x", 1), (5, [0.0, 0.0], 1, "x", 1), (6, [None, 1.0], 1, "x", 1),
            (7, [float("nan"), 1.0], 1, "x", 1), (8, [1.0, 0.0, 0.0], 1, "x", 1), (None, [1.0, 1.0], 1, "x", 1), (9, [float("inf"), 1.0], 1, "x", 1), (10, [], 1, "x", 1)]
    df = spark.createDataFrame(rows, kind)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.search(df, df, k=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (1, 1, 0, 1.0), (1, 2, 2, 1.0), (2, 1, 0, 1.0), (2, 2, 1, 1.0), (3, 1, 0, 0.0), (3, 2, 1, 0.0)]
    assert N.search(df.limit(0), df.limit(0)).count() == 0
    assert len(N.search(df.where("vec_id in (0, 1)"), df.where("vec_id = 0"), k=5).collect()) == 1
