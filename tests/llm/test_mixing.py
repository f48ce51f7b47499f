import random

from pyspark.sql import functions as F

from lodestrata.llm import mixing as M


def brute_targets(sizes):
    """Water-filling by small steps of the level."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weights = [(5, 2, 1)[k % 3] for k in range(len(ordered))]
    budget, lo, hi = 1.5 * sum(n for _, n in ordered), 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2 * n, w * mid) for w, (_, n) in zip(weights, ordered)) < budget else (lo, mid)
    return [min(2 * n, w * hi) for w, (_, n) in zip(weights, ordered)]


def test_targets():
    for seed in range(20):
        rng = random.Random(seed)
        sizes = [(f"s{k}", rng.choice([0, 1, 10, 500, 10000])) for k in range(rng.randrange(1, 12))] + [(None, 50)]
        got = [t for _, _, t in M.targets(sizes)]
        assert all(abs(a - b) <= 1e-6 * max(1, b) for a, b in zip(got, brute_targets(sizes), strict=True))


def test_sources_come_near_their_targets(spark):
    rng = random.Random(0)
    rows = [(k, "w " * rng.randrange(1, 60), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = M.mix(df)
    for r in mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"), F.first("source_size").alias("said"), F.max("copies").alias("most")).collect():
        assert abs(r["taken"] - r["target"]) < 60 and r["size"] == r["said"] and r["most"] <= 2
    again = {tuple(r) for r in M.mix(df.repartition(7)).select("doc_id", "copies").collect()}
    assert again == {tuple(r) for r in mixed.select("doc_id", "copies").collect()}


def test_expectation_is_kept():
    import numpy as np

    size, total = np.array([3.0, 5.0, 2.0, 7.0]), np.zeros(4)
    rng = np.random.default_rng(1)
    for _ in range(4000):
        part = M.pivot(size, np.full(4, 0.4), rng.random(4))
        assert abs((part * size).sum() - 0.4 * size.sum()) < 1e-6 and ((part > 0) & (part < 1)).sum() <= 1
        total += part
    assert np.abs(total / 4000 - 0.4).max() < 0.03


def test_edges(edge_docs, no_docs):
    rows = M.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["copies"] <= 2 for r in rows)
    assert M.mix(no_docs).count() == 0 and M.take(no_docs).count() == 0
    assert M.take(edge_docs).columns == edge_docs.columns
