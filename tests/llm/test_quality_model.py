import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lodestrata.llm import quality_model as M


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = M.learn(docs, labels.where(~held))
    found = M.score_documents(docs, model).join(labels, "doc_id").where(held)
    r = found.agg(F.avg(((F.col("score") >= 0.7).cast("int") == F.col("label")).cast("int")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r["a"] > 0.95 and r["lo"] >= 0 and r["hi"] <= 1


def test_gradient_lowers_the_loss_and_attention_finds_the_bad_passage():
    rng = np.random.default_rng(0)
    sizes = np.array([4] * 200)
    x = rng.normal(size=(800, M.FEATURES))
    y = np.ones(200)
    for k in range(0, 200, 2):  # one strange passage makes a document bad
        x[4 * k + int(rng.integers(4)), 3] = 9
        y[k] = 0
    model = M.train(x, sizes, y)
    assert ((M.score_bags(model, x, sizes) > 0.5) == (y == 1)).mean() > 0.97


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1), (7, 1), (7, 1)], "doc_id long, label int")
    model = M.learn(edge_docs, labels)
    rows = M.score_documents(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in M.score_documents(edge_docs, M.learn(edge_docs, labels.limit(0))).collect()} == {0.5}
    assert M.score_documents(no_docs, model).count() == 0


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    sizes, h = np.array([1, 4, 2, 7]), M.HIDDEN
    x, y = rng.normal(size=(14, M.FEATURES)), np.array([1.0, 0.0, 1.0, 0.0])
    model = {"mean": np.zeros(M.FEATURES), "scale": np.ones(M.FEATURES), "W": rng.normal(size=(M.FEATURES, h)) / 8, "b": rng.normal(size=h), "V": rng.normal(size=(h, h)) / 4, "U": rng.normal(size=(h, h)) / 4, "w": rng.normal(size=h), "c": rng.normal(size=h), "d": np.array(0.3)}

    def loss():
        s = M.score_bags(model, x, sizes)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grad, step = M.gradient(model, x, sizes, y), 1e-6
    for name, g in grad.items():
        for _ in range(6):
            at = tuple(int(rng.integers(k)) for k in model[name].shape)
            kept = model[name].copy()
            ends = []
            for sign in (1, -1):
                model[name] = kept.copy()
                model[name][at] += sign * step
                ends.append(loss())
            model[name] = kept
            assert abs((ends[0] - ends[1]) / (2 * step) - np.asarray(g)[at]) < 1e-6, (name, at)


def test_words_alone_can_tell(spark):
    """Texts that differ in nothing but their words: no count of letters, marks or repeats tells them apart."""
    rng = np.random.default_rng(1)
    good, bad = [f"{c}ala{k}" for k, c in enumerate("bdfg")], [f"{c}ola{k}" for k, c in enumerate("mnpr")]
    fill = [f"x{k:03d}z" for k in range(300)]
    rows = []
    for k in range(300):
        words = list(rng.choice(fill, 150))
        for at in rng.choice(150, 20, replace=False):
            words[at] = str(rng.choice(good if k % 2 else bad))
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, label int")
    found = M.score_documents(docs, M.learn(docs, labels)).where("doc_id >= 200").collect()
    assert np.mean([(r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in found]) > 0.9


def test_long_documents_train_on_evenly_spaced_passages(spark):
    text = "\n".join(f"word{k} " * 60 for k in range(M.BAG * 2))
    docs = spark.createDataFrame([(1, text), (2, "short text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    scores = {r["doc_id"]: r["score"] for r in M.score_documents(docs, M.learn(docs, labels)).collect()}
    assert scores[1] > scores[2]


def plain_score(model, passages):
    """Gated attention over one document's passages, number by number."""
    dot = lambda a, b: sum(float(p) * float(q) for p, q in zip(a, b))
    column = lambda m, k: [row[k] for row in m]
    hidden = range(len(model["b"]))
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    encoded, logits = [], []
    for x in passages:
        x = [min(8.0, max(-8.0, (float(v) - m) / s)) for v, m, s in zip(x, model["mean"], model["scale"])]
        e = [math.tanh(dot(x, column(model["W"], k)) + model["b"][k]) for k in hidden]
        gated = [math.tanh(dot(e, column(model["V"], k))) * sigmoid(dot(e, column(model["U"], k))) for k in hidden]
        encoded.append(e)
        logits.append(dot(gated, model["w"]))
    weights = [math.exp(v - max(logits)) for v in logits]
    z = [sum(w * e[k] for w, e in zip(weights, encoded)) / sum(weights) for k in hidden]
    return sigmoid(dot(z, model["c"]) + float(model["d"]))


def test_scores_match_plain_loops(spark, small, edge_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").selectExpr("doc_id", "quality AS label")
    model = M.learn(small, labels)
    docs = small.select("doc_id", "text").limit(40).unionByName(edge_docs.selectExpr("doc_id + 1000000 AS doc_id", "text"))
    want = sorted((str(r["doc_id"]), round(plain_score(model, M.bags(pa.array([r["text"]], pa.string()))[0]), 7)) for r in docs.collect())
    assert sorted((str(r["doc_id"]), round(r["score"], 7)) for r in M.score_documents(docs, model).collect()) == want
