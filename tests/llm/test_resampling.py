import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from lodestrata.llm import resampling as R
from lodestrata.llm.registry import queries


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text, n=2):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, share=25, least=20, seed=7, n=2, buckets=10_000):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows, by the definition."""
    counts = []
    for texts in ([t for _, t in docs], target):
        c = [0] * buckets
        for t in texts:
            for f in features(t, n):
                c[zlib.crc32(f.encode()) % buckets] += 1
        counts.append(c)
    s, t = counts
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        f = features(text, n)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    rows.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn, place, out = share * sum(r[4] >= least for r in rows) // 100, 0, []
    for r in rows:
        place += r[4] >= least
        out.append((*r[:4], place if r[4] >= least and place <= drawn else None))
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_checksums_of_ranges_and_runs():
    rng = random.Random(1)
    parts = [bytes(rng.choice(b"abc\xc3\xa9xyz") for _ in range(rng.choice([1, 2, 5, 63, 64, 65, 300]))) for _ in range(60)]
    data = np.frombuffer(b" ".join(parts), np.uint8)
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size + 1) - size - 1
    one = R.crc_ranges(data, begin, begin + size)
    assert one.tolist() == [zlib.crc32(p) for p in parts]
    two = R.join_crc(one[:-1], one[1:], size[1:], data, begin[1:])
    assert two.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(parts, parts[1:])]


@pytest.mark.parametrize("n", [1, 2, 4])
def test_chunks_own_every_feature_once(n):
    rng = random.Random(n)
    for size in (1, 7, 50, 10_000):
        text = " ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 60))).encode()
        found = []
        for own, piece in R.chunks(np.frombuffer(text, np.uint8), size, n):
            raw = np.frombuffer(piece, np.uint8)
            found += R.buckets_of(raw, np.array([0, len(raw)]), np.array([own]), n, 10_000)[0].tolist()
        assert sorted(found) == sorted(zlib.crc32(f.encode()) % 10_000 for f in features(text.decode(), n))


@pytest.mark.parametrize("chunk_bytes", [64, 1 << 16])
def test_matches_brute_force(spark, small, edge_docs, chunk_bytes):
    docs = [(r["doc_id"], r["text"]) for r in small.limit(150).collect()] + [(10**6 + r["doc_id"] if r["doc_id"] else None, r["text"]) for r in edge_docs.collect()]
    docs += [(5_000_000 + k, " ".join(f"w{i % (k + 3)}" for i in range(30))) for k in range(30)] + [docs[3], docs[3]]
    target = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()] + [None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = R.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), chunk_bytes=chunk_bytes).collect()
    assert key(got) == key(brute(docs, target))


def test_edges(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert key(R.resample(edge_docs, no_docs, share=50, least_words=2).collect()) == key(brute(docs, [], 50, 2))
    assert R.resample(no_docs, edge_docs).count() == 0
    clash = edge_docs.withColumnRenamed("value", "score").withColumnRenamed("n", "bucket").withColumnRenamed("rep", "part")
    assert key(R.resample(clash, edge_docs).collect()) == key(brute(docs, [t for _, t in docs]))
    three = R.importance(edge_docs, no_docs, n=3, buckets=97, chunk_bytes=100)
    assert sorted(r["n_features"] for r in three.collect()) == sorted(len(features(t, 3)) for _, t in docs)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs, target = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert key(queries()["op12_resampling"](spark, sf).collect()) == key(brute(docs, [t for _, t in target]))
