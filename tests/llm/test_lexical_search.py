import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lodestrata.llm import lexical_search as S
from lodestrata.llm.registry import queries


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text) rows, by the definition."""
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n, length = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, size in held:
            m = 75 + (25 * size * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert key(queries()["op13_lexical_search"](spark, sf).collect()) == key(brute(docs, items))


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_bands_stop_early_and_lose_nothing(block, monkeypatch):
    """Blocks of any size, ties, repeated query terms; the search ends early at times, and never with another result."""
    monkeypatch.setattr(S, "BLOCK_DOCS", block)
    rng = random.Random(block)
    early = 0
    for _ in range(60):
        n_docs, n_terms, k = rng.randint(1, 60), rng.randint(1, 12), rng.randint(1, 6)
        rows = [sorted(rng.sample(range(n_terms), rng.randint(0, n_terms))) for _ in range(n_docs)]
        impact = [[rng.choice([1, 2, 3, 50, 900, 10**6, rng.randint(1, 10**6)]) for _ in r] for r in rows]
        ids = rng.sample(range(1000), n_docs)
        query = {t: rng.randint(1, 3) for t in rng.sample(range(n_terms), rng.randint(1, n_terms))}
        want = sorted((-sum(query.get(t, 0) * i for t, i in zip(r, x)), d) for d, r, x in zip(ids, rows, impact))
        want = [(d, -s) for s, d in want if s < 0][:k]
        have, score, mult = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n_terms, np.int64)
        for lo in range(0, n_docs, block):
            part, gains = rows[lo : lo + block], impact[lo : lo + block]
            ptr = np.cumsum([0, *map(len, part)])
            some = np.array(ids[lo : lo + block])
            held = S.Block(some, ptr, np.array([t for r in part for t in r], np.int64), np.array([i for x in gains for i in x], np.int64), n_terms)
            found, more = held.best(np.array([*query]), np.array([*query.values()]), k, int(score[-1]) if len(score) == k else 0, mult)
            early += int(held.sums.sum()) < sum(query.get(t, 0) * i for r, x in zip(part, gains) for t, i in zip(r, x))
            have, score = np.concatenate((have, some[found])), np.concatenate((score, more))
            order = S.merged(have, score, k)
            have, score = have[order], score[order]
            assert not mult.any()
        assert list(zip(have.tolist(), score.tolist())) == want
    assert early > 5


def test_edges(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    items = [(1, "One TWO, two! wörd"), (2, None), (3, "... "), (4, "nothing here"), (1, "six six"), (1, "six six"), (None, "日本 語")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = key(brute(docs, items, 3))
    assert want and key(S.search(edge_docs, asked, k=3).collect()) == want
    assert key(S.search(edge_docs, asked, k=3, query_bytes=10).collect()) == want  # several blocks of queries
    clash = edge_docs.withColumnRenamed("value", "score").withColumnRenamed("n", "item").withColumnRenamed("rep", "rank")
    assert key(S.search(clash, asked.withColumn("doc_id", asked.item_id), k=3).collect()) == want
    for some, some_items in ((no_docs, asked), (edge_docs, asked.limit(0)), (no_docs, asked.limit(0))):
        assert S.search(some, some_items).count() == 0


def test_whole_numbers_beyond_64_bits():
    tf, n = np.array([3, 1]), np.array([10**9, 5])
    got = S.impacts(np.array([7, 9]), tf, n, 10**12, 10**15)
    want = [w * ((1_000_000_000 * t) // (1000 * t + 12 * (75 + (25 * k * 10**12) // 10**15))) for w, t, k in ((7, 3, 10**9), (9, 1, 5))]
    assert got.tolist() == want
