from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from lodestrata.llm import near_dedup, registry
from lodestrata.llm import packing as P


def test_bins_hold_what_they_say(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = P.pack(docs, capacity=1000, group=500).collect()
    words = {r["doc_id"]: r["n"] for r in docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).alias("n")).collect()}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start_word"], r["n_words"]))
        bins[r["bin_id"]].append(r)
    for k, n in words.items():
        at = 0
        for start, size in sorted(pieces[k]):
            assert start == at and size <= 1000
            at += size
        assert at == n
    for held in bins.values():
        assert sum(r["n_words"] for r in held) <= 1000
        assert len({r["cluster"] for r in held}) == len(held)
        at = 0
        for r in sorted(held, key=lambda r: (r["bin_offset"], r["n_words"])):
            assert r["bin_offset"] == at
            at += r["n_words"]
    assert sum(words.values()) / (len(bins) * 1000) > 0.7


def brute_place(bins, capacity, size, source, cluster):
    """The tightest bin without conflict, by looking at all."""
    for bits in ((source, cluster), (0, cluster)):
        fit = [(room, k) for k, (room, s, c) in enumerate(bins) if room >= size and not (s & bits[0]) and not (c & bits[1])]
        if fit:
            return min(fit)[0]
    return None


def test_successor_search_is_best_fit():
    rng = np.random.default_rng(2)
    bins, state, of = P.Bins(100), [], {}
    for _ in range(400):
        size, source, cluster = int(rng.integers(1, 60)), 1 << int(rng.integers(0, 4)), 1 << int(rng.integers(0, 30))
        want = brute_place(state, 100, size, source, cluster)
        name, offset = bins.place(size, source, cluster)
        if name not in of:
            assert want is None
            of[name] = len(state)
            state.append((100 - size, source, cluster))
        else:
            room, s, c = state[of[name]]
            assert room == want and offset == 100 - room and not c & cluster
            state[of[name]] = (room - size, s | source, c | cluster)


def test_edges(edge_docs, no_docs):
    rows = P.pack(edge_docs, capacity=100).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in edge_docs.collect()}
    assert len({r["bin_id"] for r in rows if r["doc_id"] == 6}) == 2
    assert P.pack(no_docs).count() == 0


def test_short_pieces_fill_their_bins(spark):
    """3,000 different texts of 10 words, one source: only room, no shared bit, closes a bin."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source", "concat(repeat('w ', 9), 'x', id) AS text")
    bins = {r["bin_id"]: r["n"] for r in P.pack(docs).groupBy("bin_id").agg(F.count("*").alias("n")).collect()}
    assert sum(bins.values()) == 3000 and len(bins) == -(-3000 // (P.CAPACITY // 10))


def test_near_copies_never_share_a_bin(spark):
    sf = "/root/testdata/sf0.001"
    near = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    bins = defaultdict(list)
    for r in registry.op9_packing(spark, sf).collect():
        bins[r["bin_id"]].append(near[r["doc_id"]])
    assert len(near) > len(set(near.values())) and all(len(set(held)) == len(held) for held in bins.values())


def test_near_clusters_join_equal_texts(spark, edge_docs, no_docs):
    words = [f"w{k}" for k in range(60)]
    one, two = " ".join(words), " ".join([*words[:59], "x"])
    rows = [(1, one, "a"), (2, two, "a"), (3, two.upper(), "b"), (None, one, "b"), (4, "ÉTÉ", "a"), (5, "été", "a"), (6, "other", "a"), (7, "", "a"), (8, " ", "a"), (9, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    packed = P.pack(docs, near=P.near_clusters(docs)).collect()
    of = {r["doc_id"]: r["cluster"] for r in packed}
    assert len(packed) == len(rows) and of[1] == of[2] == of[3] == of[None] and of[4] == of[5] and of[7] == of[8] and of[9] is None
    assert len({of[k] for k in (1, 4, 6, 7)}) == 4
    assert P.pack(edge_docs, near=P.near_clusters(edge_docs)).count() == P.pack(edge_docs).count()
    assert P.pack(no_docs, near=P.near_clusters(no_docs)).count() == 0


def test_groups_come_from_pieces(spark):
    """A few very long texts are as many groups as their pieces need."""
    docs = spark.createDataFrame([(k, "s", f"x{k} " * 5000) for k in range(4)], "doc_id long, source string, text string")
    rows = P.pack(docs, capacity=10, group=100).collect()
    assert len(rows) == 2000 and len({r["bin_id"].split("-")[0] for r in rows}) == 20


def test_measured_words_and_clusters(spark, edge_docs):
    texts = ["", " ", None, "a b", "A  b\n", "b a", "ab", "É x", "é\tX", "a b c"]
    got = {r["doc_id"]: r for r in P.measured(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'s' AS source")).collect()}
    assert [got[k]["words"] for k in range(10)] == [0, 0, 0, 2, 2, 2, 1, 2, 2, 3]
    c = [got[k]["cluster"] for k in range(10)]
    assert c[2] is None and c[0] == c[1] and c[3] == c[4] and c[7] == c[8] and len({*c}) == 7
    assert P.measured(edge_docs).count() == edge_docs.count()
