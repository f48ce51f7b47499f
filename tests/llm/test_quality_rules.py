import random
import re
from collections import Counter

import pytest

from lodestrata.llm import quality_rules as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    hit = {i for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for i in range(k, k + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    base = n < 50 or 100 * len(hit) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), base


def coverage(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    hit = {i for k in range(len(words) - n + 1) if grams[tuple(words[k : k + n])] > 1 for i in range(k, k + n)}
    return sum(len(words[i]) for i in hit) / max(1, sum(map(len, words)))


def test_counts_match_brute_force(small):
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    for r in Q.measure_quality(small).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == brute(texts[r["doc_id"]]), r["doc_id"]
        for n in Q.LENGTHS:
            assert abs(r[f"dup_{n}gram_share"] - coverage(texts[r["doc_id"]], n)) < 1e-9


def test_clean_documents_stay_and_junk_has_its_own_column(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    found = Q.measure_quality(small).join(labels, "doc_id").where("n_words >= 50").selectExpr("quality", "cast(kept as int) as k", "cast(kept and not symbols_failed as int) as s").groupBy("quality").avg("k", "s").collect()
    shares = {r["quality"]: r for r in found}
    assert shares[1]["avg(k)"] == shares[1]["avg(s)"] == 1.0 and shares[0]["avg(s)"] < 0.2


@pytest.mark.parametrize("share", [0.1, 0.16, 0.22, 0.28, 0.34])
def test_planted_repetition_is_judged_by_its_share(spark, share):
    """A passage that stands twice, of 10 words or more, on this share of 400 words of equal length."""
    rng = random.Random(int(100 * share))
    words = [f"w{k:06d}" for k in rng.sample(range(10**6), 400)]
    again = int(200 * share)
    words[300 : 300 + again] = words[:again]
    r = Q.measure_quality(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()[0]
    assert abs(r["dup_10gram_share"] - 2 * again / 400) < 1e-9 and not r["base_failed"] and r["kept"] == (2 * again / 400 <= Q.LIMITS[10])


def test_edges(edge_docs, no_docs):
    rows = Q.measure_quality(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[7]["n_words"] == 15000 and by[7]["base_failed"]
    assert Q.measure_quality(no_docs).count() == 0
    assert Q.filter_quality(edge_docs).columns == edge_docs.columns


def test_different_lines_and_words_are_never_equal(spark, twins):
    rows = [(k, f"{a}\n{b}\n{a} {b}") for k, (a, b) in enumerate(twins)]
    for r in Q.measure_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r["n_dup_lines"] == 0 and r["n_words"] == 4 and r["n_repeat_words"] == 0


def test_coverage_rejects_what_base_leaves(spark):
    """A passage of 10 words or more that stands twice, or a line that does, on less than half of the words."""
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    again, line = words(42), words(30)
    rows = [(1, f"{again} {words(110)} {again}"), (2, f"{line}\n{words(50)}\n{line}"), (3, words(200)), (4, f"{words(8)}\n" * 2 + words(180))]
    got = {r["doc_id"]: r for r in Q.measure_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not got[1]["base_failed"] and not got[1]["kept"] and 0.3 < got[1]["dup_10gram_share"] < 0.5
    assert got[2]["dup_line_share"] > 0.25 and not got[2]["kept"]
    assert got[3]["kept"] and got[4]["kept"]
