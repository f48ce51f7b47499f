import random
from collections import Counter

import corpus_pipeline as P
from pyspark.sql import functions as F

from lodestrata.llm import language_id, mixing, near_dedup, quality_rules
from lodestrata.llm.registry import queries


def test_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = P.language(spark, docs, sf)
    model = language_id.model(language_id.learn(docs))
    want = {r["doc_id"] for r in language_id.predict(docs, model).collect() if r["lang_pred"] != "und" and r["score"] >= P.LEAST_LANGUAGE_SCORE}
    assert {r["doc_id"] for r in kept.collect()} == want
    good = P.quality(spark, kept, sf)
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in quality_rules.measure_quality(kept).collect() if r["kept"]}
    one = P.dedup(spark, good, sf)
    assert {r["doc_id"] for r in one.collect()} == {r["doc_id"] for r in near_dedup.near_duplicates(good).collect() if r["kept"]}
    mixed = P.mix(spark, one, sf)
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in mixing.mix(one).collect() if r["copies"]})
    assert kept.columns == good.columns == one.columns == mixed.columns == docs.columns
    packed = Counter(r["doc_id"] for r in P.pack(spark, mixed, sf).where("piece = 0").collect())
    assert packed == copies


def test_run_and_registry(spark):
    assert [name for name, _ in P.STAGES] == ["language_id", "quality_rules", "near_dedup", "mixing", "packing"]
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
    assert {k.split("_")[0] for k in queries()} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def test_texts_in_scripts_not_learned_go_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng = random.Random(5)
    letters = ["".join(map(chr, range(lo, hi))) for lo, hi in ((0x10D0, 0x10F1), (0x0E01, 0x0E2F), (0xAC00, 0xAC80), (0x0430, 0x0450), (0x4E00, 0x4E80))]
    planted = [(10**9 + k, " ".join("".join(rng.choices(letters[k % 5], k=rng.randint(3, 8))) for _ in range(120))) for k in range(100)]
    foreign = spark.createDataFrame(planted, "doc_id long, text string")
    kept = {r["doc_id"] for r in P.language(spark, docs.unionByName(foreign, allowMissingColumns=True), sf).select("doc_id").collect()}
    print("foreign kept", len([k for k in kept if k >= 10**9]))
    assert len([k for k in kept if k >= 10**9]) <= 2
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").join(docs, "doc_id").select("doc_id").collect()}
    assert good and good <= kept


def fixture_rows():
    """Documents of three made-up languages with junk, copies, near copies, short texts, foreign scripts, nulls and repeated rows."""
    rng = random.Random(11)
    speech = {x: [f"{a}{b}{c}" for a in starts for b in "aeiou" for c in ends] for x, starts, ends in (("xa", "bdgkm", "lnr"), ("xb", "pstvz", "kmx"), ("xc", "fhjqw", "bdg"))}
    rows, k = [], 0
    for lang, words in speech.items():
        for n in (60, 80, 120, 200, 400) * 3:
            text = " ".join(rng.choice(words) for _ in range(n))
            rows.append((k, text, lang, rng.choice(["a", "b", None]), "x"))
            if n == 120:
                near = text.split()
                near[rng.randrange(n)] = "other"
                rows += [(k + 1, text, lang, "a", "x"), (k + 2, " ".join(near), lang, "b", "x")]
            k += 5
    rows.append((900, "short text here", "xa", "a", "x"))
    rows.append((901, "same words again " * 40, "xa", "a", "x"))
    rows.append((902, " ".join("".join(rng.choice("\u10d0\u10d1\u10d2\u10d3\u10d4") for _ in range(5)) for _ in range(80)), None, "a", "x"))
    rows += [(903, None, "xa", "a", "x"), (904, "", None, None, None), (905, "12 34 " * 40, "xb", "b", "x"), (rows[0][0], rows[0][1], rows[0][2], rows[0][3], "y")]
    return rows


def test_run_matches_brute_force(spark, tmp_path):
    import re

    import numpy as np
    from test_language_id import plain_vector
    from test_mixing import brute_targets
    from test_near_dedup import brute as components
    from test_quality_rules import brute as base
    from test_quality_rules import coverage

    rows = fixture_rows()
    kind = "doc_id long, text string, lang string, source string, value string"
    spark.createDataFrame(rows, kind).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    # language: cosine with prototypes of all labelled texts, floor by noise
    unit = [plain_vector(t) if t else np.zeros(language_id.DIMENSIONS) for _, t, *_ in rows]
    unit = [v / np.linalg.norm(v) if v.any() and any(c.isalpha() for c in rows[k][1]) else None for k, v in enumerate(unit)]
    table = np.stack([sum(u for u, r in zip(unit, rows) if u is not None and r[2] == x) for x in ("xa", "xb", "xc")])
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    score = [None if u is None else round(float((table @ u).max()), 6) for u in unit]
    floor = P.LEAST_LANGUAGE_SCORE
    kept = [r for s, r in zip(score, rows) if s is not None and s >= floor]
    assert len(kept) < len(rows) and 902 not in [r[0] for r in kept]
    # quality
    limits = quality_rules.LIMITS
    good = []
    for r in kept:
        *_, failed = base(r[1])
        lines = [x for x in r[1].split("\n") if x.strip()]
        twice = sum(len(re.sub(r"\s", "", x)) for k, x in enumerate(lines) if x in lines[:k]) / max(1, len(re.sub(r"\s", "", r[1])))
        if not failed and all(coverage(r[1], k) <= limits[k] for k in quality_rules.LENGTHS) and twice <= limits["lines"]:
            good.append(r)
    assert 0 < len(good) < len(kept)
    # near duplicates: the smallest id of each group, one row of it
    comp = components([(r[0], r[1]) for r in good])
    one = {r[0]: r for r in good if comp[r[0]] == r[0]}
    assert len(one) < len(good)
    # mixing and packing: targets, words taken, whole documents in pieces, bins that hold what they say
    words = {k: len(r[1].split()) for k, r in one.items()}
    sources = sorted({r[3] for r in one.values()}, key=lambda s: (s is None, s or ""))
    sizes = [(s, sum(words[k] for k, r in one.items() if r[3] == s)) for s in sources]
    got = P.run(spark, str(tmp_path)).collect()
    copies = Counter(r["doc_id"] for r in got if r["piece"] == 0)
    assert set(copies) <= set(one) and max(copies.values()) <= 2
    for (s, _), target in zip(sizes, brute_targets(sizes)):
        taken = sum(n * words[k] for k, n in copies.items() if one[k][3] == s)
        assert abs(taken - target) < max(words[k] for k, r in one.items() if r[3] == s)
    bins = {}
    for r in got:
        bins.setdefault(r["bin_id"], []).append(r)
        assert r["source"] == one[r["doc_id"]][3]
    assert Counter((r["doc_id"], r["start_word"]) for r in got) == Counter({(k, 0): n for k, n in copies.items()})
    assert all(sum(r["n_words"] for r in held) <= 2048 and len({r["doc_id"] for r in held}) == len(held) for held in bins.values())


def test_every_stage_takes_the_edge_cases(spark, edge_docs, no_docs):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns, no rows."""
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES:
            found = stage(spark, docs, "unused")
            rows = found.collect()
            assert name == "packing" or found.columns == docs.columns
            assert docs is edge_docs or not rows
