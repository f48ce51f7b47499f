from pyspark.sql import functions as F

from lodestrata.llm import language_id as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = L.model(L.learn(docs.where(~held)))
    assert model[0] == ["de", "en", "es", "fr"]
    found = L.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held)
    r = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r["a"] > 0.97 and r["lo"] >= 0 and r["hi"] <= 1


def test_edges(edge_docs, no_docs):
    model = L.model(L.learn(edge_docs))
    by = {r["doc_id"]: r for r in L.predict(edge_docs, model).collect()}
    assert [by[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and by[1]["score"] == 0
    assert by[7]["lang_pred"] == "de" and by[5]["lang_pred"] == "en"
    none = L.model(L.learn(no_docs))
    assert none[0] == [] and {r["lang_pred"] for r in L.predict(edge_docs, none).collect()} == {"und"}
    assert L.predict(no_docs, model).count() == 0
    kept = L.filter_language(edge_docs, model, 0.05)
    assert kept.columns == edge_docs.columns and 1 not in [r["doc_id"] for r in kept.collect()]


def test_long_texts_equal_their_parts():
    long = "ab cd " * (L.CHUNK_CHARS // 4)
    whole, _ = L.encode(L.Encoder(), [long])
    short, _ = L.encode(L.Encoder(), ["ab cd " * 500])
    assert float(whole[0] @ short[0]) > 0.999


def plain_vector(text):
    """The bundle of a text, by a plain loop over its symbols."""
    import numpy as np

    symbols = [" "]
    for c in text.lower() + " ":
        if c.isalpha():
            symbols.append(c)
        elif symbols[-1] != " ":
            symbols.append(" ")
    drawn = {c: np.random.default_rng([L.SEED, 0 if c == " " else ord(c)]).integers(0, 2, L.DIMENSIONS) * 2 - 1 for c in set(symbols)}
    out = np.zeros(L.DIMENSIONS)
    for k in range(len(symbols) - L.ORDER + 1):
        out += np.prod([np.roll(drawn[c], j) for j, c in enumerate(symbols[k : k + L.ORDER])], axis=0)
    return out


def test_vectors_equal_a_plain_loop(monkeypatch):
    """Many texts at once, long texts in chunks of any size, few or many n-grams at once: always the same whole numbers."""
    import random

    import numpy as np

    rng = random.Random(2)
    letters = "abc dé ß,.  \nΣÜ" + "".join(map(chr, range(0x4E00, 0x4E40)))
    texts = ["".join(rng.choices(letters, k=n)) for n in (0, 1, 2, 3, 50, 500, 3000)] + ["   ", "a", " a  b ", "...x"]
    want = np.stack([plain_vector(t) for t in texts])
    assert np.array_equal(L.Encoder().vectors(texts)[0], want)
    monkeypatch.setattr(L, "GRAMS", 7)
    monkeypatch.setattr(L, "DIRECT", 10)
    assert np.array_equal(L.Encoder().vectors(texts)[0], want)
    for chunk in (1, 2, 3, 10, 64, 499, 500, 10000):
        monkeypatch.setattr(L, "CHUNK_CHARS", chunk)
        encoder = L.Encoder()
        assert all(np.array_equal(encoder.long_vector(t)[0], v) for t, v in zip(texts, want, strict=True)), chunk


def test_predictions_match_brute_force(small):
    import numpy as np

    rows = [r for r in small.collect() if r["text"]]
    unit = {r["doc_id"]: plain_vector(r["text"]) for r in rows}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items() if v.any()}
    names = sorted({r["lang"] for r in rows if r["lang"]})
    table = np.stack([sum(unit[r["doc_id"]] for r in rows if r["lang"] == x and r["doc_id"] in unit) for x in names])
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    for r in L.predict(small, L.model(L.learn(small))).collect():
        if r["doc_id"] in unit:
            cosine = table @ unit[r["doc_id"]]
            assert r["lang_pred"] == names[int(cosine.argmax())] and abs(r["score"] - max(0.0, cosine.max())) < 1e-5
        else:
            assert r["lang_pred"] == "und"
