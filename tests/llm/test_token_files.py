import os
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lodestrata.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_round_trip_matches_the_library(small):
    segments = T.write_tokens(small, PATH, ranges=5)
    got = sorted(tuple(r) for r in T.read_tokens(segments).collect())
    assert got == sorted(brute([(r["doc_id"], r["text"]) for r in small.collect()]))


def test_edges(edge_docs, no_docs):
    got = [tuple(r) for r in T.read_tokens(T.write_tokens(edge_docs, PATH, ranges=3)).collect()]
    key = lambda r: (r[0] is not None, r)
    assert sorted(got, key=key) == sorted(brute([(r["doc_id"], r["text"]) for r in edge_docs.collect()]), key=key)
    assert T.read_tokens(T.write_tokens(no_docs, PATH)).count() == 0


def test_blocks_with_outliers():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1023, 1024, 5000):
        ids = rng.integers(0, 300, n).astype(np.uint32)
        ids[rng.random(n) < 0.02] = 4_000_000_000
        back, docs, sizes = T.decode_segment(T.encode_segment(ids, [5, None], [n, 0]))
        assert np.array_equal(back, ids) and docs == [5, None] and sizes == [n, 0]


def test_files_on_disk(small, tmp_path):
    made = T.export_files(T.write_tokens(small, PATH, ranges=2), str(tmp_path)).collect()
    assert sum(os.path.getsize(r["path"]) for r in made) == sum(r["n_bytes"] for r in made)
    docs = [d for r in made for d in T.decode_segment(open(r["path"], "rb").read())[1]]
    assert sorted(docs) == sorted(r["doc_id"] for r in small.collect())


def test_files_of_several_segments_read_back(spark, small, edge_docs, twins, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "FILE_SEGMENTS", 3)
    rows = [(r["doc_id"], r["text"]) for r in small.collect()] + [(10**6 + 2 * k + i, t) for k, pair in enumerate(twins) for i, t in enumerate(pair)] + [(-5, ""), (-4, None), (-3, "\n"), (-2, "a" * 300000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    T.write_files(T.write_tokens(docs, PATH, ranges=4), f"{tmp_path}/f")
    assert sorted(tuple(r) for r in T.read_tokens(T.read_files(spark, f"{tmp_path}/f")).collect()) == sorted(brute(rows))
    assert sorted(tuple(r) for r in T.read_token_files(spark, f"{tmp_path}/f").collect()) == sorted(brute(rows))


def test_segments_of_a_file():
    images = [T.encode_segment(np.arange(n, dtype=np.uint32), [n], [n], 1, n, 0) for n in (0, 3, 2000)]
    assert [bytes(x) for x in T.segments_of(b"".join(x + b"\n" for x in images))] == images


def test_any_tokenizer_file(spark, tmp_path):
    """Files that are no plain byte-level BPE encode texts whole; pieces that differ in their bytes are never taken for each other."""
    other = public_tokenizers.path("word_bpe_49k.json")
    assert T.PieceEncoder(PATH).piecewise and not T.PieceEncoder(other).piecewise
    rows = [(k, t) for k, t in enumerate(["Hello World", "It's  2 <|endoftext|>", "", None, "ünï"])]
    tokenizer = Tokenizer.from_file(other)
    want = {k: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in rows}
    got = T.read_tokens(T.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), other, ranges=2)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want


def test_memory_that_starts_anew(small, monkeypatch):
    import pyarrow as pa

    texts = [r["text"] for r in small.collect()]
    monkeypatch.setattr(T.PieceEncoder, "LIMIT", 50)
    tokenizer = Tokenizer.from_file(PATH)
    got = T.PieceEncoder(PATH).encode_column(pa.array(texts))
    assert all(x.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids for x, t in zip(got, texts, strict=True))


def test_pieces_of_one_hash_are_told_apart(small, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(T.W, "range_hash", lambda data, begin, end: ((end - begin) % 3).astype(np.uint64))
    texts, tokenizer = [r["text"] for r in small.collect()][:40] + ["a b", "a c", "", None], Tokenizer.from_file(PATH)
    got = T.PieceEncoder(PATH).encode_column(pa.array(texts))
    assert all(x.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids for x, t in zip(got, texts, strict=True))
