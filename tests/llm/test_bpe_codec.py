import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lodestrata.llm import bpe_codec as B
from lodestrata.llm.registry import queries

PATH, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "Don't we'LL 're ''s 's x'sab 'Tis it's's l'été", "ÀÉÎÕÜ ÷×ßÿ ĀŁœ İi ẞ ﬁ Å Å", "été 한국어 日本語 ไทย עברית 👩‍👩‍👧", "1234 ½ ²³ ٣٤", "\x00\x1c\x85  a b\tc\r\n\n d",
    "<|endoftext|>Hi<|startoftext|><|endoftext|> <|endoftext", "", " ", "\n", "a", "'", "''", "'s", "!!!???...", "x" * 5000, "ab" * 3000 + "!" * 700, "aaaaabaaaabaaab" * 40, "é" * 900, "don" + "'" + "t" * 9,
]


def same(path, texts):
    library = Tokenizer.from_file(path)
    codec = B.Codec(path)
    got = codec.encode_column(pa.array(texts, pa.string()))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in got] == want
    assert codec.decode_rows(got) == [library.decode(x, skip_special_tokens=False) for x in want]
    return codec


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_texts_match_the_library(small, path):
    texts = [r["text"] for r in small.collect()] + HARD + [None]
    codec = same(path, texts)
    assert codec.rules.fits and codec.rules.usual == (path == PATH)
    assert 0 < codec.exact_words < codec.all_words / 2  # most words need no merging, some do


def test_random_texts_match_the_library():
    rng = random.Random(4)
    letters = "aabeinorst'  .1À" + "ééñ" + "\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0xC0, 0x24F), rng.randint(0x300, 0x36F), rng.randint(0x4E00, 0x4E20)])) for _ in range(30)) for _ in range(500)]
    same(PATH, texts)


def own_file(tmp_path, merges, suffix, name="own"):
    """A tokenizer file with these merges over the byte-level alphabet."""
    letters = B.byte_letters()
    vocab = {c: k for k, c in enumerate(letters + ([c + suffix for c in letters] if suffix else []))}
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    model = {"type": "BPE", "vocab": vocab, "merges": [list(m) for m in merges], "end_of_word_suffix": suffix or None, "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
    said = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, "post_processor": None, "decoder": None, "model": model}
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps(said))
    return str(path)


@pytest.mark.parametrize("suffix", ["", "</w>"])
def test_merges_in_any_order_match_the_library(tmp_path, suffix):
    """Merges drawn at random, many of which steal from each other: pairs, ties and tokens that merging never gives."""
    exact = 0
    for seed in range(25):
        rng = random.Random(seed)
        known, merges = list("abc") + ([c + suffix for c in "abc"] if suffix else []), []
        for _ in range(30):
            a, b = rng.choice([k for k in known if not suffix or not k.endswith(suffix)]), rng.choice(known)
            if a + b not in known:
                known.append(a + b)
                merges.append((a, b))
        texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(200)), "a" * 600, "abc" * 200]
        codec = same(own_file(tmp_path, merges, suffix, f"{seed}{len(suffix)}"), texts)
        assert codec.rules.fits
        exact += codec.exact_words
    assert exact


def test_files_that_do_not_fit_go_to_the_library(tmp_path):
    late = own_file(tmp_path, [("ab", "c"), ("a", "b")], "", "late")  # a token is used before it is made
    twice = own_file(tmp_path, [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")], "", "twice")  # two ways to one token
    for path in (late, twice):
        assert not same(path, ["abc abcabc", "", "cab"]).rules.fits
    other = json.load(open(PATH))
    other["model"]["dropout"] = 0.1
    assert not B.Rules(other).fits


def test_frames(spark, edge_docs, no_docs):
    library = Tokenizer.from_file(PATH)
    want = sorted((str(r["doc_id"]), tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in edge_docs.collect())
    coded = B.encode(edge_docs, PATH, keep=("doc_id", "value", "rep"))
    got = coded.collect()
    assert sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in got)
    back = B.decode(coded, PATH, keep=("doc_id", "ids", "n_tokens")).collect()
    assert all(r["decoded"] == library.decode(np.frombuffer(r["ids"], "<u4").tolist(), skip_special_tokens=False) for r in back)
    assert B.decode(B.encode(no_docs, PATH), PATH).count() == 0
    odd = spark.createDataFrame([(1, None), (2, b""), (3, np.array([0, 10**6, 1], "<u4").tobytes())], "doc_id long, ids binary")
    assert {r["doc_id"]: r["decoded"] for r in B.decode(odd, PATH).collect()} == {1: "", 2: "", 3: library.decode([0, 10**6, 1], skip_special_tokens=False)}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    library, want = Tokenizer.from_file(PATH), set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.add((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert {tuple(r) for r in queries()["op11_bpe_codec"](spark, sf).collect()} == want
