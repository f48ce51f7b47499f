import random
import re

import numpy as np
import pytest

from lodestrata.llm import near_dedup as N


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """component of each doc_id, by comparing all pairs."""
    sets = {}
    for k, t in rows:
        sets.setdefault(k, []).append(shingles(t))
    comp = {k: k for k in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {k: find(k) for k in ids}


def words(rng, n):
    return [f"w{rng.randrange(100000)}" for _ in range(n)]


@pytest.mark.parametrize("short, block", [(N.SMALL_LIST, N.LIST_BLOCK), (1, 3)])
def test_matches_all_pairs(spark, monkeypatch, short, block):
    monkeypatch.setattr(N, "SMALL_LIST", short)
    monkeypatch.setattr(N, "LIST_BLOCK", block)
    rng = random.Random(3)
    rows, passage = [], words(rng, 120)
    for base in range(25):
        text = words(rng, rng.choice([3, 7, 30, 80, 300]))
        for _ in range(rng.choice([1, 2, 5])):
            changed = list(text)
            for _ in range(rng.choice([0, 1, 3, 8])):
                changed[rng.randrange(len(changed))] = f"c{rng.randrange(10**6)}"
            rows.append(" ".join(changed))
    rows += [" ".join(passage + words(rng, n)) for n in (10, 20, 25, 40, 40, 60, 60, 100, 100, 300)]  # a shared passage around the limit
    chain = words(rng, 200)
    for k in range(8):  # neighbours are linked, the ends are not
        rows.append(" ".join(chain[20 * k :] + words(random.Random(k), 20 * k)))
    rng.shuffle(rows)
    rows = [(k * 3 + 1, t) for k, t in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for r in N.near_duplicates(df).collect():
        assert r["component_id"] == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])
        assert r["n_shingles"] == len(shingles(dict(rows)[r["doc_id"]]))


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = words(rng, 200)
    rows = []
    for k in range(700):
        changed = list(base)
        for _ in range(rng.randrange(1, 5)):
            changed[rng.randrange(200)] = f"x{k}"
        rows.append((k + 10, " ".join(changed)))
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in found if r["component_id"] != r["doc_id"]} == {10}
    want = brute(rows[:60])
    assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] < 70} == want


def test_many_documents_around_a_shared_passage(spark):
    rng = random.Random(9)
    passage = words(rng, 150)
    rows = [(k, " ".join(passage + words(rng, rng.choice([15, 30, 45, 60, 90])))) for k in range(150)]
    want = brute(rows)
    assert len(set(want.values())) not in (1, 150)
    assert {r["doc_id"]: r["component_id"] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want


def test_edges(edge_docs, no_docs):
    rows = N.near_duplicates(edge_docs.select("*")).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["component_id"] == 1 and by[2]["component_id"] == 2 and by[3]["n_shingles"] == 0 and by[3]["kept"]
    assert by[4]["n_shingles"] == 1 and by[6]["component_id"] == 5 and not by[6]["kept"]
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert sum(r["doc_id"] == 6 for r in rows) == 2
    assert N.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays(edge_docs):
    left = N.keep_one(edge_docs)
    assert left.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 5, 7, 8]


def test_a_doc_id_with_two_texts_joins_their_groups(spark):
    a, b = " ".join(f"a{k}" for k in range(20)), " ".join(f"b{k}" for k in range(20))
    rows = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert {r["component_id"] for r in N.near_duplicates(rows).collect()} == {1}


def test_union_estimate_is_exact_for_small_sets():
    a, b = np.array([1, 2, 3, 4], np.uint64), np.array([2, 3, 4, 5], np.uint64)
    assert N.union_estimate(a, b, 64) == 0.6
    assert not N.passes(4, 4, a, b, 64, 30) and N.passes(4, 4, a, a, 64, 30)


def test_texts_that_plain_polynomial_hashes_confuse_stay_apart(spark, twins):
    rows = [(2 * k + i, text) for k, pair in enumerate(twins) for i, text in enumerate(pair)]
    rows += [(100 + k, " ".join(["one two three four", text, "six seven"])) for k, (_, text) in enumerate(rows[:2])]
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["component_id"] == r["doc_id"] for r in found)


def test_links_are_confirmed_by_bytes(monkeypatch):
    """Even where all hashes are equal, different texts are not linked."""
    monkeypatch.setattr(N.W, "range_hash", lambda data, begin, end: np.zeros(len(begin), np.uint64))
    import pyarrow as pa

    texts = pa.array(["a b c d e f", "u v w x y z", "A b c d e f", "a b", "a c", "a b", "", None])
    left = pa.array(["a b c d e f", "a b", ""])
    got = N.similar(left, np.array([0, 0, 0, 1, 1, 1, 2, 2]), texts)
    assert got == [True, False, True, True, False, True, False, False]


def test_exact_sets_match_brute_force(small):
    import pyarrow as pa

    texts = [r["text"] for r in small.collect()]
    sets = N.exact_sets(pa.array(texts))
    want = [shingles(t) for t in texts]
    assert [len(x) for x in sets] == [len(x) for x in want]
    for k in range(1, len(texts)):
        assert len(np.intersect1d(sets[k - 1], sets[k])) == len(want[k - 1] & want[k])


def test_words_made_to_collide_make_no_class(spark):
    """Words of 16 printable bytes whose second half undoes the difference of the first under ``range_hash``: equal hashes, no word in common."""
    rng, one, two = random.Random(8), [], []
    with np.errstate(over="ignore"):
        state = N.W.mix(np.array([16], np.uint64) * N.W._STEPS[0] + N.W._STEPS[1])
    printable = lambda b: all(0x21 <= x < 0x7F for x in b)
    while len(one) < 20:
        a, b = (bytes(rng.randrange(0x61, 0x7B) for _ in range(8)) for _ in range(2))
        gap = (N.W.mix(state ^ np.frombuffer(a, "<u8")) ^ N.W.mix(state ^ np.frombuffer(b, "<u8"))).tobytes()
        if max(gap) >= 0x80:
            continue
        c = bytes(next((x for x in rng.sample(range(0x21, 0x7F), 94) if 0x21 <= x ^ g < 0x7F and not {x, x ^ g} & set(range(0x41, 0x5B))), 0) for g in gap)
        d = bytes(x ^ g for x, g in zip(c, gap))
        if printable(c) and printable(d):
            one.append((a + c).decode())
            two.append((b + d).decode())
    data = np.frombuffer("".join(one + two).encode(), np.uint8)
    at = np.arange(40) * 16
    hashes = N.W.range_hash(data, at, at + 16)
    assert (hashes[:20] == hashes[20:]).all() and not set(one) & set(two)
    got = {r["doc_id"]: r for r in N.near_duplicates(spark.createDataFrame([(1, " ".join(one)), (2, " ".join(two))], "doc_id long, text string")).collect()}
    assert got[1]["component_id"] == 1 and got[2]["component_id"] == 2 and got[1]["kept"] and got[2]["kept"]
