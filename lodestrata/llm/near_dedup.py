"""MinHash near-duplicates with bottom-k sketches from one hash function.

A document's set holds its distinct 5-word shingles (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``); with
fewer words, the whole sequence is the one shingle. Two documents are linked when
100 * |A and B| >= 75 * |A or B|. Candidates come from 64-bit hashes of shingles; links are confirmed on the full
sets of the two texts, by their bytes and not by hashes.

1. Texts of the same words in the same order (A-Z lower-cased) are one class, named by its smallest doc_id; only that
   document goes on. A class is known by a 128-bit keyed blake2b of its words, never by hashes of shingles; equal sets of
   other word orders are linked like all near copies. (``n_shingles`` counts different 64-bit hashes of shingles.)
2. A class's sketch is the ``k`` smallest hashes of its set. Linked sets share at least
   ``least`` of them (chance of a miss below 1e-6 a link at a similarity of exactly 0.75; sets below k hashes
   are their own sketch and miss nothing). So of the sketch, ordered by rarity in the corpus, all but the last
   least - 1 values are retained: a passage that many documents share falls at the end and out of the lists.
   Rarity comes from a table of ``BUCKETS`` counters over all sketches, whose size is fixed.
3. ``FIRST``: inverted lists of retained values generate overlaps. Each list links its members to its
   smallest document; the estimate from the union of two sketches filters, the exact Jaccard
   verifies, and components grow.
4. Lists that still hold several components: in lists of up to ``SMALL_LIST`` members, each pair of
   members in different components goes through the same filters. Longer lists are gone through in
   blocks, with sketches of size ``FINER`` (for most texts the whole set). There each document first meets the
   likeliest partner in every other component; what is still apart is then held against
   all members of other components, each pair in the first list that it shares. Pairs within a
   component need no look, so a group of n copies costs n checks and not n squared.
5. Components of all verified links give the result.

Defined cases: a null, empty or blank text has an empty set and is linked with nothing (it is its own
component); rows that repeat a doc_id are one document, all returned; a null doc_id takes no part and gets
a null component and ``kept`` true; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm import wordhash as W
from lodestrata.llm.components import components
from lodestrata.llm.memory import lean, small
from lodestrata.llm.storage import Workspace

SHINGLE, BUCKETS, COUNT_CHUNK = 5, 1 << 18, 1 << 12
FIRST, FINER = (64, 30), (384, 243)
"""(k, least) of sketches: least lies 5.3 standard deviations below 0.75 k."""
LIKE, OF = 75, 100
SMALL_LIST, LIST_BLOCK, COMMON = 64, 3072, 64
VERIFY_BYTES, CROSS_ROWS = 1 << 20, 512
"""Texts verified at once, in bytes, and rows of a block held against all of it at once: they bound a task's memory."""
BROADCAST_IDS = 500_000
"""Up to so many ids, documents are picked by a broadcast set of them; beyond it, by a shuffled join."""


def shingle_sets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, bytes]]:
    """(sorted distinct shingle hashes, 16-byte key of the words in order) of each row of a slice of bytes."""
    data = W.LOWER[data]
    text = data.tobytes()
    begin, end, row = W.spans(W.SPACE[data], starts, ends)
    words = W.range_hash(data, begin, end)
    every = W.grams(words, SHINGLE)
    count = np.bincount(row, minlength=len(starts)) if len(row) else np.zeros(len(starts), np.int64)
    first = np.cumsum(count) - count
    out = []
    for at, n, lo, hi in zip(first.tolist(), count.tolist(), starts.tolist(), ends.tolist(), strict=True):
        if n >= SHINGLE:
            found = np.unique(every[at : at + n - SHINGLE + 1])
        elif n:
            found = W.grams(words[at : at + n], n)
        else:
            found = np.zeros(0, np.uint64)
        out.append((found, hashlib.blake2b(b" ".join(text[lo:hi].split()), digest_size=16, key=W.KEY).digest()))
    return out


def sets_of(column: pa.Array) -> list[tuple[np.ndarray, bytes]]:
    raw, offsets = W.buffers(column)
    out: list[tuple[np.ndarray, bytes]] = []
    for lo, hi in W.slices(offsets):
        at = offsets[lo : hi + 1] - offsets[lo]
        out += shingle_sets(raw[offsets[lo] : offsets[hi]], at[:-1], at[1:])
    return out


def exact_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingles of each row, as numbers that are equal where the words are, byte for byte."""
    raw, offsets = W.buffers(column)
    data = W.LOWER[raw[offsets[0] : offsets[-1]]]
    at = offsets - offsets[0]
    begin, end, row = W.spans(W.SPACE[data], at[:-1], at[1:])
    words = W.codes(data, begin, end)
    every = W.exact_grams(words, SHINGLE)
    count = np.bincount(row, minlength=len(column)) if len(row) else np.zeros(len(column), np.int64)
    first, short, out = np.cumsum(count) - count, {}, []
    for k, n in zip(first.tolist(), count.tolist(), strict=True):
        if n >= SHINGLE:
            out.append(np.unique(every[k : k + n - SHINGLE + 1]))
        else:
            whole = tuple(words[k : k + n].tolist())
            out.append(np.array([-1 - short.setdefault(whole, len(short))] if n else [], np.int64))
    return out


def sketch_columns(column: pa.Array, k: int = FIRST[0]) -> list[pa.Array]:
    """Size of the set, its key in two halves, and the sketch of each text."""
    found = sets_of(column)
    keys = np.frombuffer(b"".join(key for _, key in found), np.int64).reshape(len(found), 2)
    return [pa.array([len(x) for x, _ in found], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([x[:k].tobytes() for x, _ in found], pa.binary())]


@lean
def _sketched(batches, k: int = FIRST[0]):
    for batch in small(batches, 1024):
        yield pa.RecordBatch.from_arrays([batch.column(0), *sketch_columns(batch.column(1), k)], [x.split()[0] for x in SKETCHED.split(", ")])


SKETCHED = "doc_id long, n long, key1 long, key2 long, sketch binary"


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all values, offsets) of a column of sketches."""
    if not len(column):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].copy() if data is not None else np.zeros(0, np.uint8)
    return raw.view(np.uint64), (offsets - offsets[0]) // 8


def _bucket(values: np.ndarray) -> np.ndarray:
    return (W.mix(values) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _counted(batches):
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        total += np.bincount(_bucket(_unpack(batch.column(0))[0]), minlength=BUCKETS)
    parts = total.reshape(-1, COUNT_CHUNK)
    mine = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64()), pa.array([parts[k].tobytes() for k in mine], pa.binary())], ["part", "counts"])


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in table["counts"])
    return pa.table({"part": table["part"][:1], "counts": pa.array([np.asarray(total, np.int64).tobytes()], pa.binary())})


def rarity(classes: DataFrame) -> np.ndarray:
    """How often each bucket of values occurs in all sketches: a table of fixed size."""
    sums = classes.select("sketch").mapInArrow(_counted, "part long, counts binary").groupBy("part").applyInArrow(_added, "part long, counts binary")
    out = np.zeros((BUCKETS // COUNT_CHUNK, COUNT_CHUNK), dtype=np.int64)
    for r in sums.collect():  # BUCKETS counters in all
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(-1)


def retained(values: np.ndarray, owner: np.ndarray, length: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    """Places of the rarest values of each sketch (``owner`` of each value, ``length`` of each sketch): linked sets have one in common."""
    need = np.minimum(-(-length * LIKE // OF), least)
    order = np.lexsort((values, counts[_bucket(values)], owner))
    rank = np.arange(len(values)) - (np.cumsum(length) - length)[owner]
    return order[rank < (length - need + 1)[owner]]


def _posted(counts: np.ndarray, least: int):
    def run(batches):
        for batch in batches:
            ids, values, offsets = batch.column(0).to_numpy(), *_unpack(batch.column(1))
            length = np.diff(offsets)
            owner = np.repeat(np.arange(len(length)), length)
            kept = retained(values, owner, length, counts, least)
            yield pa.RecordBatch.from_arrays([pa.array(values[kept].view(np.int64)), pa.array(ids[owner[kept]])], ["value", "rep"])

    return run


def union_estimate(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Jaccard estimate from the k smallest values of the union of two sketches."""
    both = np.sort(np.concatenate((a, b)))
    twin = np.concatenate((both[1:] == both[:-1], [False]))
    first = np.concatenate(([True], both[1:] != both[:-1]))
    size = min(k, int(first.sum()))
    head = np.flatnonzero(first)[:size]
    return float(twin[head].sum()) / max(1, size)


def passes(na: int, nb: int, a: np.ndarray, b: np.ndarray, k: int, least: int) -> bool:
    """Whether sizes and sketches allow a link."""
    if OF * min(na, nb) < LIKE * max(na, nb):
        return False
    if max(na, nb) <= k:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return OF * common >= LIKE * (na + nb - common)
    return union_estimate(a, b, k) * k >= least


@lean
def _estimated(batches):
    for batch in batches:
        (va, oa), (vb, ob) = _unpack(batch.column("sketch_a")), _unpack(batch.column("sketch_b"))
        na, nb = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        good = [passes(na[k], nb[k], va[oa[k] : oa[k + 1]], vb[ob[k] : ob[k + 1]], *FIRST) for k in range(batch.num_rows)]
        yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])


def similar(left: pa.Array, which: np.ndarray, right: pa.Array) -> list[bool]:
    """Whether each text of ``right`` and the text of ``left`` at ``which`` have sets that are linked."""
    sets = exact_sets(pa.concat_arrays([left, right]))
    good = []
    for k, mine in zip(which.tolist(), sets[len(left) :], strict=True):
        other = sets[k]
        less, more = (mine, other) if len(mine) <= len(other) else (other, mine)
        common = int((more[np.minimum(np.searchsorted(more, less), len(more) - 1)] == less).sum()) if len(less) else 0
        good.append(common > 0 and OF * common >= LIKE * (len(mine) + len(other) - common))
    return good


@lean
def _verified(batches):
    for batch in small(batches, 1024):
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        order = np.argsort(a, kind="stable")
        size = pc.binary_length(batch.column("text_b")).to_numpy(zero_copy_only=False)
        ends = np.zeros(len(order) + 1, dtype=np.int64)
        np.cumsum(size[order], out=ends[1:])
        good = np.zeros(len(order), dtype=bool)
        for lo, hi in W.slices(ends, VERIFY_BYTES):
            some = order[lo:hi]
            _, at, which = np.unique(a[some], return_index=True, return_inverse=True)
            good[some] = similar(batch.column("text_a").take(pa.array(some[at])), which, batch.column("text_b").take(pa.array(some)))
        mask = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(a).filter(mask), pa.array(b).filter(mask)], ["a", "b"])


def picked(work: Workspace, docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents in ``ids`` (doc_id)."""
    ids = work.table(ids.distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def verify(work: Workspace, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar; only the texts of documents in pairs are moved."""
    texts = work.table(picked(work, docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), "texts")
    right = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    links = work.table(both.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long"), "links")
    work.drop(texts)
    return links


def _overlaps(flat: np.ndarray, owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many sketch values each of ``rows`` shares with each of the ``n`` members."""
    place = np.full(n, -1)
    place[rows] = np.arange(len(rows))
    wanted = np.unique(flat[place[owner] >= 0])
    at = np.minimum(np.searchsorted(wanted, flat), len(wanted) - 1)
    met = wanted[at] == flat
    at, owner = at[met], owner[met]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    count = np.bincount(at, minlength=len(wanted))
    first = np.cumsum(count) - count
    shared = np.zeros((len(rows), n), dtype=np.int16)
    few = np.flatnonzero((count > 1) & (count < COMMON))
    for lo, c in zip(first[few].tolist(), count[few].tolist(), strict=True):
        mine = owner[lo : lo + c]
        here = place[mine]
        shared[np.ix_(here[here >= 0], mine)] += 1
    often = np.flatnonzero(count >= COMMON)  # values of many members: as a product of incidence matrices
    for lo in range(0, len(often), 256):
        some = often[lo : lo + 256]
        inc = np.zeros((n, len(some)), dtype=np.float32)
        for col, (at_, c) in enumerate(zip(first[some].tolist(), count[some].tolist(), strict=True)):
            inc[owner[at_ : at_ + c], col] = 1
        shared += (inc[rows] @ inc.T).astype(np.int16)
    return shared


def _crossed(k: int, least: int, best_only: bool):
    """Pairs of a list's members in different components that sizes and sketches allow.

    ``best_only``: for each member and other component, the partner with the largest overlap. Members meet in
    slices of CROSS_ROWS, so what is held at once grows with a block and not with its square."""

    def run(table: pa.Table) -> pa.Table:
        value = table["value"][0].as_py()
        rep, comp, n, side = (table[c].to_numpy() for c in ("rep", "component", "n", "side"))
        total = len(rep)
        flat, offsets = _unpack(table["sketch"].combine_chunks())
        length = np.diff(offsets)
        owner = np.repeat(np.arange(total), length)
        _, which, size = np.unique(comp, return_inverse=True, return_counts=True)
        minor = np.flatnonzero(which != size.argmax())  # pairs within the largest component need no look
        is_minor = np.zeros(total, dtype=bool)
        is_minor[minor] = True
        earlier: dict[int, list[int]] = {}
        for at, others in enumerate(table["lists"].to_pylist()):
            for other in others:
                if other < value:
                    earlier.setdefault(other, []).append(at)
        two_sides = side.min() != side.max()
        out_a, out_b = [], []
        for lo in range(0, len(minor), CROSS_ROWS):
            rows = minor[lo : lo + CROSS_ROWS]
            good = comp[rows][:, None] != comp[None, :]
            good &= OF * np.minimum.outer(n[rows], n) >= LIKE * np.maximum.outer(n[rows], n)
            if two_sides:
                good &= side[rows][:, None] != side[None, :]
            good &= ~is_minor[None, :] | (rep[rows][:, None] < rep[None, :])
            place = np.full(total, -1)
            place[rows] = np.arange(len(rows))
            for mine in earlier.values():  # a pair is met in the first list that both are in
                here = place[mine]
                good[np.ix_(here[here >= 0], mine)] = False
            rows, good = rows[good.any(axis=1)], good[good.any(axis=1)]
            if not len(rows):
                continue
            shared = _overlaps(flat, owner, rows, total)
            good &= shared >= np.minimum(-(-np.minimum.outer(length[rows], length) * LIKE // OF), least)
            x, y = np.nonzero(good)
            if not len(x):
                continue
            overlap, x = shared[x, y], rows[x]
            if best_only:
                order = np.lexsort((rep[y], -overlap, comp[y], x))
                x, y = x[order], y[order]
                first = np.concatenate(([True], (x[1:] != x[:-1]) | (comp[y][1:] != comp[y][:-1])))
                x, y = x[first], y[first]
            fit = [p for p, (i, j) in enumerate(zip(x.tolist(), y.tolist(), strict=True)) if passes(int(n[i]), int(n[j]), flat[offsets[i] : offsets[i + 1]], flat[offsets[j] : offsets[j + 1]], k, least)]
            out_a.append(rep[x[fit]])
            out_b.append(rep[y[fit]])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (out_a, out_b))
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return run


def several(work: Workspace, joint: DataFrame, labels: DataFrame) -> DataFrame:
    """(value, rep, component, c): members of the lists that hold several components, with the list's length."""
    marked = work.table(joint.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select("value", "rep", F.coalesce("component", "rep").alias("component")), "members")
    mixed = work.table(marked.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("c")).where("lo <> hi").select("value", "c"), "mixed")
    return work.table(marked.join(mixed, "value"), "several")


def short_pairs(members: DataFrame) -> DataFrame:
    """Pairs across components of lists of up to SMALL_LIST members: at most that many rows a member."""
    short = members.where(F.col("c") <= SMALL_LIST)
    a, b = short.select("value", F.col("rep").alias("a"), F.col("component").alias("ca")), short.select("value", F.col("rep").alias("b"), F.col("component").alias("cb"))
    return a.join(b, "value").where("a < b AND ca <> cb").select("a", "b").distinct()


def long_pairs(work: Workspace, members: DataFrame, finer: DataFrame, best_only: bool) -> DataFrame:
    """Candidate pairs across components of longer lists, from blocks of LIST_BLOCK members that meet."""
    long = members.where(F.col("c") > SMALL_LIST)
    lists = long.groupBy("rep").agg(F.array_sort(F.collect_list("value")).alias("lists"))  # a sketch's values at most
    dealt = long.withColumn("blocks", F.ceil(F.col("c") / LIST_BLOCK)).withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("value", "rep", "component", "side", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"))
    full = dealt.join(work.table(lists.join(finer, "rep"), "long-lists"), "rep")
    return work.table(full.groupBy("value", "x", "y").applyInArrow(_crossed(*FINER, best_only), "a long, b long").distinct(), "long-pairs")


def estimated(work: Workspace, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sizes and sketches allow a link."""
    side = lambda s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    met = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    return work.table(met.mapInArrow(_estimated, "a long, b long"), "likely")


def relabel(work: Workspace, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) after more links (a, b)."""
    if not links.limit(1).count():
        return labels
    named = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    between = links.join(named("a"), "a", "left").join(named("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    merged = work.table(components(work, between).select(F.col("node").alias("component"), F.col("component").alias("whole")), "merged")
    old = labels.join(merged, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    new = merged.join(labels.select(F.col("node").alias("component")), "component", "left_anti").select(F.col("component").alias("node"), F.col("whole").alias("component"))
    return work.table(old.unionByName(new), "labels")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", sketches: DataFrame | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    ``sketches``: a written table of ``SKETCHED`` for the same documents, where one is at hand."""
    work = Workspace(docs.sparkSession, "near")
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = work.table(source.mapInArrow(_sketched, SKETCHED), "sketches") if sketches is None else sketches
    some = sketches.where("n > 0 AND doc_id IS NOT NULL")
    names = work.table(some.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep")), "names")
    member = work.table(some.join(names, ["key1", "key2"]).select("doc_id", "rep", "n", F.when(F.col("doc_id") == F.col("rep"), F.col("sketch")).alias("sketch")), "member")
    rest = work.table(sketches.where("n = 0 OR doc_id IS NULL").select("doc_id", "n"), "rest")
    work.drop(sketches)
    classes = member.where("doc_id = rep").select("rep", "n", "sketch")
    counts = rarity(classes)
    postings = classes.select("rep", "sketch").mapInArrow(_posted(counts, FIRST[1]), "value long, rep long")
    lists = work.table(postings.groupBy("value").agg(F.min("rep").alias("leader"), F.count("*").alias("c")).where("c > 1"), "lists")
    joint = work.table(postings.join(lists, "value").select("value", "rep", "leader"), "joint")
    stars = work.table(joint.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct(), "stars")
    links = verify(work, source, estimated(work, classes, stars))
    repeated = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")  # a doc_id with several texts
    labels = work.table(components(work, links.unionByName(repeated)), "labels")

    members = several(work, joint, labels)
    long = members.where(F.col("c") > SMALL_LIST)
    finer = work.table(picked(work, source, long.select(F.col("rep").alias("doc_id"))).mapInArrow(lambda it: _sketched(it, FINER[0]), SKETCHED).select(F.col("doc_id").alias("rep"), "n", "sketch"), "finer")
    pairs = estimated(work, classes, short_pairs(members).join(stars, ["a", "b"], "left_anti")).unionByName(long_pairs(work, members, finer, True)).distinct()
    labels = relabel(work, labels, verify(work, source, work.table(pairs, "pairs")))
    if long.limit(1).count():
        members = several(work, long.select("value", "rep"), labels)
        labels = relabel(work, labels, verify(work, source, long_pairs(work, members.withColumn("c", F.greatest("c", F.lit(SMALL_LIST + 1))), finer, False)))
    work.clear(member, rest, labels)
    linked = member.select("doc_id", "rep", "n").join(labels.select(F.col("node").alias("rep"), F.col("component").alias("component_id")), "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "rep").alias("component_id"))
    alone = rest.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each group, columns as they were; of rows that repeat a doc_id, one."""
    found = near_duplicates(docs)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns)))
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    known = left.where(F.col("doc_id").isNotNull()).withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return known.unionByName(left.where(F.col("doc_id").isNull()))
