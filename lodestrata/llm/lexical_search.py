"""Ranked lexical search: impact-ordered postings, score at a time.

A posting's impact is the integer that its document's score gains from one occurrence of the term in a query. Every task takes
its documents in blocks; a block's postings are sorted by term and descending impact, so postings of one exact impact are a
group. A query takes whole groups off its terms' lists in descending order of impact, in bands: a band ends
where the next groups are worth less than half of its first. After each band the sum of the terms' next impacts bounds what any document can
still gain. A query stops in a block only when that bound proves that no document outside the candidates can
reach the best ``k`` (ties count as reach); the candidates' scores are then completed from the block's postings by document. A query's
best scores so far go on from block to block of a task, and raise the bar. The tasks' best
are merged by rank, salted first.

Documents are split, never terms, so a word that most documents hold is spread like the documents. Statistics
(number and length of documents, frequency of each query term) come from all documents before. Queries go to the tasks in
blocks of at most ``QUERY_BYTES`` of text, whatever their number; each block is one pass over a table of its postings.

Defined cases: a null text has no term: such a document is not counted and never found, such a query finds nothing; repeated
documents are found each, repeated queries are answered each; a null document id comes after others of equal score;
documents that score 0 are not found; empty tables give an empty one; texts are whole, of any length; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm import wordhash as W
from lodestrata.llm.memory import lean
from lodestrata.llm.storage import Workspace

K, QUERY_BYTES, BLOCK_DOCS, BLOCK_POSTINGS, SALTS = 20, 16 << 20, 1 << 16, 4_000_000, 64

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_NO_ID = np.iinfo(np.int64).max


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all terms of the texts that fill ``data``, in order, as bytes; the row of each)."""
    lower = W.LOWER[data]
    begin, end, row = W.spans(~_TERM[lower], offsets[:-1], offsets[1:])
    return W.column(lower, begin, end), row


@lean
def _matched(batches, vocabulary: list[bytes]):
    """doc_id, number of terms, and the numbers and counts of the query terms in it, of documents with a term."""
    wanted = pa.array(vocabulary, pa.large_binary())
    for batch in batches:
        raw, offsets = W.buffers(batch.column(1))
        for lo, hi in W.slices(offsets, 1 << 22):
            terms, row = terms_of(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            size = np.bincount(row, minlength=hi - lo)
            code = pc.index_in(terms, value_set=wanted)
            hit = np.flatnonzero(code.is_valid().to_numpy(zero_copy_only=False))
            keys, tf = np.unique(row[hit] * max(1, len(vocabulary)) + code.fill_null(0).to_numpy()[hit], return_counts=True)
            docs, term = np.divmod(keys, max(1, len(vocabulary)))
            end = np.concatenate(([0], np.cumsum(np.bincount(docs, minlength=hi - lo)))).astype(np.int32)
            found = pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(end), pa.array(term, pa.int32())), pa.ListArray.from_arrays(pa.array(end), pa.array(tf, pa.int64()))],
                ["doc_id", "n_terms", "terms", "tfs"],
            )
            yield found.filter(pa.array(size > 0))


@lean
def _frequencies(batches, n: int):
    total = np.zeros(n, np.int64)
    for batch in batches:
        total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["term", "df"])


def term_weights(df: np.ndarray, docs: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term, in doubles."""
    return np.floor(1000 * np.log((2.0 * docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, n_terms: np.ndarray, docs: int, length: int) -> np.ndarray:
    """weight * ((10**9 tf) div (1000 tf + 12 m)) with m = 75 + (25 n N) div L, in whole numbers."""
    top = 25 * int(n_terms.max(initial=0)) * docs
    n = n_terms if top < 1 << 63 else n_terms.astype(object)
    m = (75 + (25 * n * docs) // length).astype(np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class Block:
    """The postings of some documents: by term and descending impact, and by document."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids, self.ptr, self.term, self.impact = ids, ptr, term, impact
        doc = np.repeat(np.arange(len(ids)), np.diff(ptr))
        order = np.lexsort((-impact, term))
        self.docs, self.falling = doc[order], -impact[order]  # negated: ascending, as searchsorted wants
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.sums = np.zeros(len(ids), np.int64)

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, bar: int, mult: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) that may be among the best k of a query; ``bar``: the k-th best score known, 0 if there is none.

        ``mult``: zeros, a place a term; left as found."""
        at, stop = self.start[terms].copy(), self.start[terms + 1]
        open_ = at < stop
        terms, times, at, stop = terms[open_], times[open_], at[open_], stop[open_]
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        following = lambda: np.where(at < stop, times * -self.falling[np.minimum(at, stop - 1)], 0)
        ahead = following()
        sums, low = self.sums, bar
        if not len(terms) or ahead.sum() < max(low, 1):
            return none
        sums[:] = 0
        while ahead.any():
            floor = max(1, -(-int(ahead.max()) // 2))
            for j in np.flatnonzero(ahead >= floor).tolist():
                least = -(-floor // int(times[j]))
                to = at[j] + np.searchsorted(self.falling[at[j] : stop[j]], -least, side="right")  # whole groups of one impact
                sums[self.docs[at[j] : to]] -= times[j] * self.falling[at[j] : to]  # a term has a document once
                at[j] = to
            ahead = following()
            if len(sums) >= k:
                low = max(low, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
            if ahead.sum() < low:
                break
        found = np.flatnonzero((sums + ahead.sum() >= max(low, 1)) & (sums > 0))
        score = sums[found]
        if ahead.any():  # complete the candidates' scores from their own postings
            size = self.ptr[found + 1] - self.ptr[found]
            end = np.cumsum(size)
            places = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(self.ptr[found] - (end - size), size)
            mult[terms] = times
            gained = np.concatenate(([0], np.cumsum(mult[self.term[places]] * self.impact[places])))
            score = gained[end] - gained[end - size]
            mult[terms] = 0
        good = score >= max(low, 1)
        return found[good], score[good]


def merged(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the best k: highest score first, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


@lean
def _searched(batches, plan: dict, k: int):
    """The best k of a partition for each query: item number, doc_id, score."""
    weight, docs, length, queries = plan["weight"], plan["docs"], plan["length"], plan["queries"]
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
    mult = np.zeros(len(weight), np.int64)

    def look(parts: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids = table.column(0).combine_chunks().fill_null(_NO_ID).to_numpy().astype(np.int64)
        lists = table.column(2).combine_chunks()
        ptr = lists.offsets.to_numpy().astype(np.int64)
        ptr = ptr - ptr[0]
        term, tf = lists.flatten().to_numpy(), table.column(3).combine_chunks().flatten().to_numpy()
        size = np.repeat(table.column(1).to_numpy(), np.diff(ptr))
        block = Block(ids, ptr, term, impacts(weight[term], tf, size, docs, length), len(weight))
        for q, (terms, times) in enumerate(queries):
            have, score = held[q]
            found, more = block.best(terms, times, k, int(score[-1]) if len(score) == k else 0, mult)
            if len(found):
                have, score = np.concatenate((have, ids[found])), np.concatenate((score, more))
                order = merged(have, score, k)
                held[q] = have[order], score[order]

    waiting, docs_waiting, postings = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        docs_waiting += batch.num_rows
        postings += len(batch.column(2).flatten())
        if docs_waiting >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
            look(waiting)
            waiting, docs_waiting, postings = [], 0, 0
    if waiting:
        look(waiting)
    for q, (ids, score) in enumerate(held):
        if len(ids):
            column = pa.array(ids, pa.int64(), mask=ids == _NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q), pa.int64()), column, pa.array(score, pa.int64())], ["item", "doc_id", "score"])


@lean
def _query_terms(batches):
    for batch in batches:
        raw, offsets = W.buffers(batch.column(1))
        terms, row = terms_of(raw[offsets[0] : offsets[-1]], offsets - offsets[0])
        count = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows)))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(count), terms.cast(pa.binary()))], ["item_id", "terms"])


def query_blocks(items: DataFrame, query_bytes: int) -> list[DataFrame]:
    """The queries (item_id, text) in blocks of at most ``query_bytes`` of text, or of one text, each read by a filter on hashes."""
    total, rows = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = max(1, -(-(total or 0) // query_bytes))
    place = lambda n: F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    while n > 1 and n < 4 * rows and items.groupBy(place(n).alias("b")).agg(F.sum(F.octet_length("text")).alias("s")).agg(F.max("s")).first()[0] > query_bytes:
        n *= 2
    return [items] if n == 1 else [items.where(place(n) == b) for b in range(n)]


def search(docs: DataFrame, items: DataFrame, k: int = K, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the best k documents of each item, best first, ties to the smaller doc_id."""
    spark = docs.sparkSession
    work = Workspace(spark, "lexical")
    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    out = None
    for queries in query_blocks(asked, query_bytes):
        rows = queries.mapInArrow(_query_terms, "item_id long, terms array<binary>").collect()
        vocabulary = sorted({bytes(t) for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        counted = [np.unique([number[bytes(t)] for t in r["terms"]], return_counts=True) if r["terms"] else (np.zeros(0, np.int64), np.zeros(0, np.int64)) for r in rows]
        shared = spark.sparkContext.broadcast(vocabulary)
        postings = work.table(picked.mapInArrow(lambda it, v=shared: _matched(it, v.value), "doc_id long, n_terms long, terms array<int>, tfs array<long>"), "postings", rows=10_000)
        n, length = postings.agg(F.count("*"), F.sum("n_terms")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for term, count in postings.select("terms").mapInArrow(lambda it, v=len(vocabulary): _frequencies(it, v), "term long, df long").groupBy("term").agg(F.sum("df")).collect():
            df[term] = count
        plan = spark.sparkContext.broadcast({"weight": term_weights(df, n), "docs": n, "length": max(1, length or 0), "queries": [(t.astype(np.int64), c.astype(np.int64)) for t, c in counted]})
        found = postings.mapInArrow(lambda it, p=plan: _searched(it, p.value, k), "item long, doc_id long, score long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        salted = found.withColumn("salt", F.spark_partition_id() % SALTS).withColumn("place", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("place") <= k)
        ranked = salted.select("item", "doc_id", "score", F.row_number().over(Window.partitionBy("item").orderBy(*order)).alias("rank")).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item long, item_id long")
        block = work.table(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "found")
        work.drop(postings)
        out = block if out is None else out.unionByName(block)
    return out

