"""Importance resampling: documents that look like a target corpus are likelier to be drawn.

Features are all runs of 1 to ``n`` words, hashed into buckets by crc32. A bucket's gain is the logarithm of how much
more often the target has it; a document's weight is the mean gain of its features; a Gumbel number made from its id is
added, and the highest sums are drawn, which draws without replacement in proportion to the weights.

Long texts are cut at word boundaries into chunks (``chunks``): a chunk owns the words that begin in its
stretch of bytes and carries the ``n - 1`` words behind them, so every run of words is counted once, by the chunk in which
it begins. Chunks are spread over the tasks; their counts and gains are summed by document. Short texts stay where they are. Counts cross the network
as at most one row a bucket and task; the table of gains has ``BUCKETS`` numbers at any size. Ranks come from a sort by ranges and the sizes of the ranges before.

Defined cases: a null or wordless text has no features and weight 0; repeated rows are documents of their own; a null id draws with the number of the text
``<seed>:`` and comes after other ids of equal score; an empty target leaves the gains to the smoothing; an empty table gives an empty
one; other columns play no part, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm import wordhash as W
from lodestrata.llm.memory import lean
from lodestrata.llm.storage import Workspace

BUCKETS, N, CHUNK_BYTES, LEAST_WORDS, SHARE, SEED = 10_000, 2, 1 << 16, 20, 25, 7

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True

SHIFTS = 64
"""Ranges up to so many bytes are joined by tables; longer words by the library."""


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The table of crc32, and tables that move a checksum over 0 to ``SHIFTS`` bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    moved = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(SHIFTS):
        moved.append((moved[-1] >> np.uint32(8)) ^ table[moved[-1] & 255])
    return table, np.stack(moved)


_CRC, _MOVED = _crc_tables()
_BLANK = np.array([zlib.crc32(b" ")], dtype=np.uint32)


def crc_ranges(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The crc32 of the bytes of each range."""
    size = end - begin
    out = np.full(len(begin), 0xFFFFFFFF, dtype=np.uint32)
    some, at, stop = np.flatnonzero(size <= SHIFTS), begin, end
    at, stop = at[some], stop[some]
    while len(some):
        more = at < stop
        if not more.all():
            some, at, stop = some[more], at[more], stop[more]
        state = out[some]
        out[some] = (state >> np.uint32(8)) ^ _CRC[(state ^ data[at]) & 255] if len(some) else state
        at = at + 1
    out ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(size > SHIFTS).tolist():
        out[k] = zlib.crc32(data[begin[k] : end[k]])
    return out


def _move(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The checksums, moved over so many bytes."""
    return _MOVED[size, 0, crc & 255] ^ _MOVED[size, 1, (crc >> np.uint32(8)) & 255] ^ _MOVED[size, 2, (crc >> np.uint32(16)) & 255] ^ _MOVED[size, 3, crc >> np.uint32(24)]


def join_crc(first: np.ndarray, word: np.ndarray, size: np.ndarray, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The crc32 of text, blank and word, from the crc32 of the text and of the word (at ``begin`` in ``data``, of ``size`` bytes)."""
    short = size < SHIFTS
    held = np.where(short, size, 0)
    out = _move(first, held + 1) ^ _move(np.broadcast_to(_BLANK, first.shape), held) ^ word
    for k in np.flatnonzero(~short).tolist():
        out[k] = zlib.crc32(data[begin[k] : begin[k] + size[k]], zlib.crc32(b" ", int(first[k])))
    return out


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, row) of the words of texts that fill ``data``."""
    return W.spans(~_WORD[data], offsets[:-1], offsets[1:])


def buckets_of(data: np.ndarray, offsets: np.ndarray, own: np.ndarray | None, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its row, words of each row). ``own``: how many words of each row begin features there; None: all."""
    lower = W.LOWER[data]
    begin, end, row = words_of(lower, offsets)
    count = np.bincount(row, minlength=len(offsets) - 1)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    mine = np.ones(len(row), dtype=bool) if own is None else place < own[row]
    word = crc_ranges(lower, begin, end)
    found, rows, run = [], [], word
    for k in range(n):
        if k:
            if len(word) <= k:
                break
            run = join_crc(run[:-1], word[k:], (end - begin)[k:], lower, begin[k:])
        inside = mine[: len(run)] & (row[: len(run)] == row[k:])
        found.append((run[inside] % np.uint32(buckets)).astype(np.int64))
        rows.append(row[: len(run)][inside])
    return np.concatenate(found), np.concatenate(rows), (count if own is None else own)


def chunks(data: np.ndarray, size: int, n: int) -> list[tuple[int, bytes]]:
    """(words owned, bytes) of each chunk of a text; chunk k owns the words that begin in its ``size`` bytes. At least one chunk."""
    begin, end, _ = words_of(data, np.array([0, len(data)]))
    if not len(begin):
        return [(0, b"")]
    first = np.searchsorted(begin // size, np.unique(begin // size))
    last = np.append(first[1:], len(begin))
    carried = np.minimum(last + n - 1, len(begin)) - 1
    return [(hi - lo, data[begin[lo] : end[c]].tobytes()) for lo, hi, c in zip(first.tolist(), last.tolist(), carried.tolist(), strict=True)]


@lean
def _cut(batches, size: int, n: int):
    for batch in batches:
        raw, offsets = W.buffers(batch.column(2))
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            for number, (own, piece) in enumerate(chunks(raw[offsets[k] : offsets[k + 1]], size, n)):
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), pa.array([number], pa.int64()), pa.array([own], pa.int64()), pa.array([piece], pa.binary())], ["doc_id", "digest", "chunk", "own", "piece"])


def _rows(batch: pa.RecordBatch, text: int, own: int | None):
    """Slices of a batch: (first row, bytes, offsets, words owned)."""
    column = batch.column(text)
    raw, offsets = W.buffers(column.cast(pa.large_binary()).view(pa.large_string()) if pa.types.is_binary(column.type) else column)
    owned = None if own is None else batch.column(own).to_numpy(zero_copy_only=False)
    for lo, hi in W.slices(offsets):
        yield lo, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], None if owned is None else owned[lo:hi]


@lean
def _counted(batches, n: int, buckets: int, own: int | None):
    """How often each bucket occurs in a partition: at most one row a bucket."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, data, offsets, owned in _rows(batch, 0, own):
            total += np.bincount(buckets_of(data, offsets, owned, n, buckets)[0], minlength=buckets)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])


@lean
def _weighed(batches, n: int, gains: np.ndarray, text: int, own: int | None):
    """Each row's other columns with its words, its features and the sum of their gains."""
    for batch in batches:
        kept = [k for k in range(batch.num_columns) if k not in (text, own)]
        for lo, data, offsets, owned in _rows(batch, text, own):
            bucket, row, words = buckets_of(data, offsets, owned, n, len(gains))
            rows = len(offsets) - 1
            total = np.zeros(rows, np.int64)
            edges = np.bincount(row, minlength=rows)
            np.add.at(total, row, gains[bucket])
            sub = batch.slice(lo, rows)
            yield pa.RecordBatch.from_arrays([*(sub.column(k) for k in kept), pa.array(words, pa.int64()), pa.array(edges, pa.int64()), pa.array(total, pa.int64())], [*(batch.schema.names[k] for k in kept), "n_words", "n_features", "gain"])


def gains_of(corpus: np.ndarray, target: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each bucket, in doubles."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


class Texts:
    """The texts of a table: short ones in place, long ones as a table of chunks."""

    def __init__(self, docs: DataFrame, work: Workspace, text: str, key: str, n: int, chunk_bytes: int):
        picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        long = F.coalesce(F.octet_length("text"), F.lit(0)) > chunk_bytes
        self.short = picked.where(~long)
        cut = picked.where(long).select("doc_id", F.sha2("text", 256).alias("digest"), "text").mapInArrow(lambda it: _cut(it, chunk_bytes, n), "doc_id long, digest string, chunk long, own long, piece binary")
        self.chunks = work.table(cut.repartition("doc_id", "digest", "chunk"), "chunks", rows=16)

    def counts(self, n: int, buckets: int) -> np.ndarray:
        """How often each bucket occurs; ``buckets`` rows reach the driver."""
        kind = "bucket long, n long"
        both = self.short.select("text").mapInArrow(lambda it: _counted(it, n, buckets, None), kind).unionByName(self.chunks.select("piece", "own").mapInArrow(lambda it: _counted(it, n, buckets, 1), kind))
        out = np.zeros(buckets, np.int64)
        for bucket, count in both.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[bucket] = count
        return out

    def weights(self, n: int, gains: np.ndarray) -> DataFrame:
        """doc_id, n_words, n_features, gain (the sum) of each row. Chunks of equal rows meet, so their sums are shared out again."""
        sums = "n_words long, n_features long, gain long"
        short = self.short.mapInArrow(lambda it: _weighed(it, n, gains, 1, None), f"doc_id long, {sums}")
        parts = self.chunks.mapInArrow(lambda it: _weighed(it, n, gains, 4, 3), f"doc_id long, digest string, chunk long, {sums}")
        long = parts.groupBy("doc_id", "digest").agg(F.sum((F.col("chunk") == 0).cast("long")).alias("copies"), *(F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")))
        each = long.select("doc_id", *(F.expr(f"{c} div copies").alias(c) for c in ("n_words", "n_features", "gain")), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        return short.unionByName(each.drop("copy"))


def importance(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text", n: int = N, buckets: int = BUCKETS, chunk_bytes: int = CHUNK_BYTES, work: Workspace | None = None) -> DataFrame:
    """doc_id, n_words, n_features and weight (the floored mean gain) of each document."""
    work = work or Workspace(docs.sparkSession, "importance")
    mine, wanted = Texts(docs, work, text, key, n, chunk_bytes), Texts(target.select(F.lit(None).cast("long").alias("__id"), F.col(target_text).alias("__text")), work, "__text", "__id", n, chunk_bytes)
    found = mine.weights(n, gains_of(mine.counts(n, buckets), wanted.counts(n, buckets), buckets))
    mean = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    return found.select("doc_id", "n_words", "n_features", mean.alias("weight"))


def gumbel(key: str, seed: int):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256 of ``seed:id``."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED, **how) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; the rank is null where it is not drawn.

    Of the documents of ``least_words`` words or more, ``share`` per cent (rounded down) are drawn."""
    work = Workspace(docs.sparkSession, "resample")
    weighed = importance(docs, target, work=work, **how).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = work.table(weighed, "scored")
    enough = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    ranged = scored.where(enough).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = work.table(ranged.select("doc_id", "n_features", "weight", "score", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")), "ordered")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row a range
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = (placed.count() * share) // 100
    rank = F.col("before") + F.col("place") + 1
    ranked = placed.join(sizes.select("part", before.alias("before")), "part").select("doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))
    return ranked.unionByName(scored.where(~enough).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
