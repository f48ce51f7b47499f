"""Approximate nearest neighbours with randomly rotated one-bit codes.

The index centres unit vectors, rotates them by a random orthogonal matrix and keeps the sign
of each coordinate (packed bits) with two correction scalars: the residual's length and the
inner product of the residual's direction with its code. For a query, the code gives an
unbiased estimate of the inner product and a bound of its error. The k best estimates of a
block are scored exactly; only vectors whose upper bound reaches the k-th of these scores are
reranked, with the exact cosine in double precision.

Queries meet all rows in blocks: the codes and vectors of ``BLOCK`` rows are one binary row,
and so are ``BLOCK`` queries; no pair of single rows is ever emitted but the best k of each
query in each block.

- Vectors that are null or zero, hold a null or non-finite component, or differ in length from
  the most frequent length (ties: the shorter) take no part, as query or candidate.
- Ties in score go to the smaller vec_id. Rows that repeat a vec_id are candidates of their own; a
  query id that repeats asks with its first row by vector order. A query's own id is never its neighbour.
- Fewer than k candidates: all of them. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.storage import Workspace

BLOCK, QUERY_BLOCK, SEED, BOUND = 4096, 8192, 11, 3.0
"""BOUND: width of the error bound in standard deviations; a block loses one of its best with a chance of about 0.1 %."""
QUERY_SLICE, SCORED = 64, 1 << 15
"""Queries estimated at once, and pairs scored at once: they bound a task's memory."""
SMALL_QUERIES = 1 << 22
"""Up to so many query components (32 MB), query blocks are broadcast; beyond it, blocks are joined by shuffle."""


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """(packed signs, length of the residual, inner product of its direction with its code, inner product with the centre)."""
    residual = (unit - centre) @ turn.T
    length = np.linalg.norm(residual, axis=1)
    inner = np.abs(residual).sum(axis=1) / (np.maximum(length, 1e-30) * np.sqrt(unit.shape[1]))
    return np.packbits(residual >= 0, axis=1), length, np.where(length > 0, inner, 1.0), unit @ centre


def estimate(code: tuple[np.ndarray, ...], unit_query: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimate of the cosine, its error bound) of every query and code.

    With residuals r and s of vector and query from the centre c, <x, q> = <r, s> + <x, c> + <q, c> - <c, c>;
    <r, s> comes from the packed bits, the rest is known."""
    bits, length, inner, with_centre = code
    d = unit_query.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    rest = (unit_query - centre) @ turn.T
    along = (rest.astype(np.float32) @ signs.T).astype(np.float64) / np.sqrt(d)
    known = with_centre[None, :] + (unit_query @ centre)[:, None] - centre @ centre
    off = length * np.sqrt(np.maximum(0, 1 - inner**2)) / inner / np.sqrt(max(1, d - 1))
    return along * (length / inner)[None, :] + known, BOUND * np.linalg.norm(rest, axis=1)[:, None] * off[None, :] + 1e-5


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` (double) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    )


def _blocks(size: int, prefix: str):
    """Rows of a partition gathered into binary blocks."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                ids = part.column("vec_id").to_numpy()
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([flat.astype("<f8").tobytes()], pa.binary())], [f"{prefix}_ids", f"{prefix}_flat"])

    return run


def _searched(d: int, k: int, centre: np.ndarray, turn: np.ndarray):
    def run(batches):
        for batch in batches:
            for qi, qf, ci, cf, cb, cl, cp, cc in zip(*(batch.column(n) for n in ("q_ids", "q_flat", "c_ids", "c_flat", "c_bits", "c_length", "c_inner", "c_centre")), strict=True):
                out = search_block(
                    np.frombuffer(qi.as_py(), "<i8"), np.frombuffer(qf.as_py(), "<f8").reshape(-1, d), np.frombuffer(ci.as_py(), "<i8"), np.frombuffer(cf.as_py(), "<f8").reshape(-1, d),
                    (np.frombuffer(cb.as_py(), np.uint8).reshape(-1, -(-d // 8)), np.frombuffer(cl.as_py(), "<f8"), np.frombuffer(cp.as_py(), "<f8"), np.frombuffer(cc.as_py(), "<f8")), k, centre, turn,
                )
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2])], ["query_id", "vec_id", "score"])

    return run


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of ``a`` with those of ``b``, row by row, in double precision."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def search_block(q_ids, q, c_ids, c, code, k, centre, turn):
    """The k nearest of a block of candidates for each query of a block: (query ids, vec ids, scores).

    The k best estimates are scored first; the k-th exact score is the bar that an upper bound must reach."""
    found = [[], [], []]
    unit_q = q / np.linalg.norm(q, axis=1, keepdims=True)
    for lo in range(0, len(q), QUERY_SLICE):
        mine = slice(lo, min(lo + QUERY_SLICE, len(q)))
        value, error = estimate(code, unit_q[mine], centre, turn)
        own = q_ids[mine, None] == c_ids[None, :]
        value[own] = -np.inf
        n = value.shape[1]
        bar = np.full(len(value), -np.inf)
        if n > k:
            first = np.argpartition(value, n - k, axis=1)[:, n - k :]
            at = np.repeat(np.arange(len(value)), k)
            exact = np.where(own[at, first.ravel()], -np.inf, cosine(q[lo + at], c[first.ravel()]))
            bar = exact.reshape(len(value), k).min(axis=1)
        at_q, at_c = np.nonzero((value + error >= bar[:, None]) & ~own)
        if not len(at_q):
            continue
        score = np.concatenate([cosine(q[lo + at_q[x : x + SCORED]], c[at_c[x : x + SCORED]]) for x in range(0, len(at_q), SCORED)])
        order = np.lexsort((c_ids[at_c], -score, at_q))
        at_q, at_c, score = at_q[order], at_c[order], score[order]
        best = np.arange(len(at_q)) - np.searchsorted(at_q, at_q) < k
        for box, x in zip(found, (q_ids[lo + at_q[best]], c_ids[at_c[best]], score[best]), strict=True):
            box.append(x)
    return [np.concatenate(x) if x else np.zeros(0, kind) for x, kind in zip(found, (np.int64, np.int64, np.float64), strict=True)]


def search(rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of ``rows`` for each of ``queries``."""
    spark = rows.sparkSession
    work = Workspace(spark, "nearest")
    every = usable(rows, key, vector)
    lengths = every.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = lengths[0]["d"]
    every = every.where(F.size("v") == d)
    turn = rotation(d)
    mean = every.select(F.transform("v", lambda x: x / F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, y: a + y * y))).alias("u")).agg(*(F.avg(F.col("u")[j]).alias(f"m{j}") for j in range(d))).first()
    centre = np.round(np.array(list(mean), dtype=np.float64), 6)

    def coded(batches):
        for batch in _blocks(BLOCK, "c")(batches):
            flat = np.frombuffer(batch.column("c_flat")[0].as_py(), "<f8").reshape(-1, d)
            code = encode(flat / np.linalg.norm(flat, axis=1, keepdims=True), centre, turn)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([x.tobytes()], pa.binary()) for x in code)], [*batch.schema.names, "c_bits", "c_length", "c_inner", "c_centre"])

    blocks = work.table(every.mapInArrow(coded, "c_ids binary, c_flat binary, c_bits binary, c_length binary, c_inner binary, c_centre binary"), "codes", BLOCK)
    asked = usable(queries, key, vector).where(F.size("v") == d).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = work.table(asked.mapInArrow(_blocks(QUERY_BLOCK, "q"), "q_ids binary, q_flat binary"), "queries", QUERY_BLOCK)
    deals = max(1, asked.count())
    numbered = asked.withColumn("deal", F.pmod(F.xxhash64("q_ids"), F.lit(deals)))
    if deals * QUERY_BLOCK * d <= SMALL_QUERIES:
        numbered = F.broadcast(numbered)
    met = blocks.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long")))).join(numbered, "deal")
    near = met.mapInArrow(_searched(d, k, centre, turn), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # limited to k before the shuffle, too
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
