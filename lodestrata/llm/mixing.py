"""Mixing sources to target weights by pivotal dependent rounding.

Each source shares the budget by weight, at most ``cap`` times its own size; what it cannot
take is shared among the others. All documents of a source have the same fractional number of
copies, target / size of the source. Dependent rounding makes it whole: two fractional
documents meet, mass moves from one to the other (weighted by their sizes, so the words of the
pair stay the same) in a random direction until one of them is integral, and the other goes
on. Chunks of a source are rounded in parallel; each leaves at most one fractional document,
and these residuals meet in the next level of a reduction tree, until one a source is left,
which a last draw rounds.

Randomness comes from hashes of (seed, doc_id, text, source, level): reruns agree. The driver holds one row a source. The words of a source
differ from its target by less than the size of one document.

- A null text has size 0; a document of size 0 takes nothing. Null sources form one source, last in order.
- Repeated rows (equal doc_id) are documents of their own; equal draws are broken by size and text hash.
- No document takes more than ``ceil(cap)`` times its size. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm import wordhash as W
from lodestrata.llm.storage import Workspace

WEIGHTS, BUDGET, CAP = (5.0, 2.0, 1.0), 1.5, 2.0
CHUNK = 4096
SMALL_SOURCES = 20_000
"""Up to so many sources, their table is broadcast; beyond it, it is joined by shuffle."""


def size_of(text: str = "text") -> Column:
    """Words of a text; none for a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")



def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> list[tuple[str | None, int, float]]:
    """(source, size, target) by water-filling; weights repeat over sources in code-point order, null last."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    share = {k: float(weights[k % len(weights)]) for k in range(len(ordered))}
    total = budget * sum(n for _, n in ordered)
    out = {k: 0.0 for k in share}
    left, open_ = total, set(share)
    while open_:
        unit = left / sum(share[k] for k in sorted(open_))
        full = {k for k in open_ if unit * share[k] >= cap * ordered[k][1]}
        for k in full or open_:
            out[k] = cap * float(ordered[k][1]) if full else unit * share[k]
        if not full:
            break
        left -= sum(out[k] for k in sorted(full))
        open_ -= full
    return [(s, n, out[k]) for k, (s, n) in enumerate(ordered)]


def _uniform(ids: np.ndarray, level: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = W.mix(W.mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((seed * 1_000_003 + level) & 0xFFFFFFFFFFFFFFFF))
    return (mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pivot(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Round the fractional parts of one group but for the last survivor.

    Keeps the sum of ``size * part`` and each part's expectation. Groups of one survivor return it as it is."""
    part = part.astype(np.float64).copy()
    tiny = 1e-9
    held = -1
    for k in range(len(part)):
        if size[k] == 0 or part[k] <= tiny or part[k] >= 1 - tiny:
            part[k] = np.rint(part[k])
            continue
        if held < 0:
            held = k
            continue
        i, j = held, k
        up = min((1 - part[i]) * size[i], part[j] * size[j])  # words that can move from j to i
        down = min(part[i] * size[i], (1 - part[j]) * size[j])
        moved = up if draw[k] * (up + down) < down else -down
        part[i] += moved / size[i]
        part[j] -= moved / size[j]
        held = -1
        for x in (i, j):
            if part[x] <= tiny or part[x] >= 1 - tiny:
                part[x] = np.rint(part[x])
            else:
                held = x
    return part


def _rounded(level: int, seed: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        ids = table["key_hash"].to_numpy()
        size, part = table["size"].to_numpy(), table["part"].to_numpy()
        order = np.lexsort((part, size, ids))
        got = np.empty(len(part))
        draw = _uniform(ids, level, seed)
        got[order] = pivot(size[order], part[order], draw[order])
        loose = (got > 0) & (got < 1)
        if last:
            got[loose] = draw[loose] < got[loose]
        return table.set_column(table.schema.get_field_index("part"), "part", pa.array(got))

    return run


def _row_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text", "source")


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP, seed: int = 7, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, source, source_size, target, copies`` of every document (and the columns in ``carry``).

    Texts are read once, for their sizes; later steps move a few numbers a document."""
    spark = docs.sparkSession
    work = Workspace(spark, "mixing")
    base = work.table(
        docs.select("doc_id", "source", size_of().alias("size"), _row_key(seed).alias("key_hash"), *carry), "sizes"
    )
    totals = base.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect()  # a row a source
    if not totals:
        return base.select("doc_id", "size", "source", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("copies"), "key_hash", *carry)
    docs_of = {r["source"]: r["docs"] for r in totals}
    rows = [(s, n, t, int(t // n) if n else 0, (t / n - t // n) if n else 0.0, max(1, -(-docs_of[s] // CHUNK))) for s, n, t in targets([(r["source"], r["n"]) for r in totals], weights, budget, cap)]
    plan = spark.createDataFrame(rows, "source string, source_size long, target double, whole long, part double, chunks long")
    if len(rows) <= SMALL_SOURCES:
        plan = F.broadcast(plan)
    joined = base.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source"))).drop(F.col("p.source"))
    current = joined.withColumn("chunk", F.pmod(F.xxhash64("key_hash"), F.col("chunks")))
    deepest, level, done = max(r[5] for r in rows), 0, None
    while True:
        last = deepest == 1
        step = work.table(current.groupBy("source", "chunk").applyInArrow(_rounded(level, seed, last), current.schema), f"level{level}")
        loose = (F.col("part") > 0) & (F.col("part") < 1)
        done = step.where(~loose) if done is None else done.unionByName(step.where(~loose))
        if last:
            break
        current = step.where(loose).withColumn("chunk", F.floor(F.col("chunk") / CHUNK))
        deepest, level = -(-deepest // CHUNK), level + 1
    return done.select("doc_id", "size", "source", "source_size", "target", (F.col("whole") + F.col("part").cast("long")).alias("copies"), "key_hash", *carry)


def take(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns as they were.

    Rows that repeat document, text and source stand for one another: their copies come from one of them, the first by hash of all columns."""
    taken = mix(docs, weights, budget, cap, seed).groupBy("key_hash").agg(F.sum("copies").alias("__copies")).where("__copies > 0")
    first = F.row_number().over(Window.partitionBy("__key").orderBy(F.xxhash64(*docs.columns)))
    met = docs.withColumn("__key", _row_key(seed)).join(taken.withColumnRenamed("key_hash", "__key"), "__key")
    return met.withColumn("__first", first).where("__first = 1").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)
