"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``capacity`` words. Bins are held in order of their
residual room. Every source and every duplicate cluster has a bitmap of the group's bins that hold it,
as wide as there are bins, so only a real conflict keeps a piece out of a bin. A piece takes the tightest bin that has room for it: the successor
search starts at the smallest sufficient residual and goes on until a bin fits without
conflict. First it asks for a bin with neither the piece's cluster nor its source; if there is
none, for one without its cluster; else it opens a new bin. Two pieces of one cluster never
share a bin, nor do two pieces of one document.

Pieces are packed in groups by hash of the document, so a source with a third of all rows is spread over all
groups; their number comes from the number of pieces, so each group holds about ``GROUP`` of them, and its open bins are bounded by them. Within a group,
pieces come longest first (ties by document, piece and hash of the row).

- A null text has no words and takes an empty piece of length 0 (``n_words`` 0), so every row has a bin.
- Null sources and null clusters conflict with nothing. Repeated rows share a cluster and so get different bins.
- An empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm import near_dedup
from lodestrata.llm import wordhash as W
from lodestrata.llm.components import components
from lodestrata.llm.memory import lean, small
from lodestrata.llm.storage import Workspace

CAPACITY, GROUP = 2048, 4096

RESULT = "doc_id long, piece long, start_word long, n_words long, bin_id string, bin_offset long, cluster long, source string, row_hash long"


class Bins:
    """Open bins of one group, ordered by residual room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.room = np.zeros(0, dtype=np.int64)
        self.name = np.zeros(0, dtype=np.int64)
        self.sources: dict[int, np.ndarray] = {}
        self.clusters: dict[int, np.ndarray] = {}
        self.count = 0

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) for a piece; ``source`` and ``cluster`` are numbers, 0 for none."""
        at = int(np.searchsorted(self.room, size))
        apart = ~self._holds(self.clusters, cluster, at)
        strict = apart & ~self._holds(self.sources, source, at)
        for free in (strict, apart):
            if free.size and free[k := int(free.argmax())]:
                name, offset = self._put(at + k, size)
                break
        else:
            name, offset = self.count, 0
            self.count += 1
            self._insert(self.capacity - size, name)
        self._mark(self.sources, source, name)
        self._mark(self.clusters, cluster, name)
        return name, offset

    def _holds(self, maps: dict[int, np.ndarray], key: int, at: int) -> np.ndarray:
        """Which of the bins from ``at`` on hold the key."""
        names = self.name[at:]
        bits = maps.get(key) if key else None
        if bits is None:
            return np.zeros(len(names), dtype=bool)
        known = names < len(bits)
        return known & bits[np.where(known, names, 0)]

    def _mark(self, maps: dict[int, np.ndarray], key: int, name: int) -> None:
        if not key:
            return
        bits = maps.get(key)
        if bits is None or len(bits) <= name:
            wider = np.zeros(max(name + 1, 2 * (0 if bits is None else len(bits))), dtype=bool)
            if bits is not None:
                wider[: len(bits)] = bits
            maps[key] = bits = wider
        bits[name] = True

    def _insert(self, room: int, name: int) -> None:
        if room > 0:
            at = int(np.searchsorted(self.room, room, side="right"))
            self.room, self.name = np.insert(self.room, at, room), np.insert(self.name, at, name)

    def _put(self, k: int, size: int) -> tuple[int, int]:
        room, name = int(self.room[k]), int(self.name[k])
        self.room, self.name = np.delete(self.room, k), np.delete(self.name, k)
        self._insert(room - size, name)
        return name, self.capacity - room


def numbered(values: list) -> list[int]:
    """Equal values get equal numbers from 1 on; None gets 0."""
    known: dict = {}
    return [0 if x is None else known.setdefault(x, len(known) + 1) for x in values]


def _packed(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        size = table["n_words"].to_numpy()
        doc = table["doc_id"].fill_null(-(1 << 62)).to_numpy()
        piece, tie = table["piece"].to_numpy(), table["row_hash"].to_numpy()
        sources, clusters = numbered(table["source"].to_pylist()), numbered(table["cluster"].to_pylist())
        group = table["pack_group"][0].as_py()
        order = np.lexsort((tie, piece, doc, -size))
        bins, name, offset = Bins(capacity), [None] * len(size), np.zeros(len(size), dtype=np.int64)
        for k in order.tolist():
            at, offset[k] = bins.place(int(size[k]), sources[k], clusters[k])
            name[k] = f"{group}-{at}"
        table = table.drop_columns(["pack_group"])
        return table.append_column("bin_id", pa.array(name, pa.string())).append_column("bin_offset", pa.array(offset)).select([x.split()[0] for x in RESULT.split(", ")])

    return run


SIZED = "doc_id long, source string, row_hash long, words long, cluster long"


def measure_columns(column: pa.Array) -> list[pa.Array]:
    """Words of each text, and a keyed blake2b of its words in order, letter case aside (null for a null text)."""
    raw, offsets = W.buffers(pc.utf8_lower(column))
    words, plain = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    for k, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        parts = raw[lo:hi].tobytes().split()  # at the bytes that part words
        words[k] = len(parts)
        plain[k] = int.from_bytes(hashlib.blake2b(b" ".join(parts), digest_size=8, key=W.KEY).digest(), "little", signed=True)
    return [pa.array(words), pa.array(plain, mask=column.is_null().to_numpy(zero_copy_only=False))]


def measured(docs: DataFrame, sketches: bool = False) -> DataFrame:
    """A few numbers of each document: words, and the cluster of equal texts (letter case and white space aside); with ``sketches``
    also the columns of ``near_dedup.SKETCHED``. Texts are read once and not moved."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text", F.xxhash64("doc_id", "text", "source").alias("row_hash"))
    kind = SIZED + (", " + near_dedup.SKETCHED.partition(", ")[2]) * sketches
    names = [x.split()[0] for x in kind.split(", ")]

    @lean
    def run(batches):
        for batch in small(batches, 1024):
            more = near_dedup.sketch_columns(batch.column("text")) if sketches else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), batch.column("row_hash"), *measure_columns(batch.column("text")), *more], names)

    return picked.mapInArrow(run, kind)


def near_clusters(docs: DataFrame, sized: DataFrame | None = None) -> DataFrame:
    """(plain, near): the cluster of each text that has a word, so that near copies, and what they are near to in turn, share one.

    Rows without a doc_id are in a cluster with equal texts only. ``sized`` is a table of ``measured(docs, True)``, where it is at hand."""
    work = Workspace(docs.sparkSession, "clusters")
    sized = work.table(measured(docs, True), "sized") if sized is None else sized
    found = near_dedup.near_duplicates(docs, sketches=sized.select([x.split()[0] for x in near_dedup.SKETCHED.split(", ")])).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("component"))
    ids = sized.where("words > 0").select("doc_id", F.col("cluster").alias("plain"))
    named = work.table(ids.join(found, "doc_id", "left").select("plain", F.coalesce("component", "plain").alias("component")).distinct(), "named")
    first = work.table(named.groupBy("plain").agg(F.min("component").alias("first")), "first")
    links = work.table(named.join(first, "plain").where("component <> first").select(F.col("first").alias("a"), F.col("component").alias("b")).distinct(), "links")
    labels = components(work, links).select(F.col("node").alias("first"), F.col("component").alias("near"))
    near = work.table(first.join(labels, "first", "left").select("plain", F.coalesce("near", "first").alias("near")), "near")
    work.clear(near)
    return near


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None, group: int = GROUP, near: DataFrame | None = None, sized: DataFrame | None = None) -> DataFrame:
    """One row a piece: document, piece, words [start_word, start_word + n_words), bin and offset in it.

    ``cluster`` names a long column of duplicate clusters; without it, equal texts (letter case
    and white space aside) are a cluster, and with ``near`` (of ``near_clusters``) near copies too. What is shuffled
    is a few numbers a piece."""
    if cluster:
        words = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
        sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words.alias("words"), F.col(cluster).alias("cluster"), F.xxhash64("doc_id", "text", "source").alias("row_hash"))
    sized = Workspace(docs.sparkSession, "packing").table(measured(docs), "sized") if sized is None else sized
    count = F.greatest(F.ceil(F.col("words") / capacity).cast("long"), F.lit(1).cast("long"))
    groups = max(1, -(-(sized.agg(F.sum(count)).first()[0] or 0) // group))
    if near is not None and not cluster:
        sized = sized.join(near.withColumnRenamed("plain", "cluster"), "cluster", "left").withColumn("cluster", F.coalesce("near", "cluster")).drop("near")
    pieces = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("start_word"), F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity).cast("long").alias("n_words"), "cluster", "source", "row_hash"
    )
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "row_hash"), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInArrow(_packed(capacity), RESULT)
