"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from its code point, so that every
process draws the same). A letter n-gram is bound from its letters' vectors, each rotated by
its place in the n-gram; a text bundles (adds) the vectors of all its n-grams; a language's
prototype bundles its training texts, each scaled to length 1. A text gets the language whose
prototype has the largest cosine with the text's own vector.

Letters are lower-cased code points that are alphabetic; every run of other characters is one
blank, as are both ends of a text. Whole texts are read.

- ``und`` with score 0: a null text, an empty one, one without a letter, or no language learned.
- Ties between languages go to the smaller name. Repeated rows get equal results.
- Rows with a null language, a null text or a text without a letter teach nothing.
- An empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.memory import lean, small

DIMENSIONS, ORDER, SEED = 1024, 3, 20240229
"""The noise of a cosine has a deviation of 1 / sqrt(DIMENSIONS); README has held-out accuracies by dimensions."""
UNKNOWN = "und"
CHUNK_CHARS, CHUNK_TEXTS = 1 << 19, 256
"""Characters and texts handled at once. A longer text goes on in the next chunk: the last symbols are carried over, so
its vector is the same as if it were read at once."""
GRAMS, DIRECT = 4096, 1 << 22
"""Distinct n-grams whose vectors are held at once, and codes up to which they are found by a table and not by sorting: both
bound memory alone."""

FAN_IN = 256
"""Groups that the tasks' sums of a language are added in first."""

_SYMBOLS = 0x110000


class Encoder:
    """Turns texts into bundled n-gram vectors; its tables grow with the letters met."""

    def __init__(self):
        self.ids = np.full(_SYMBOLS, -1, dtype=np.int32)  # code point -> symbol; 0 is the blank
        self.rotated = [self._drawn(0, j)[None] for j in range(ORDER)]  # each letter's vector, by place in the n-gram

    @staticmethod
    def _drawn(point: int, place: int) -> np.ndarray:
        return np.roll(np.random.default_rng([SEED, point]).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1, place)

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        found = self.ids[points]
        if (found < 0).any():
            fresh = []
            for point in np.unique(points[found < 0]).tolist():
                letter = chr(point).isalpha()
                self.ids[point] = len(self.rotated[0]) + len(fresh) if letter else 0
                fresh += [point] * letter
            if fresh:
                self.rotated = [np.vstack([self.rotated[j], *(self._drawn(point, j) for point in fresh)]) for j in range(ORDER)]
            found = self.ids[points]
        return found

    def bundles(self, texts: int, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The sums of the vectors of all n-grams of each of ``texts`` rows of symbols."""
        out = np.zeros((texts, DIMENSIONS), dtype=np.float64)
        m, width = len(symbol) - ORDER + 1, len(self.rotated[0])
        if m <= 0:
            return out
        code, blank = np.zeros(m, dtype=np.int32 if width**ORDER < 1 << 31 else np.int64), np.ones(m, dtype=bool)
        for j in range(ORDER):
            code *= width
            code += symbol[j : j + m]
            blank &= symbol[j : j + m] == 0
        inside = (row[:m] == row[ORDER - 1 :]) & ~blank
        code, at = code[inside], row[:m][inside]
        if width**ORDER <= DIRECT:
            met = np.zeros(width**ORDER, dtype=bool)
            met[code] = True
            gram = np.flatnonzero(met)
            number = np.cumsum(met, dtype=np.int32) - 1
            where = number[code]
        else:
            gram, where = np.unique(code, return_inverse=True)
        if len(gram) > GRAMS:
            block = (where // GRAMS).astype(np.uint16)  # at most one n-gram a character of a chunk
            order = np.argsort(block, kind="stable")
            where, at = where[order], at[order]
            edge = np.append(0, np.cumsum(np.bincount(block)))
        else:
            edge = np.array([0, len(where)])
        for block, (lo, hi) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            some = gram[block * GRAMS : (block + 1) * GRAMS]
            counts = np.bincount(at[lo:hi] * len(some) + (where[lo:hi] - block * GRAMS), minlength=texts * len(some)).astype(np.float32).reshape(texts, len(some))
            bound = self.rotated[ORDER - 1][some % width]
            for j in range(ORDER - 2, -1, -1):
                some = some // width
                bound = bound * self.rotated[j][some % width]
            out += counts @ bound.astype(np.float32)  # whole numbers below 2**24: exact
        return out

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bundle of each text, whether it has a letter)."""
        texts = [x.lower() for x in texts]
        joined = ("\n" + "\n\n".join(texts) + "\n") if texts else ""
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.array([len(x) + 2 for x in texts], dtype=np.int64)
        row = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        symbol = self._symbols(points)
        first = np.zeros(len(symbol), dtype=bool)
        first[np.cumsum(lengths)[:-1]] = True
        keep = np.concatenate(([True], (symbol[1:] != 0) | (symbol[:-1] != 0) | first[1:])) if len(symbol) else np.zeros(0, bool)
        symbol, row = symbol[keep], row[keep]
        return self.bundles(len(texts), symbol, row), np.bincount(row[symbol > 0], minlength=len(texts)) > 0

    def long_vector(self, text: str) -> tuple[np.ndarray, bool]:
        """``vectors`` of one text, in chunks that carry the last symbols over."""
        text = text.lower()
        out, has, held = np.zeros(DIMENSIONS), False, np.zeros(1, np.int32)
        for lo in range(0, len(text) + 1, CHUNK_CHARS):
            part = text[lo : lo + CHUNK_CHARS]
            last = lo + CHUNK_CHARS > len(text)
            symbol = np.concatenate((held, self._symbols(np.frombuffer((part + "\n" * last).encode("utf-32-le", "surrogatepass"), dtype=np.uint32))))
            fresh = np.concatenate(([True], (symbol[1:] != 0) | (symbol[:-1] != 0)))
            fresh[: len(held)] = True
            symbol = symbol[fresh]
            has |= bool((symbol > 0).any())
            out += self.bundles(1, symbol, np.zeros(len(symbol), np.int32))[0]
            held = symbol[-(ORDER - 1) :]
        return out, has


def _groups(texts: list[str | None]):
    """Runs of rows with at most CHUNK_CHARS characters; a longer text comes alone."""
    lo, size = 0, 0
    for k, text in enumerate(texts):
        n = len(text or "")
        if k > lo and (size + n > CHUNK_CHARS or k - lo >= CHUNK_TEXTS):
            yield lo, k
            lo, size = k, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def encode(encoder: Encoder, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1 (0 without a letter), and whether there is a letter."""
    out, has = np.zeros((len(texts), DIMENSIONS), dtype=np.float64), np.zeros(len(texts), dtype=bool)
    for lo, hi in _groups(texts):
        if hi - lo == 1 and len(texts[lo] or "") > CHUNK_CHARS:
            out[lo], has[lo] = encoder.long_vector(texts[lo])
        else:
            out[lo:hi], has[lo:hi] = encoder.vectors([x or "" for x in texts[lo:hi]])
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0), has


@lean
def _learned(batches):
    """The sum of each language's unit vectors over a partition, rounded to 1/2**20."""
    encoder, sums = Encoder(), {}
    for batch in small(batches, 2048):
        langs = batch.column(1).to_pylist()
        vectors, has = encode(encoder, batch.column(0).to_pylist())
        for lang in set(langs):
            mine = [k for k, x in enumerate(langs) if x == lang and has[k]]
            if mine:
                sums[lang] = sums.get(lang, 0) + np.rint(vectors[mine] * (1 << 20)).astype(np.int64).sum(axis=0)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([x.astype("<i8").tobytes() for x in sums.values()], pa.binary())], ["lang", "bundle"])


def _added(table: pa.Table) -> pa.Table:
    """The sum of a group's bundles, as its one row."""
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    for bundle in table["bundle"]:
        total += np.frombuffer(bundle.as_buffer(), "<i8")
    return pa.table({"lang": table["lang"][:1], "bundle": pa.array([total.tobytes()], pa.binary())})


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bundle binary): one sum of whole numbers a language, from all rows of ``docs``.

    Each task sends one vector a language; they are added in a tree of two levels, ``FAN_IN`` groups a language first, so no task
    gathers what all tasks sent. The sums are whole numbers: no order of tasks changes them."""
    parts = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInArrow(_learned, "lang string, bundle binary")
    some = parts.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(FAN_IN))).groupBy("lang", "group").applyInArrow(_added, "lang string, bundle binary")
    return some.groupBy("lang").applyInArrow(_added, "lang string, bundle binary")


@lean
def _predicted(batches, text: str, names: list[str], prototypes: np.ndarray):
    encoder = Encoder()
    for batch in small(batches, 2048):
        vectors, has = encode(encoder, batch.column(text).to_pylist())
        if len(names):
            cosine = np.round(vectors @ prototypes.T, 6)
            best = cosine.argmax(axis=1)
            score = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)
        else:
            best, score, has = np.zeros(len(has), int), np.zeros(len(has)), np.zeros(len(has), bool)
        found = [pa.array([names[b] if ok else UNKNOWN for b, ok in zip(best, has, strict=True)], pa.string()), pa.array(np.where(has, score, 0.0))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], ["doc_id", "lang_pred", "score"])


def model(prototypes: DataFrame) -> tuple[list[str], np.ndarray]:
    """The prototypes on the driver: one vector for each language."""
    rows = sorted(prototypes.collect(), key=lambda r: r["lang"])
    table = np.array([np.frombuffer(r["bundle"], "<i8") for r in rows], dtype=np.float64).reshape(len(rows), DIMENSIONS)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return [r["lang"] for r in rows], np.divide(table, norm, out=np.zeros_like(table), where=norm > 0)


def predict(docs: DataFrame, learned: tuple[list[str], np.ndarray], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score`` of every document; no shuffle."""
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    names, prototypes = learned
    return picked.mapInArrow(lambda it: _predicted(it, "__text", names, prototypes), f"doc_id {kind}, lang_pred string, score double")


def with_score(docs: DataFrame, learned: tuple[list[str], np.ndarray], name: str, text: str = "text") -> DataFrame:
    """``docs`` with one more column ``name``: the largest cosine with a language, -1 where none is recognised; no shuffle."""
    names, prototypes = learned

    @lean
    def scored(batches):
        encoder = Encoder()
        for batch in small(batches, 2048):
            vectors, has = encode(encoder, batch.column(text).to_pylist())
            best = np.round(vectors @ prototypes.T, 6).max(axis=1) if names else np.full(len(has), -1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.where(has, best, -1.0))], [*batch.schema.names, name])

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def filter_language(docs: DataFrame, learned: tuple[list[str], np.ndarray], least: float, text: str = "text") -> DataFrame:
    """The documents with a recognised language and at least this score, all columns as they were."""
    name = "__score"
    while name in docs.columns:
        name += "_"
    return with_score(docs, learned, name, text).where((F.col(name) >= least) & (F.col(name) > -1)).drop(name)
