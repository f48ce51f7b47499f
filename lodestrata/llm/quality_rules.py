"""Quality rules by repetition coverage.

Words and lines are numbered by their bytes, so two count as equal only where they are. Rolling hashes of
several n-gram lengths over these numbers, in numpy, mark the words that lie inside n-grams found twice or more in the same text; the characters of those words, and of lines that
repeat an earlier line, are measured against all characters in words.

Definitions (per document):

- words are runs of ``[^\\x20\\x09-\\x0D]+``; a null text has none;
- ``word_chars``: code points in words; ``n_symbols``: characters of ``[#*$%&|<>]``;
- ``n_dup_lines``: lines (split at ``\\n``) that have a word and equal an earlier line;
- ``n_repeat_words``: words in 3-word windows found twice or more in the text;
- ``base_failed``: ``n_words < 50`` or ``100 * n_repeat_words > 50 * n_words``;
- ``kept``: not ``base_failed`` and no coverage above its limit in ``LIMITS``;
- ``symbols_failed``: more than ``SYMBOL_LIMIT`` symbols a word. A column of its own, which ``kept`` does not ask.

Ties and repeated rows: each row is judged alone, so equal rows get equal results. An empty
table gives an empty result. Extra columns of the input are not carried unless asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm import wordhash as W
from lodestrata.llm.memory import lean, small

LENGTHS = (5, 7, 10)

# Largest share of characters allowed inside duplicated n-grams (by length) and lines: the least round values that no document
# labelled good exceeds (sf0.1: 0.276, 0.276, 0.177 and 0.138 are their largest shares).
LIMITS = {5: 0.30, 7: 0.28, 10: 0.20, "lines": 0.15}
SYMBOL_LIMIT = 0.30
"""Symbols per word above which a text is junk."""

MIN_WORDS, REPEAT_WINDOW, REPEAT_SHARE = 50, 3, 0.5

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_share double, " + ", ".join(f"dup_{n}gram_share double" for n in LENGTHS) + ", base_failed boolean, kept boolean, symbols_failed boolean"
)
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_row(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def _keyed(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Keys that are equal where both hash and row are."""
    with np.errstate(over="ignore"):
        return W.mix(hashes ^ W.mix(rows.astype(np.uint64) + np.uint64(0x51ED270B)))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def covered(words: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Words that lie inside an n-gram found twice or more in their row."""
    mark = np.zeros(len(words), dtype=bool)
    if len(words) < n:
        return mark
    valid = np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :])
    begin = valid[_repeated(_keyed(W.grams(words, n)[valid], rows[valid]))]
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each row of a slice of bytes."""
    n = len(starts)
    space = W.SPACE[data]
    points = (data & 0xC0) != 0x80
    point_sum = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(points, out=point_sum[1:])
    begin, end, row = W.spans(space, starts, ends)
    words = W.mix(W.codes(data, begin, end).astype(np.uint64))  # equal for equal words alone
    chars = point_sum[end] - point_sum[begin]
    count = lambda mask, weight=None: np.bincount(row[mask], weights=None if weight is None else weight[mask], minlength=n)
    every = np.ones(len(words), dtype=bool)
    out = {"n_words": count(every).astype(np.int64), "word_chars": count(every, chars).astype(np.int64), "n_symbols": _per_row(_SYMBOL[data], starts, ends)}

    l_begin, l_end, l_row = W.spans(data == 10, starts, ends)
    per_line = np.searchsorted(begin, l_end) - np.searchsorted(begin, l_begin)
    some = per_line > 0
    l_begin, l_end, l_row = l_begin[some], l_end[some], l_row[some]
    lines = W.codes(data, l_begin, l_end)  # by their bytes
    keys = l_row * (int(lines.max()) + 1 if len(lines) else 1) + lines
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    out["n_dup_lines"] = np.bincount(l_row[again], minlength=n).astype(np.int64)
    word_sum = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(chars, out=word_sum[1:])
    line_chars = word_sum[np.searchsorted(begin, l_end)] - word_sum[np.searchsorted(begin, l_begin)]
    whole = np.maximum(out["word_chars"], 1)
    out["dup_line_share"] = np.bincount(l_row[again], weights=line_chars[again], minlength=n) / whole

    out["n_repeat_words"] = count(covered(words, row, REPEAT_WINDOW)).astype(np.int64)
    for k in LENGTHS:
        out[f"dup_{k}gram_share"] = count(covered(words, row, k), chars) / whole
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 100 * REPEAT_SHARE * out["n_words"])
    bad = out["dup_line_share"] > LIMITS["lines"]
    for k in LENGTHS:
        bad |= out[f"dup_{k}gram_share"] > LIMITS[k]
    out["kept"] = ~out["base_failed"] & ~bad
    out["symbols_failed"] = out["n_symbols"] > SYMBOL_LIMIT * out["n_words"]
    return out


@lean
def _measured(batches, text: str):
    for batch in small(batches, 2048):
        raw, offsets = W.buffers(batch.column(text))
        keep = [k for k in range(batch.num_columns) if batch.schema.names[k] != text]
        parts = []
        for lo, hi in W.slices(offsets):
            at = offsets[lo:hi] - offsets[lo]
            parts.append(measure(raw[offsets[lo] : offsets[hi]], at, offsets[lo + 1 : hi + 1] - offsets[lo]))
        if not parts:
            continue
        found = [pa.array(np.concatenate([p[name] for p in parts])) for name in NAMES]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *found], [*(batch.schema.names[k] for k in keep), *NAMES])


def measure_quality(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and the measures of every document. Needs no shuffle."""
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(lambda it: _measured(it, "__text"), f"doc_id {kind}, {SCHEMA}")


@lean
def _filtered(batches, text: str):
    for batch in small(batches, 2048):
        raw, offsets = W.buffers(batch.column(text))
        parts = []
        for lo, hi in W.slices(offsets):
            at = offsets[lo:hi] - offsets[lo]
            parts.append(measure(raw[offsets[lo] : offsets[hi]], at, offsets[lo + 1 : hi + 1] - offsets[lo])["kept"])
        if parts:
            yield batch.filter(pa.array(np.concatenate(parts)))


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents whose ``kept`` is true, all columns as they were. Needs no shuffle."""
    return docs.mapInArrow(lambda it: _filtered(it, text), docs.schema)
