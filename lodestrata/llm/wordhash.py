"""Vectorised words, word hashes and n-gram hashes over the UTF-8 bytes of Arrow text columns.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``; those bytes never occur inside a
multi-byte UTF-8 sequence, so work on bytes equals work on characters. ``range_hash`` is the same in
every process: eight bytes a step, all bits mixed after each, ranges above ``LONG`` bytes by keyed blake2b. It is
fast and no secret: strings that collide can be made on purpose, so it finds candidates and sketches, and whatever makes two texts one
is confirmed on bytes or by a keyed digest of 64 bits or more. ``codes`` and ``exact_grams`` compare the
bytes themselves, within one call.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
"""Bytes of text handled at once; a longer text is a slice of its own."""

_STEPS = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F,
                   0xEB44ACCAB455D165, 0x9C6E6877736C46E3, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD],
                  dtype=np.uint64)

LONG, KEY = 64, b"word-hash"

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's last steps: a bijection that spreads all bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges (lo, hi) of at most ``limit`` bytes, at least one row each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def spans(cut: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs where ``cut`` is False, inside the rows [starts, ends): (begin, end, row)."""
    n = len(cut)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~cut
    first = np.zeros(n + 1, dtype=bool)
    first[starts] = True
    first[0] = True
    begin = np.flatnonzero(inside & (np.concatenate(([True], cut[:-1])) | first[:n]))
    last = np.zeros(n + 1, dtype=bool)
    last[ends] = True
    last[n] = True
    end = np.flatnonzero(inside & (np.concatenate((cut[1:], [True])) | last[1:])) + 1
    row = np.searchsorted(starts, begin, side="right") - 1
    return begin, end, row


def range_hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range; equal lengths up to 8 bytes never collide."""
    size = end - begin
    if not len(size):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = mix(size.astype(np.uint64) * _STEPS[0] + _STEPS[1])
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))  # the 8 bytes from each place on
    short = np.flatnonzero(size <= LONG)
    at, left = begin[short], size[short]
    while len(short):
        chunk = eight[at]
        few = left < 8
        chunk[few] &= (np.uint64(1) << (left[few].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[short] = mix(out[short] ^ chunk)
        more = left > 8
        short, at, left = short[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[begin[k] : end[k]], digest_size=8, key=KEY).digest(), "little")
    return out


def column(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of the ranges (in order, none over another) as a column."""
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[begin] += 1
    edge[end] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    offsets = np.zeros(len(begin) + 1, dtype=np.int64)
    np.cumsum(end - begin, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])


def _encoded(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.DictionaryArray:
    return column(data, begin, end).dictionary_encode()


def codes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers of the ranges (in order, none over another): equal where, and only where, the bytes are equal."""
    return _encoded(data, begin, end).indices.to_numpy().astype(np.int64)


def named_codes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``codes``, the bytes of all different ranges in a row, and where each ends."""
    found = _encoded(data, begin, end)
    _, offsets, raw = found.dictionary.buffers()
    ends = np.frombuffer(offsets, np.int64)[1 : len(found.dictionary) + 1]
    return found.indices.to_numpy().astype(np.int64), np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), ends


def _renumbered(values: np.ndarray) -> tuple[np.ndarray, int]:
    found = pa.array(values).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), len(found.dictionary)


def exact_grams(words: np.ndarray, n: int) -> np.ndarray:
    """Numbers of all windows of ``n`` codes: equal where, and only where, the windows are equal."""
    out, width = words, 1
    kinds = int(words.max()) + 1 if len(words) else 1
    while width < n and len(words) >= n:
        step = min(width, n - width)  # the window of width from 0 on, and that of width which ends the longer one
        m = len(out) - step
        out, more = _renumbered(out[:m] * kinds + out[step : step + m])
        width, kinds = width + step, more
    return out if len(words) >= n else np.zeros(0, np.int64)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` words, for all windows of the concatenation."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(m, np.uint64(n), dtype=np.uint64)
        for j in range(n):
            out = out + words[j : j + m] * _STEPS[j]
            out = out ^ (out >> np.uint64(29))
        return mix(out)
