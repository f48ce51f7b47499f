"""Token-ID files of patched frame-of-reference blocks.

A segment is a header, the index of block starts, the index of documents, then blocks of ``BLOCK`` ids. A block
subtracts its minimum, packs the differences at the width that holds ``PERCENTILE`` of them, and keeps
the others whole in an exception list (positions and differences). A file holds up to ``FILE_SEGMENTS`` segments,
each ended by one newline byte.

Segment (little-endian): magic ``PFR2``; u32 part, u32 number in the part, u64 ids of the part before it; u32 documents, u32 ids,
u32 blocks, u64 bytes of the segment; u32 start of each block; per document i64 id, u8 null flag,
u32 ids; blocks: u32 minimum, u16 ids, u8 width, u16 exceptions, the packed u64 words, u16 positions, u32 differences.

``write_tokens`` orders documents by id (nulls first; equal ids by text), encodes each range of them in one
task and gives segments; ``write_files`` puts them down as files in any store that Spark writes, through
Spark's committer, so a task that is lost writes again without leaving halves; ``read_files`` reads the files, and
``read_tokens`` decodes segments. Nothing of it goes to the driver.

The tokenizer file is checked: where it is a byte-level BPE without normalizer, dropout or prefix space, a text's ids are those of
the pieces of its pre-tokenizer, and pieces met before come from a memory that compares their bytes; any other
file encodes every text whole.

Null and empty texts have the end id alone; a text of any length is one document; an empty
table gives an empty table of segments; extra columns play no part.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.llm import wordhash as W
from lodestrata.llm.memory import lean
from lodestrata.llm.storage import Workspace

BLOCK, PERCENTILE, SEGMENT_IDS, FILE_SEGMENTS = 1024, 95, 1 << 18, 32
RANGE_BYTES = 512 << 20
"""Bytes of the input's files that a range of documents stands for, at most; small inputs have Spark's number of shuffle partitions."""
MAGIC, HEAD = b"PFR2", struct.Struct("<4sIIQIIIQ")
GROUP = 64

# Byte classes of the pre-tokenizer (letter, digit, other, blank, other white space).
LETTER, DIGIT, OTHER, BLANK, WHITE = 0, 1, 2, 3, 4
_CLASS = np.full(256, OTHER, dtype=np.uint8)
_CLASS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = LETTER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[0x20] = BLANK
_CLASS[[0x09, 0x0A, 0x0D]] = WHITE
_STRANGE = np.zeros(256, dtype=bool)
_STRANGE[[*range(0x00, 0x09), 0x0B, 0x0C, *range(0x0E, 0x20), 0x27, 0x7F, 0xC0, 0xC1, 0xC2, *range(0xC6, 0x100)]] = True
"""Bytes of texts that the library encodes whole: controls, the apostrophe, letters beyond U+017F."""


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) differences below 2**width as (blocks, BLOCK * width / 64) words."""
    blocks = len(values)
    lanes = np.ascontiguousarray(values.reshape(-1, GROUP).T.astype(np.uint64))
    out = np.zeros((width, lanes.shape[1]), dtype=np.uint64)
    for k in range(GROUP):
        word, shift = divmod(k * width, 64)
        out[word] |= lanes[k] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(blocks, -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    blocks = len(words)
    lanes = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.empty((GROUP, lanes.shape[1]), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k in range(GROUP):
        word, shift = divmod(k * width, 64)
        out[k] = lanes[word] >> np.uint64(shift)
        if shift + width > 64:
            out[k] |= lanes[word + 1] << np.uint64(64 - shift)
        out[k] &= mask
    return np.ascontiguousarray(out.T).reshape(blocks, -1)


def encode_segment(ids: np.ndarray, doc_ids: list[int | None], sizes: list[int], part: int = 0, number: int = 0, first: int = 0) -> bytes:
    """The segment of these documents' ids (unsigned 32-bit), with its place in the order."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, ids[-1] if n else 0, dtype=np.uint32)
    padded[:n] = ids
    table = padded.reshape(blocks, BLOCK)
    low = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    delta = table - low[:, None]
    cut = np.sort(delta, axis=1)[:, BLOCK * PERCENTILE // 100] if blocks else low
    widths = np.array([int(x).bit_length() for x in cut], dtype=np.int64)
    limit = (np.uint64(1) << widths.astype(np.uint64)).astype(np.uint64)
    above = delta.astype(np.uint64) >= limit[:, None]
    packed: list[bytes] = [b""] * blocks
    for width in np.unique(widths[widths > 0]).tolist():
        mine = np.flatnonzero(widths == width)
        words = _pack(np.where(above[mine], 0, delta[mine]), width)
        for k, row in zip(mine.tolist(), words, strict=True):
            packed[k] = row.tobytes()
    body, starts, at = [], [], 0
    for k in range(blocks):
        places = np.flatnonzero(above[k]).astype(np.uint16)
        held = min(BLOCK, n - k * BLOCK)
        block = struct.pack("<IHBH", int(low[k]), held, int(widths[k]), len(places)) + packed[k] + places.tobytes() + delta[k][places].astype(np.uint32).tobytes()
        starts.append(at)
        body.append(block)
        at += len(block)
    index = b"".join(struct.pack("<qBI", 0 if d is None else d, d is None, s) for d, s in zip(doc_ids, sizes, strict=True))
    rest = np.array(starts, dtype=np.uint32).tobytes() + index + b"".join(body)
    return HEAD.pack(MAGIC, part, number, first, len(sizes), n, blocks, HEAD.size + len(rest)) + rest


def segments_of(content) -> list[memoryview]:
    """The segments of a file, each a view of its bytes."""
    out, at, content = [], 0, memoryview(content)
    while at < len(content):
        magic, *_, size = HEAD.unpack_from(content, at)
        if magic != MAGIC or content[at + size : at + size + 1] != b"\n":
            raise ValueError("not a token file")
        out.append(content[at : at + size])
        at += size + 1
    return out


def decode_segment(image: bytes) -> tuple[np.ndarray, list[int | None], list[int]]:
    """(ids, document ids, ids of each document) of a segment."""
    magic, _, _, _, docs, n, blocks, _ = HEAD.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size
    starts = np.frombuffer(image, np.uint32, blocks, at)
    at += 4 * blocks
    index = list(struct.iter_unpack("<qBI", image[at : at + 13 * docs]))
    at += 13 * docs
    heads = [struct.unpack_from("<IHBH", image, at + int(s)) for s in starts]
    widths = np.array([h[2] for h in heads], dtype=np.int64)
    delta = np.zeros((blocks, BLOCK), dtype=np.uint64)
    for width in np.unique(widths[widths > 0]).tolist():
        mine = np.flatnonzero(widths == width)
        words = np.stack([np.frombuffer(image, np.uint64, BLOCK * width // 64, at + int(starts[k]) + 9) for k in mine])
        delta[mine] = _unpack(words, width)
    for k, (_, _, width, more) in enumerate(heads):
        if more:
            begin = at + int(starts[k]) + 9 + BLOCK * width // 8
            delta[k][np.frombuffer(image, np.uint16, more, begin)] = np.frombuffer(image, np.uint32, more, begin + 2 * more)
    low = np.array([h[0] for h in heads], dtype=np.uint64)
    ids = (delta + low[:, None]).astype(np.uint32).reshape(-1)[:n]
    return ids, [None if null else d for d, null, _ in index], [s for _, _, s in index]


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each run, one run after another."""
    end = np.cumsum(size)
    return np.arange(int(end[-1]) if len(end) else 0) + np.repeat(first - (end - size), size)


def piecewise(tokenizer) -> bool:
    """Whether a text's ids are those of its byte-level pieces in a row, by the tokenizer's own description."""
    said = json.loads(tokenizer.to_str())
    cut, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
    plain = said.get("normalizer") is None and said.get("truncation") is None and said.get("padding") is None and said.get("post_processor") is None
    return bool(plain and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space", True) and cut.get("use_regex", True) and model.get("type") == "BPE" and not model.get("dropout")
                and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in said.get("added_tokens", [])))


class PieceEncoder:
    """The tokenizer with a memory of pieces.

    A byte-level BPE encodes each piece of its pre-tokenizer alone, so the ids of a text are
    those of its pieces in a row. Pieces of a slice of bytes are found in numpy and known by their
    bytes; the library encodes a piece when it is first met. Texts with a special token's string or with a byte
    in ``_STRANGE`` go to the library whole, and so do all texts of a tokenizer that is not ``piecewise``."""

    LIMIT, LIMIT_BYTES = 1_000_000, 1 << 25
    """Pieces remembered (about 60 bytes each), and bytes of them; beyond it, the memory starts anew."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.piecewise = piecewise(self.tokenizer)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self):
        self.keys, self.place = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)  # sorted hashes of the pieces known, and their numbers
        self.text, self.text_end = np.zeros(1 << 16, dtype=np.uint8), np.zeros(1, dtype=np.int64)  # their bytes
        self.ids, self.ids_end = np.zeros(1 << 16, dtype=np.uint32), np.zeros(1, dtype=np.int64)  # their ids

    @staticmethod
    def _put(flat: np.ndarray, end: np.ndarray, more: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``flat`` and ``end`` with the runs of ``more`` (of these sizes) behind them."""
        used = int(end[-1])
        while used + len(more) > len(flat):
            flat = np.concatenate((flat, np.zeros_like(flat)))
        flat[used : used + len(more)] = more
        return flat, np.concatenate((end, used + np.cumsum(size)))

    def _learn(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, keys: np.ndarray) -> None:
        """Remember the pieces at these places, whose hashes differ and are new."""
        raw = data.tobytes()
        found = [x.ids for x in self.tokenizer.encode_batch_fast([raw[b:e].decode() for b, e in zip(begin.tolist(), end.tolist(), strict=True)], add_special_tokens=False)]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        first = len(self.text_end) - 1
        self.ids, self.ids_end = self._put(self.ids, self.ids_end, np.fromiter((i for x in found for i in x), dtype=np.uint32, count=int(size.sum())), size)
        self.text, self.text_end = self._put(self.text, self.text_end, data[_runs(begin, end - begin)], end - begin)
        order = np.argsort(keys)
        where = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, where, keys[order])
        self.place = np.insert(self.place, where, (first + order).astype(np.int32))

    def _known(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each piece in the memory, whether it is there, by hash and then by its bytes)."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        number = self.place[at].astype(np.int64)
        size, first = end - begin, self.text_end[number]
        same = (self.keys[at] == keys) & (self.text_end[number + 1] - first == size)
        some = np.flatnonzero(same)
        equal = data[_runs(begin[some], size[some])] == self.text[_runs(first[some], size[some])]
        wrong = np.repeat(some, size[some])[~equal]
        same[wrong] = False
        return number, same

    @staticmethod
    def _pieces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, row) of the pre-tokenizer's pieces; rows fill ``data`` without gaps."""
        n = len(data)
        if n == 0:
            empty = np.zeros(0, dtype=np.int64)
            return empty, empty, empty
        kind = _CLASS[data]
        white = kind >= BLANK
        first = np.zeros(n + 1, dtype=bool)
        first[starts] = True
        first[0] = first[n] = True
        before, after_white = np.concatenate(([OTHER], kind[:-1])), np.concatenate((white[1:], [True]))
        begins_white = white & (first[:n] | ~np.concatenate(([False], white[:-1])))
        last_white = white & ~after_white & ~first[1:]  # white space with a piece behind it, in the same text
        begins_run = ~white & (first[:n] | ((kind != before) & (before != BLANK)))
        begin = np.flatnonzero(first[:n] | begins_white | last_white | begins_run)
        end = np.append(begin[1:], n)
        return begin, end, np.searchsorted(starts, begin, side="right") - 1

    def encode_column(self, column) -> list[np.ndarray]:
        """The ids of each text of an Arrow column; a null counts as an empty text."""
        raw, offsets = W.buffers(column)
        out: list[np.ndarray] = []
        for lo, hi in W.slices(offsets, 1 << 21):
            out += self._slice(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        return out

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        n = len(offsets) - 1
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * n
        odd = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(_STRANGE[data] | (np.concatenate(([0], data[:-1])) == 0xC3) & ((data == 0x97) | (data == 0xB7)), out=odd[1:])
        whole = (odd[offsets[1:]] - odd[offsets[:-1]]) > 0 if self.piecewise else np.ones(n, dtype=bool)
        bytes_ = data.tobytes()
        for mark in self.special:
            place = bytes_.find(mark)
            while place >= 0:
                whole[np.searchsorted(offsets, place, side="right") - 1] = True
                place = bytes_.find(mark, place + 1)
        if (some := np.flatnonzero(whole)).size:
            texts = [bytes_[offsets[k] : offsets[k + 1]].decode() for k in some]
            for k, found in zip(some.tolist(), self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                out[k] = np.array(found.ids, dtype=np.uint32)
        begin, end, row = self._pieces(data, offsets[:-1])
        mine = ~whole[row]
        begin, end, row = begin[mine], end[mine], row[mine]
        if not len(begin):
            return out
        which, pieces, piece_end = W.named_codes(data, begin, end)
        piece_begin = np.append(0, piece_end)[:-1]
        keys = W.range_hash(pieces, piece_begin, piece_end)
        number, known = self._known(pieces, piece_begin, piece_end, keys)
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.LIMIT or self.text_end[-1] > self.LIMIT_BYTES:
                self._forget()
                known[:] = False
            fresh = np.flatnonzero(~known)
            _, once = np.unique(keys[fresh], return_index=True)
            fresh = fresh[once]
            if len(self.keys):  # a hash that is taken stays with its first piece
                fresh = fresh[self.keys[np.minimum(np.searchsorted(self.keys, keys[fresh]), len(self.keys) - 1)] != keys[fresh]]
            self._learn(pieces, piece_begin[fresh], piece_end[fresh], keys[fresh])
            number, known = self._known(pieces, piece_begin, piece_end, keys)
        if not known.all():  # two pieces of one hash: their texts go to the library whole
            rows = np.unique(row[~known[which]])
            for k, found in zip(rows.tolist(), self.tokenizer.encode_batch([bytes_[offsets[k] : offsets[k + 1]].decode() for k in rows], add_special_tokens=False), strict=True):
                out[k], whole[k] = np.array(found.ids, dtype=np.uint32), True
            mine = ~whole[row]
            which, row = which[mine], row[mine]
            if not len(row):
                return out
        first = self.ids_end[number][which]
        size = self.ids_end[number + 1][which] - first
        ids = self.ids[_runs(first, size)]
        per_row = np.bincount(row, weights=size, minlength=n).astype(np.int64)
        for k, part in enumerate(np.split(ids, np.cumsum(per_row)[:-1])):
            if not whole[k]:
                out[k] = part
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder_for(path: str) -> PieceEncoder:
    """One encoder a process and file: a worker that runs several tasks keeps its pieces. A task has one core, so the library has one thread."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


@lean
def _encoded(batches, path: str, end_id: int):
    """Segments of a partition's documents, in the order that they come."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    encoder = encoder_for(path)
    number, done, waiting, held, ids, sizes = 0, 0, 0, [], [], []

    def segment():
        nonlocal number, done, held, ids, sizes
        image = encode_segment(np.concatenate(ids), held, sizes, part, number, done)
        row = [[part], [number], [done], [sum(sizes)], [len(sizes)], [image]]
        number, done = number + 1, done + sum(sizes)
        held, ids, sizes = [], [], []
        return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.int32()), *(pa.array(x, pa.int64()) for x in row[2:5]), pa.array(row[5], pa.binary())], ["part", "segment", "first_id", "n_ids", "n_docs", "image"])

    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            sub = batch.slice(lo, 1024)
            for doc_id, found in zip(sub.column(0).to_pylist(), encoder.encode_column(sub.column(1)), strict=True):
                held.append(doc_id)
                ids.append(np.append(found, np.uint32(end_id)).astype(np.uint32))
                sizes.append(len(found) + 1)
                waiting += sizes[-1]
                if waiting >= SEGMENT_IDS:
                    yield segment()
                    waiting = 0
    if sizes:
        yield segment()


SEGMENTS = "part int, segment int, first_id long, n_ids long, n_docs long, image binary"


def ranges_for(docs: DataFrame) -> int:
    """Ranges of an input: by the size that Catalyst has from its files, at least Spark's shuffle partitions."""
    said = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return least if said >= 1 << 60 else max(least, -(-said // RANGE_BYTES))  # that much: Catalyst does not know


def write_tokens(docs: DataFrame, path: str, end_id: int = 2, ranges: int | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Segments of all documents in ascending order of ``key``; one shuffle, by range.

    ``path`` is the tokenizer file on every machine."""
    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = picked.repartitionByRange(ranges or ranges_for(picked), F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    return ordered.mapInArrow(lambda it: _encoded(it, path, end_id), SEGMENTS)


def write_files(segments: DataFrame, folder: str) -> None:
    """Put segments down as files in a folder of any store that Spark writes; a newline byte ends each segment."""
    plain = segments.select(F.col("image").cast("string").alias("value"))  # the bytes as they are
    plain.write.mode("append").option("maxRecordsPerFile", FILE_SEGMENTS).option("lineSep", "\n").option("compression", "none").text(folder)


@lean
def _split(batches):
    for batch in batches:
        for content in batch.column(0):
            for image in segments_of(content.as_buffer()):
                image = bytes(image)
                _, part, number, first, docs, n, _, _ = HEAD.unpack_from(image)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), *(pa.array([x], pa.int64()) for x in (first, n, docs)), pa.array([image], pa.binary())], ["part", "segment", "first_id", "n_ids", "n_docs", "image"])


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """The segments of all files of a folder."""
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_split, SEGMENTS)


DECODED = "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _numbers(image) -> pa.RecordBatch:
    """``DECODED`` of a segment's documents."""
    _, part, _, first, *_ = HEAD.unpack_from(image)
    ids, docs, sizes = decode_segment(image)
    size = np.array(sizes, dtype=np.int64)
    end = np.cumsum(size)
    raw = memoryview(np.ascontiguousarray(ids, dtype="<u4").tobytes())
    crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for e, s in zip(end.tolist(), sizes, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(first + end - size), pa.array(size), pa.array(crc, pa.int64())], [x.split()[0] for x in DECODED.split(", ")])


@lean
def _decoded(batches):
    for batch in batches:
        for image in batch.column("image"):
            yield _numbers(image.as_buffer())


@lean
def _decoded_files(batches):
    for batch in batches:
        for content in batch.column(0):
            for image in segments_of(content.as_buffer()):
                yield _numbers(image)


def _placed(decoded: DataFrame) -> DataFrame:
    """Decoded numbers with each document's start: those of a part come after the sum of the parts before it."""
    found = Workspace(decoded.sparkSession, "tokens").table(decoded, "decoded")
    sizes = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row a part of the writer
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.join(sizes.select("part", before.alias("before")), "part").select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from segments."""
    return _placed(segments.select("image").mapInArrow(_decoded, DECODED))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``read_tokens`` of all files of a folder, whose bytes are read once."""
    return _placed(spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_decoded_files, DECODED))


def export_files(segments: DataFrame, folder: str) -> DataFrame:
    """``write_files``, and the files that then lie in the folder: path (a local one without its scheme) and bytes."""
    write_files(segments, folder)
    listed = segments.sparkSession.read.format("binaryFile").load(folder)
    return listed.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.col("length").alias("n_bytes"))
