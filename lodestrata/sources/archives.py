"""Zip archives as tables of their entries, without unpacking: ``spark.read.format("zip_entries").load(path)``.

The driver reads the archive's directory alone and deals its entries into partitions of about
``partition_bytes`` of unpacked size; each task opens the archive where it lies, in any file system that Arrow knows (local
and shared folders, object stores, HDFS), and reads its own entries. A lost task reads them again.

Columns: ``path`` (in the archive), ``length``, ``content``. Folders are no entries. ``root`` keeps what lies under one folder, with
paths from there on. An entry whose path leaves the archive (absolute, a drive, or ``..``), and an encrypted one, are
errors of the whole read: nothing of such an archive is used. A repeated path gives its last entry, as unpacking would.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, length long, content binary"
PARTITION_BYTES, BATCH_BYTES = 64 << 20, 8 << 20


def opened(path: str):
    """A file of any store that Arrow knows, for random access."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    store, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return store.open_input_file(inside)


def unsafe(name: str) -> bool:
    """Whether unpacking an entry of this name could write outside the archive's folder."""
    parts = name.replace("\\", "/").split("/")
    return name.startswith(("/", "\\")) or ".." in parts or ":" in parts[0] or "\0" in name


def entries(path: str) -> dict[str, tuple[int, int]]:
    """Size and place in the directory of each file of an archive."""
    with opened(path) as file, zipfile.ZipFile(file) as archive:
        found = {}
        for place, info in enumerate(archive.infolist()):
            if unsafe(info.filename):
                raise ValueError(f"unsafe path in {path}: {info.filename}")
            if info.flag_bits & 1:
                raise ValueError(f"encrypted entry in {path}: {info.filename}")
            if not info.is_dir():
                found[info.filename] = (info.file_size, place)
    return found


def single_root(path: str) -> str:
    """The one folder at an archive's root that holds everything, else an empty text."""
    tops = {name.split("/", 1)[0] if "/" in name else None for name in entries(path)}
    return tops.pop() if len(tops) == 1 and None not in tops else ""


@dataclass
class Entries(InputPartition):
    places: list[int]


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.root = options["path"], options.get("root", "").strip("/")
        self.limit = int(options.get("partition_bytes", PARTITION_BYTES))

    def partitions(self) -> list[InputPartition]:
        prefix = f"{self.root}/" if self.root else ""
        mine = sorted((place, size) for name, (size, place) in entries(self.path).items() if name.startswith(prefix))
        out, held, total = [], [], 0
        for place, size in mine:
            if held and total + size > self.limit:
                out.append(Entries(held))
                held, total = [], 0
            held.append(place)
            total += size
        return [*out, Entries(held)] if held or not out else out

    def read(self, partition: Entries) -> Iterator[pa.RecordBatch]:
        names, cells, total = [], [], 0
        skip = len(self.root) + 1 if self.root else 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([n[skip:] for n in names], pa.string()), pa.array([len(c) for c in cells], pa.int64()), pa.array(cells, pa.binary())], ["path", "length", "content"])
        with opened(self.path) as file, zipfile.ZipFile(file) as archive:
            infos = archive.infolist()
            for place in partition.places:
                names.append(infos[place].filename)
                cells.append(archive.read(infos[place]))
                total += len(cells[-1])
                if total >= BATCH_BYTES:
                    yield batch()
                    names, cells, total = [], [], 0
        if names:
            yield batch()


class ZipEntries(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_entries"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipEntries)
