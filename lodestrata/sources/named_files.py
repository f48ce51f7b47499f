"""Rows put down as files by name: ``df.write.format("named_files").option("path", folder).mode("append").save()``.

Rows are ``name string, content binary`` (a text is its UTF-8). Each task writes its rows into a folder of
its own attempt beside the target and hands over the names; only when all tasks are done are the files moved to
their names, and what other attempts left behind goes with the staging folder. A failed job leaves
nothing. Names and not contents pass through the driver; ``save`` deals the rows out by name and has one task move
what another has written, so there not even names do: one id a task does.

A name is a path under the folder; one that would leave it, or an empty one, is an error of the job. Two rows of one name are an error
too: which of them is meant must be decided before (``last_of_each``). A file that is there already is replaced.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from lodestrata.sources.archives import unsafe
from lodestrata.sources.shared import parts_for

SCHEMA = "name string, content binary"
NAMES_A_TASK = 4096
"""Files that one task writes, moves or reads, about."""
CHUNK = 16 << 20
"""Bytes of contents that are read into one batch, about."""


def store_of(folder: str):
    """(file system, path) of a folder in any store that Arrow knows."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "file:///" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def staging_of(folder: str) -> str:
    return f"{folder.rstrip('/')}.staging-{uuid.uuid4().hex}"


def remove(folder: str) -> None:
    from pyarrow import fs

    store, at = store_of(folder)
    if store.get_file_info(at).type == fs.FileType.Directory:
        store.delete_dir(at)


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    names: list[str]


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, folder: str, staging: str | None = None):
        """With ``staging``, files stay there when all tasks are done: ``save`` moves them."""
        self.folder = folder.rstrip("/")
        self.moves = staging is None
        self.staging = staging or staging_of(folder)

    def write(self, iterator: Iterator) -> Written:
        attempt = uuid.uuid4().hex
        store, root = store_of(f"{self.staging}/{attempt}")
        store.create_dir(root, recursive=True)
        names = []
        for row in iterator:
            name, content = row[0], row[1]
            if not name or unsafe(name) or name.endswith("/"):
                raise ValueError(f"no name of a file: {name!r}")
            with store.open_output_stream(f"{root}/{len(names)}") as file:
                file.write(bytes(content or b""))
            names.append(name)
        if self.moves:
            return Written(attempt, names)
        if len(set(names)) < len(names):
            raise ValueError(f"two rows are named {next(n for n, k in Counter(names).items() if k > 1)}")
        with store.open_output_stream(f"{root}/names") as file:
            file.write(json.dumps(names).encode())
        return Written(attempt, [])

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        if not self.moves:
            store, staging = store_of(self.staging)
            with store.open_output_stream(f"{staging}/attempts") as file:
                file.write(json.dumps([m.attempt for m in done]).encode())
            return
        every = [name for m in done for name in m.names]
        if len(set(every)) < len(every):
            self.abort(messages)
            twice = next(n for k, n in enumerate(every) if n in every[:k])
            raise ValueError(f"two rows are named {twice}")
        store, target = store_of(self.folder)
        _, staging = store_of(self.staging)
        store.create_dir(target, recursive=True)
        folders = {name.rpartition("/")[0] for name in every} - {""}
        for inner in sorted(folders):
            store.create_dir(f"{target}/{inner}", recursive=True)
        for m in done:
            for place, name in enumerate(m.names):
                store.move(f"{staging}/{m.attempt}/{place}", f"{target}/{name}")
        remove(self.staging)

    def abort(self, messages) -> None:
        """What is left of all attempts goes."""
        remove(self.staging)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], self.options.get("staging"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedFiles)


def last_of_each(rows: DataFrame, *order: str) -> DataFrame:
    """(name, content) of the last row of each name in ``order``."""
    return rows.groupBy("name").agg(F.max_by("content", F.struct(*order)).alias("content"))


def _mover(staging: str, folder: str) -> Callable[[str], None]:
    """Moves the files of one attempt to their names. A task that runs again leaves what is moved already."""

    def move(attempt: str) -> None:
        from pyarrow import fs

        store, target = store_of(folder.rstrip("/"))
        _, root = store_of(f"{staging}/{attempt}")
        with store.open_input_stream(f"{root}/names") as file:
            names = json.loads(file.read())
        for inner in sorted({name.rpartition("/")[0] for name in names}):
            store.create_dir(f"{target}/{inner}".rstrip("/"), recursive=True)
        for place, name in enumerate(names):
            try:
                store.move(f"{root}/{place}", f"{target}/{name}")
            except FileNotFoundError:
                if store.get_file_info(f"{target}/{name}").type != fs.FileType.File:
                    raise

    return move


def _reader(folder: str) -> Callable[[Iterator], Iterator]:
    """Batches of (name) to batches of (name, content)."""

    def read(batches):
        import pandas as pd

        store, target = store_of(folder.rstrip("/"))
        for batch in batches:
            names, contents, size = [], [], 0
            for name in batch["name"]:
                with store.open_input_stream(f"{target}/{name}") as file:
                    content = file.read()
                names.append(name)
                contents.append(content)
                size += len(content)
                if size >= CHUNK:
                    yield pd.DataFrame({"name": names, "content": contents})
                    names, contents, size = [], [], 0
            yield pd.DataFrame({"name": names, "content": contents})

    return read


def _check(names: DataFrame) -> None:
    """Raises before anything is written if a name is none, or is there twice."""
    name, path = F.col("name"), F.replace(F.col("name"), F.lit("\\"), F.lit("/"))
    bad = name.isNull() | (name == "") | path.rlike(r"^/|/$|^[^/]*:|(?:^|/)\.\.(?:/|$)") | name.contains("\0")
    found = names.groupBy("name").count().agg(F.max(F.when(bad, F.coalesce(name, F.lit("null")))).alias("bad"), F.max(F.when(F.col("count") > 1, name)).alias("twice")).first()
    if found["bad"] is not None:
        raise ValueError(f"no name of a file: {found['bad']!r}")
    if found["twice"] is not None:
        raise ValueError(f"two rows are named {found['twice']}")


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` in partitions by name whose size does not grow with their number."""
    return rows.repartition(parts_for(rows.select("name"), NAMES_A_TASK), "name")


def save(rows: DataFrame, folder: str) -> None:
    """Put rows (name, content) down as files; names must differ."""
    spark, staging = rows.sparkSession, staging_of(folder)
    register(spark)
    _check(rows.select("name"))
    content = dealt(rows.select("name", F.col("content").cast("binary").alias("content")))
    content.write.format("named_files").option("path", folder).option("staging", staging).mode("append").save()
    try:
        store, at = store_of(staging)
        with store.open_input_stream(f"{at}/attempts") as file:
            attempts = json.loads(file.read())
        store.create_dir(store_of(folder.rstrip("/"))[1], recursive=True)
        spark.sparkContext.parallelize(attempts, max(len(attempts), 1)).foreach(_mover(staging, folder))
    finally:
        remove(staging)


def contents(names: DataFrame, folder: str) -> DataFrame:
    """(name, content) of these files of a folder, opened by name in the tasks: a folder of millions of files is not listed. A missing file is an error."""
    return dealt(names.select("name")).mapInPandas(_reader(folder), SCHEMA)
