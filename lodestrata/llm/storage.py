"""Tables in the folder that driver and executors share.

A written table cuts lineage and survives lost executors: the files lie in the folder that
``spark.checkpoint.dir`` names, and a task that is run again reads or writes them again.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ARROW_ROWS, WRITE_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
"""Rows of long texts go to Python in batches of at most so many while tables are written."""

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one of our own on this machine, which only a local master may use."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="lodestrata-")
    return _own[app]


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


@contextlib.contextmanager
def scope(spark: SparkSession):
    """Workspaces opened inside are deleted at the end: for steps whose result is written by then."""
    roots: list[str] = []
    token = _scopes.set((*_scopes.get(), roots))
    try:
        yield
    finally:
        _scopes.reset(token)
        for root in roots:
            delete(spark, root)


class Workspace:
    """Intermediate tables of one run of an operator."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self._count, self._paths = 0, []
        for roots in _scopes.get():
            roots.append(self.root)

    def table(self, df: DataFrame, name: str, rows: int = WRITE_ROWS) -> DataFrame:
        """Write ``df`` as Parquet and return a frame that reads it; Python gets at most ``rows`` rows at once."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        held = self.spark.conf.get(ARROW_ROWS)
        self.spark.conf.set(ARROW_ROWS, str(min(int(held), rows) if int(held) > 0 else rows))
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(ARROW_ROWS, held)
        found = self.spark.read.schema(df.schema).parquet(path)
        found._lodestrata_path = path
        self._paths.append(path)
        return found

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later step reads."""
        path = getattr(df, "_lodestrata_path", None)
        if path in self._paths:
            self._paths.remove(path)
            delete(self.spark, path)

    def clear(self, *kept: DataFrame) -> None:
        """Delete all tables but those that the result still reads."""
        left = {getattr(df, "_lodestrata_path", None) for df in kept}
        for path in [p for p in self._paths if p not in left]:
            self._paths.remove(path)
            delete(self.spark, path)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
