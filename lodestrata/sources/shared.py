"""Checkpoints and tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

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


def folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def prepare(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))


def parts_for(rows: DataFrame, each: int) -> int:
    """How many partitions hold about ``each`` of ``rows`` at most, and no fewer than a shuffle has: so a task's share does not grow with the input."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // each))


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its rows written down: later steps read the same rows, whatever executor is lost."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str = "rows") -> DataFrame:
    """``df`` written down as Parquet, for loops: its size is that of the files. A checkpoint keeps the estimate of its plan, which a join multiplies, so
    that after some thirty rounds of joins with itself the driver multiplies numbers of many millions of digits."""
    at = folder(df.sparkSession, label)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
