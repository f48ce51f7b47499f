"""Order, windows, top-k and chunking. Every order ends in a unique or total key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.sources.shared import cut


def numbered(rows: DataFrame, *order: str, name: str = "number") -> DataFrame:
    """Consecutive numbers from 1 in ``order``, without gathering rows in one task.

    Rows are sorted by range; each partition counts its own, and only the partitions' sizes
    (one row each) are added up, as a table. The numbered rows are written down in between: a range's bounds
    are drawn anew each time they are computed."""
    spark = rows.sparkSession
    part = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    part = part.withColumn("__place", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33) + 1)
    part = cut(part)
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = part.groupBy("__part").agg(F.count("*").alias("n")).select("__part", before.alias("__before"))  # one row a partition
    return part.join(sizes, "__part").withColumn(name, F.col("__place") + F.col("__before")).drop("__part", "__place", "__before")


def sequential_ids(rows: DataFrame, name: str, pattern: str, *order: str) -> DataFrame:
    """An id such as COMP-0001 for every row, in ``order`` (which must be unique)."""
    return numbered(rows, *order, name="__number").withColumn(name, F.format_string(pattern, F.col("__number"))).drop("__number")


def top_k(rows: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each key; Spark limits each partition before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def ranged(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` sorted by ranges of ``order``, with ``part``, the range. Written down: a range's bounds are drawn anew each time they are computed."""
    return cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))


def _before(parts: DataFrame, value: Column, step, start: Column) -> DataFrame:
    """(part, carried): for each range what ``step`` has made of the values of all ranges before it. The ranges, one row each, become one array."""
    listed = parts.agg(F.array_sort(F.collect_list(F.struct("part", value.alias("v")))).alias("all"))
    placed = F.transform("all", lambda x, i: F.struct(x["part"].alias("part"), F.aggregate(F.slice("all", 1, i), start, lambda acc, y: step(acc, y["v"])).alias("carried")))
    return listed.select(F.inline(placed))


def bigrams(events: DataFrame, keys: list[str]) -> DataFrame:
    """(seq, sequence) of each event and the one before it, by ``seq`` within ``keys`` (all events, if none).

    Over all events, rows are sorted by ranges; the first of a range pairs with the last action of the ranges before it."""
    if keys:
        previous = F.lag("action").over(Window.partitionBy(*keys).orderBy("seq"))
        return events.withColumn("previous", previous).where("previous IS NOT NULL").select("seq", F.concat("previous", F.lit(" → "), "action").alias("sequence"))
    rows = ranged(events.select("seq", "action"), "seq")
    last = rows.groupBy("part").agg(F.max_by("action", "seq").alias("action"))
    carried = _before(last, F.col("action"), lambda _, v: v, F.lit(None).cast("string"))
    paired = rows.withColumn("previous", F.lag("action").over(Window.partitionBy("part").orderBy("seq"))).join(F.broadcast(carried), "part")  # a row a range
    return paired.withColumn("previous", F.coalesce("previous", "carried")).where("previous IS NOT NULL").select("seq", F.concat("previous", F.lit(" → "), "action").alias("sequence"))


def running_sum(rows: DataFrame, value: str, *order: str, name: str = "before") -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` (whole numbers) over all rows before, in ``order`` (which must be unique). No task holds all rows."""
    sorted_ = ranged(rows, *order)
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sorted_.groupBy("part").agg(F.sum(value).alias("s"))
    carried = _before(sums, F.col("s"), lambda acc, v: acc + F.coalesce(v, F.lit(0)), F.lit(0).cast("long"))
    return sorted_.withColumn("__inside", inside).join(F.broadcast(carried), "part").withColumn(name, F.col("carried") + F.col("__inside")).drop("part", "carried", "__inside")


def within_budget(rows: DataFrame, text: str, budget: int, *order: str) -> DataFrame:
    """The rows whose ``text`` begins within the first ``budget`` characters of all texts in ``order``, cut where the budget ends; adds ``start`` and ``cut``."""
    sized = rows.withColumn("__size", F.coalesce(F.length(text), F.lit(0)).cast("long"))
    placed = running_sum(sized, "__size", *order, name="start").where((F.col("start") < budget) & (F.col("__size") > 0))
    left = F.least(F.col("__size"), F.lit(budget) - F.col("start")).cast("int")
    return placed.withColumn("cut", F.col("__size") > left).withColumn(text, F.substr(F.col(text), F.lit(1), left)).drop("__size")


def chunk_starts(lines: Column, chunk: int, overlap: int) -> Column:
    """First lines (from 0) of overlapping windows over ``lines`` lines; the last window reaches the end."""
    step = max(1, chunk - overlap)
    return F.sequence(F.lit(0), F.greatest(lines - overlap - 1, F.lit(0)), F.lit(step))


def chunks(texts: DataFrame, chunk: int = 80, overlap: int = 10, text: str = "text") -> DataFrame:
    """``start_line, end_line, chunk_text`` of each window; an empty text has one, empty chunk."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    rows = texts.withColumn("__lines", lines).withColumn("__start", F.explode(chunk_starts(F.size("__lines"), chunk, overlap)))
    body = F.slice("__lines", F.col("__start") + 1, chunk)
    end = F.least(F.col("__start") + chunk, F.size("__lines")).cast("long")
    return rows.withColumns({"start_line": (F.col("__start") + 1).cast("long"), "end_line": end, "chunk_text": F.array_join(body, "\n")}).drop("__lines", "__start")
