"""Rollups: histograms, coupling, buckets, breakdowns.

Averages of confidences are taken over whole points (hundredths), so that no order of
summation changes a digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(histogram, key, n) in long form."""
    return rows.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).select(F.lit(name).alias("histogram"), F.col("key").cast("string").alias("key"), "n")


def mean_points(points: Column, default: float) -> Column:
    """The mean of confidences held as hundredths, to 3 digits; ``default`` over none."""
    return F.coalesce(F.round(F.sum(points).cast("double") / (F.count(points) * 100), 3), F.lit(default))


def composite(type_points: Column, module_points: Column, evidence: Column, uncertainty: Column) -> Column:
    """The composite confidence, from confidences in hundredths and counts."""
    penalty = F.least(F.lit(0.18), uncertainty * F.lit(0.04))
    raw = type_points / F.lit(100.0) * F.lit(0.62) + module_points / F.lit(100.0) * F.lit(0.28) + F.least(evidence, F.lit(4)) * F.lit(0.025) - penalty
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 3)


def coupling(edges: DataFrame) -> DataFrame:
    """(name, afferent, efferent, total): distinct neighbours of each node, in both directions."""
    into = edges.groupBy(F.col("dst").alias("name")).agg(F.count_distinct("src").alias("afferent"))
    out = edges.groupBy(F.col("src").alias("name")).agg(F.count_distinct("dst").alias("efferent"))
    both = into.join(out, "name", "full_outer").select("name", F.coalesce("afferent", F.lit(0)).alias("afferent"), F.coalesce("efferent", F.lit(0)).alias("efferent"))
    return both.withColumn("total", F.col("afferent") + F.col("efferent"))


def sorted_names(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), ",")


def module_buckets(components: DataFrame) -> DataFrame:
    """One row a module: what belongs to it, and how sure that is."""
    return components.groupBy("module").agg(
        F.count("*").alias("components"), F.count_distinct("file").alias("files"), sorted_names("component_type").alias("types"), sorted_names("layer").alias("layers"),
        mean_points(F.col("points"), 0.3).alias("confidence"),
    )


def step_summary(steps: DataFrame) -> DataFrame:
    """(label, runs, ok, failed, seconds) of step rows (label, returncode, duration); a null return code counts as failed."""
    good = F.coalesce(F.col("returncode") == 0, F.lit(False))
    return steps.groupBy("label").agg(F.count("*").alias("runs"), F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"), F.round(F.sum("duration"), 3).alias("seconds"))


def tag_run(rows: DataFrame, run_at: str) -> DataFrame:
    """Adds the run's time stamp (ISO-8601 text): one literal for the whole run, never the clock of a task."""
    return rows.withColumn("extraction_timestamp", F.lit(run_at))
