"""Joins and lookups with stated winners.

Every operator that picks one of several partners names its order, with ties to the smallest
``seq``; none depends on the order in which rows arrive. Null keys match nothing. Names that
both sides have are told apart by the caller's column choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def longest_prefix(files: DataFrame, prefixes: DataFrame, path: str = "path", prefix: str = "prefix", carried: str = "project") -> DataFrame:
    """Each file with the longest of ``prefixes`` that is one of its folders (null if none); ties go to the smallest ``carried``.

    Folders above a file are few, so the theta join becomes an equi-join on them: no nested loop."""
    parts = F.split(path, "/")
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    above = files.withColumn("__folder", F.explode(folders))
    best = (
        above.join(prefixes.select(F.col(prefix).alias("__folder"), F.col(carried).alias("__found")), "__folder")
        .groupBy("seq").agg(F.min(F.struct((-F.length("__folder")).alias("n"), F.col("__found"))).alias("__best"))
    )
    return files.join(best, "seq", "left").withColumn(carried, F.col("__best.__found")).drop("__best")


def pick(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in ``order``: an ordered, repeatable dropDuplicates."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def best_component(components: DataFrame) -> DataFrame:
    """One component a name: production before tests, then higher confidence, then first."""
    return pick(components, ["name"], F.col("is_test"), F.desc("confidence"), F.col("seq"))


def aliases(components: DataFrame) -> DataFrame:
    """(alias, name): a component by its name, its name without a leading I, and its contract; the last writer wins."""
    own = F.array(F.col("name"), F.when(F.col("name").rlike("^I[A-Z]"), F.expr("substring(name, 2)")), F.col("contract"))
    rows = components.select("seq", "name", F.explode(F.array_compact(own)).alias("alias"))
    return rows.groupBy("alias").agg(F.max(F.struct("seq", "name")).alias("last")).select("alias", F.col("last.name").alias("name"))


def registrations(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(service, implementation): what a service resolves to; the last registration wins."""
    rows = edges.where("kind = 'di_registration'").join(known.withColumnRenamed("alias", "dst"), "dst")
    return rows.groupBy("src").agg(F.max(F.struct("seq", "name")).alias("last")).select(F.col("src").alias("service"), F.col("last.name").alias("implementation"))


def resolve(edges: DataFrame, known: DataFrame, registered: DataFrame, primitive: Column) -> DataFrame:
    """Adds ``resolved``: the target by registration, by alias, then both without a leading I; primitives stay null."""
    bare = F.when(F.col("dst").rlike("^I[A-Z]"), F.expr("substring(dst, 2)"))
    rows = edges.withColumn("__bare", bare)
    by = lambda frame, key, name, at: frame.select(F.col(key).alias(at), F.col(name).alias(f"{at}_{name}"))
    for frame, key, name in ((registered, "service", "implementation"), (known, "alias", "name")):
        for at in ("dst", "__bare"):
            rows = rows.join(by(frame, key, name, at), at, "left")
    found = F.coalesce("dst_implementation", "dst_name", "__bare_implementation", "__bare_name")
    return rows.select(*edges.columns, F.when(~primitive, found).alias("resolved"))


def top_candidates(injected: DataFrame, providers: DataFrame, on: str, k: int, ceiling: float) -> DataFrame:
    """The first ``k`` providers (by ``p_seq``) of each injected line, with the lower confidence of both, at most ``ceiling``.

    Each key keeps its first ``k`` providers before the join, since no line can take more of them: at most ``k`` rows come of an
    injected row, however many provide its type. Rows of one line that ask for several types are ranked together."""
    order = ["p_seq", "provider"]
    first = providers.withColumn("rank", F.row_number().over(Window.partitionBy(on).orderBy(*order))).where(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("seq", "src", "line").orderBy(*order))
    return injected.join(first, on).withColumn("rank", rank).where(F.col("rank") <= k).withColumn("confidence", F.least(F.lit(ceiling), "confidence", "p_confidence"))


def line_chunks(facts: DataFrame, chunks: DataFrame, k: int = 3) -> DataFrame:
    """Up to ``k`` chunks of a fact's file that hold its line; without a line, the file's first ``k``."""
    held = F.col("line").isNull() | F.col("line").between(F.col("start_line"), F.col("end_line"))
    met = facts.join(chunks, "file").where(held)
    rank = F.row_number().over(Window.partitionBy("fact_id").orderBy("start_line"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)


def member_of(rows: DataFrame, listed: DataFrame, name: str, members: str) -> DataFrame:
    """Rows whose ``name`` is in the comma list ``members`` of ``listed``: the list is split, so this is an equi-join."""
    parts = listed.withColumn(name, F.explode(F.split(members, r",\s*"))).dropDuplicates([name, *[c for c in listed.columns if c != members]])
    return rows.join(parts.drop(members), name)


def normal_path(path: Column) -> Column:
    """A path with ``.`` and ``..`` parts taken out."""
    parts = F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda p: (p != "") & (p != "."))
    step = lambda acc, p: F.when((p == "..") & (F.size(acc) > 0), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(p == "..", acc).otherwise(F.concat(acc, F.array(p)))
    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")


def endpoints_completed(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes, and each edge end that is none as an external system with its first edge's file."""
    ends = edges.select("seq", "file", F.explode(F.array("src", "dst")).alias("id"))
    extra = ends.join(nodes.select("id").distinct(), "id", "left_anti").groupBy("id").agg(F.min(F.struct("seq", "file")).alias("first"))
    return nodes.select("id", "type", "file").unionByName(extra.select("id", F.lit("external_system").alias("type"), F.col("first.file").alias("file")))


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change): modified, added or removed, by path and hash."""
    met = before.select("path", F.col("hash").alias("was")).join(after.select("path", F.col("hash").alias("now")), "path", "full_outer")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "modified")
    return met.select("path", change.alias("change")).where("change IS NOT NULL")
