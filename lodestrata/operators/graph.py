"""Graph operators over edge tables (src, dst).

Loops run on the DataFrame API: each round is a join, its rows are written down, and only counts reach the
driver. Self-loops and repeated edges don't matter unless stated; an empty graph gives empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.windows import top_k
from lodestrata.sources.shared import cut, parts_for, written


def _least_reaching(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(node, label): for every node of ``edges`` the smallest node from which it can be reached, itself included.

    A round takes the labels of the nodes before and then the label of the label, so what is known of a path about doubles each time."""
    labels = cut(edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("label", F.col("node")))
    while True:
        got = edges.join(labels.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(F.min("label").alias("got"))
        near = labels.join(got, "node", "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("got", "label")).alias("label"))
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = cut(near.join(further, "label").select("node", "old", F.least("label", "further").alias("label")))
        if rounds is not None:
            rounds.append(1)
        labels = new.select("node", "label")
        if not new.where("label < old").limit(1).count():
            return labels


def strong_components(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(node, scc): the strongly connected components of two nodes or more, each named by its smallest node.

    Every node learns the smallest node that reaches it and the smallest that it reaches. Where both are the same, that is its component.
    Nodes of one component agree in both, so edges between nodes that differ are dropped, and what is left goes round again:
    each round settles the smallest node of every remaining part. ``rounds`` gets an entry for each step of labels."""
    edges = cut(edges.where("src <> dst").select("src", "dst").distinct())
    found = None
    while edges.limit(1).count():
        ahead, back = _least_reaching(edges, rounds), _least_reaching(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), rounds)
        known = cut(ahead.join(back.withColumnRenamed("label", "reached"), "node"))
        done = known.where("label = reached").select("node", F.col("label").alias("scc"))
        found = done if found is None else found.unionByName(done)
        left = known.where("label <> reached")
        side = lambda s: left.select(F.col("node").alias(s), F.col("label").alias(f"l_{s}"), F.col("reached").alias(f"r_{s}"))
        edges = cut(edges.join(side("src"), "src").join(side("dst"), "dst").where("l_src = l_dst AND r_src = r_dst").select("src", "dst"))
    if found is None:
        return edges.select(F.col("src").alias("node"), F.col("src").alias("scc"))
    many = found.groupBy("scc").agg(F.count("*").alias("n")).where("n > 1")
    return found.join(many, "scc").select("node", "scc")


def weak_components(edges: DataFrame) -> DataFrame:
    """(node, part): every node of ``edges`` with the smallest node that edges of either direction connect it with.

    Every node goes to its smallest neighbour, if that is smaller, and labels of labels lead to where these ways end. The ends are the nodes of a smaller graph,
    which goes the same way: two such rounds leave at most half of the nodes, so only the first reads all edges."""
    labels, left = None, edges
    while True:
        both = left.select(F.inline(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))))
        near = written(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("part")).select("node", F.least("node", "part").alias("part")))
        while True:
            further = near.select(F.col("node").alias("part"), F.col("part").alias("further"))
            new = written(near.join(further, "part").select("node", F.col("further").alias("part"), (F.col("further") < F.col("part")).alias("moved")))
            near = new.select("node", "part")
            if not new.where("moved").limit(1).count():
                break
        to = lambda c: near.select(F.col("node").alias(c), F.col("part").alias(f"to_{c}"))
        labels = near if labels is None else written(labels.join(to("part"), "part", "left").select("node", F.coalesce("to_part", "part").alias("part")))
        left = written(left.join(to("src"), "src").join(to("dst"), "dst").where("to_src <> to_dst").select(F.col("to_src").alias("src"), F.col("to_dst").alias("dst")).distinct())
        if not left.limit(1).count():
            return labels


def label_communities(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """(node, community): each node takes its neighbours' most frequent label (ties: the smallest), ``rounds`` times.

    The method is this engine's own; a community's cohesion is its inner edges over the possible ones."""
    one_way = cut(edges.where("src <> dst").select("src", "dst"))
    shares = parts_for(one_way, EDGES_A_PART)
    both = one_way.unionByName(one_way.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    # shares do not grow with the graph
    both = cut(both.repartition(shares, "src", "dst").distinct())
    labels = both.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node"))
    for _ in range(rounds):
        met = both.join(labels.withColumnRenamed("node", "dst").hint("merge"), "dst").repartition(shares, "src")
        votes = met.groupBy("src", "community").agg(F.count("*").alias("n"))
        labels = cut(votes.groupBy("src").agg(F.min(F.struct((-F.col("n")).alias("n"), "community")).alias("best")).select(F.col("src").alias("node"), F.col("best.community").alias("community")))
    return labels


EDGES_A_PART = 1 << 19
"""Edges in one partition, about."""

PIVOTS = 2000
"""Nodes from which shortest paths are counted; graphs of more nodes are sampled."""


PART_NODES = 1024
"""Nodes of a component whose shortest paths are counted in one task; larger ones go level by level over all tasks."""

STEPS_AT_ONCE = 1 << 21
"""Steps along edges in memory at once, about, while the paths of a component are counted."""


def _between(part: pa.Table) -> pa.Table:
    """(node, share) of one component (src, dst): its paths counted forward level by level from some nodes at once, their shares added up backward."""
    coded = pa.chunked_array([*part["src"].chunks, *part["dst"].chunks]).combine_chunks().dictionary_encode()
    names, (src, dst) = coded.dictionary, coded.indices.to_numpy().astype(np.int64).reshape(2, -1)
    order, n = np.argsort(src, kind="stable"), len(names)
    dst, degree = dst[order], np.bincount(src, minlength=n)
    first, total = np.cumsum(degree) - degree, np.zeros(n)
    at_once = max(1, STEPS_AT_ONCE // len(dst))
    for begin in range(0, n, at_once):
        count = min(at_once, n - begin)
        at = np.arange(count) * n + np.arange(begin, begin + count)
        paths, seen, levels = np.zeros(count * n), np.zeros(count * n, bool), []
        paths[at], seen[at] = 1.0, True
        while len(at):
            node = at % n
            steps = degree[node]
            edge = np.arange(steps.sum()) + np.repeat(first[node] - np.cumsum(steps) + steps, steps)
            back = np.repeat(at, steps)
            to = back - back % n + dst[edge]
            new = ~seen[to]
            back, to = back[new], to[new]
            levels.append((back, to))
            paths += np.bincount(to, paths[back], count * n)
            at = np.unique(to)
            seen[at] = True
        share = np.zeros(count * n)
        for back, to in reversed(levels[1:]):
            share += np.bincount(back, paths[back] / paths[to] * (1 + share[to]), count * n)
        total += share.reshape(count, n).sum(0)
    return pa.table({"node": names, "share": total})


def _by_levels(edges: DataFrame, chosen: DataFrame) -> list[DataFrame]:
    """Tables (node, share), whose sums are each node's share of the shortest paths from the nodes of ``chosen``."""
    levels = [cut(chosen.select(F.col("node").alias("pivot"), "node", F.lit(1.0).alias("paths")))]
    seen = levels[0].select("pivot", "node")
    while True:
        met = levels[-1].withColumnRenamed("node", "src").join(edges, "src").groupBy("pivot", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths"))
        new = cut(met.join(seen, ["pivot", "node"], "left_anti"))
        if not new.limit(1).count():
            break
        levels.append(new)
        seen = seen.unionByName(new.select("pivot", "node"))
    below, parts = None, []
    for level in reversed(levels[1:]):
        if below is None:
            own = level.withColumn("share", F.lit(0.0))
        else:
            met = level.withColumnRenamed("node", "src").join(edges, "src").select("pivot", "src", "paths", F.col("dst").alias("node")).join(below, ["pivot", "node"])
            given = met.groupBy("pivot", F.col("src").alias("node")).agg(F.sum(F.col("paths") / F.col("b_paths") * (1 + F.col("b_share"))).alias("share"))
            own = level.join(given, ["pivot", "node"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
        own = cut(own)
        parts.append(own.select("node", "share"))
        below = own.select("pivot", "node", F.col("paths").alias("b_paths"), F.col("share").alias("b_share"))
    return parts


def _by_parts(edges: DataFrame) -> list[DataFrame]:
    """``_by_levels`` from all nodes, where a task counts all paths of a small component."""
    labels = weak_components(edges)
    large = cut(labels.groupBy("part").count().where(F.col("count") > PART_NODES).select("part"))
    placed = edges.join(labels.withColumnRenamed("node", "src"), "src")
    small = placed.join(large, "part", "left_anti").repartition(parts_for(edges, EDGES_A_PART), "part")
    parts = [small.groupBy("part").applyInArrow(_between, f"node {edges.schema['src'].dataType.simpleString()}, share double")]
    if large.limit(1).count():
        wide = labels.join(large, "part")
        parts += _by_levels(cut(placed.join(large, "part").select("src", "dst")), wide.select("node"))
    return parts


def betweenness(edges: DataFrame, pivots: int | None = PIVOTS, confidence: float = 0.95) -> DataFrame:
    """(node, betweenness, error_bound): on how many shortest paths between two other nodes a node lies, each pair's paths weighing one in all.

    With at most ``pivots`` nodes every node is a pivot and the result is exact, as it is at any size with ``pivots`` None. No path leaves a weak component, so
    the edges go to the tasks by component: one of up to ``PART_NODES`` nodes is counted there and writes a row a node. Larger ones go level by level: path
    counts spread forward from all pivots at once, and dependencies are added up backward, so the rounds are twice the longest shortest path and the state is
    a row a pivot and node that it reaches. Above ``pivots``, the pivots are those of least hash, sums are scaled by nodes / pivots, and
    with a chance of ``confidence`` no node is off by more than ``error_bound`` (Hoeffding over the pivots, all nodes at once)."""
    edges = written(edges.where("src <> dst").select("src", "dst").distinct(), "edges")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    n = nodes.count()
    pivots = max(n, 1) if pivots is None else pivots
    total = nodes.select("node", F.lit(0.0).alias("share"))
    if n > pivots:
        parts = _by_levels(edges, nodes.orderBy(F.xxhash64("node"), "node").limit(pivots))
    else:
        parts = _by_parts(edges)
    k = min(n, pivots)
    bound = 0.0 if n <= pivots else n * (n - 2) * math.sqrt(math.log(2 * n / (1 - confidence)) / (2 * k))
    for part in parts:
        total = total.unionByName(part)
    return total.groupBy("node").agg((F.sum("share") * (n / max(1, k))).alias("betweenness")).withColumn("error_bound", F.lit(bound))


def call_flows(edges: DataFrame, starts: DataFrame, depth: int = 4, fan_out: int = 6, steps: int = 10) -> DataFrame:
    """(entry, step, node, level): a bounded breadth-first walk from each entry's owner.

    Level by level: of each node the first ``fan_out`` edges by (score desc, file, line, dst), nodes not seen before in this
    entry, in the order in which a queue would meet them; ``steps`` in all. Every level is a join over all owners at once; entries of
    one owner have the same walk, which is walked once."""
    ranked = cut(top_k(edges.dropDuplicates(["src", "dst", "score", "file", "line"]), ["src"], fan_out, F.desc("score"), *map(F.col, ("file", "line", "dst"))).select("src", "dst", F.col("rank").alias("place")))
    seen = cut(starts.select(F.col("owner").alias("entry"), F.col("owner").alias("node"), F.lit(0).alias("level"), F.array(F.lit(0)).alias("path")).distinct())
    front = seen
    for level in range(1, depth + 1):
        met = front.select("entry", F.col("node").alias("src"), "path").join(ranked, "src").select("entry", F.col("dst").alias("node"), F.lit(level).alias("level"), F.concat("path", F.array("place")).alias("path"))
        first = met.groupBy("entry", "node").agg(F.min("path").alias("path")).withColumn("level", F.lit(level))
        front = cut(first.join(seen.select("entry", "node"), ["entry", "node"], "left_anti").select("entry", "node", "level", "path"))
        seen = seen.unionByName(front)
    order = top_k(seen.where("level > 0"), ["entry"], steps, F.col("level"), F.col("path"))
    walks = order.select(F.col("entry").alias("owner"), F.col("rank").alias("step"), "node", "level")
    return starts.select("entry", "owner").join(walks, "owner").select("entry", "step", "node", "level")
