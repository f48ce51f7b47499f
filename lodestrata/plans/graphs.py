"""Queries of graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.operators import graph as G
from lodestrata.operators.joins import best_component
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import register
from lodestrata.plans.joining import module_edge_rows, MODULE_EDGE_SQL
from lodestrata.plans.rollups import SCORE, SCORED

COMP, EDGE = B.duck(B.COMPONENTS), B.duck(B.EDGES)
SCC_SQL = f"""WITH RECURSIVE e AS ({B.duck(B.DIGRAPH)}), r(a, b) AS (SELECT src, dst FROM e UNION SELECT r.a, e.dst FROM r JOIN e ON r.b = e.src),
  s AS (SELECT x.a AS node, least(x.a, min(x.b)) AS scc FROM r x JOIN r y ON x.a = y.b AND x.b = y.a WHERE x.a <> x.b GROUP BY x.a)"""


@register("scc", f"{SCC_SQL} SELECT node, scc FROM s")
def scc(spark, sf_dir):
    return G.strong_components(B.source(spark, sf_dir, B.DIGRAPH))


@register("cycle_members", f"{SCC_SQL} SELECT scc, count(*) AS members, min(node) AS first_node, max(node) AS last_node FROM s GROUP BY scc")
def cycle_members(spark, sf_dir):
    found = G.strong_components(B.source(spark, sf_dir, B.DIGRAPH))
    return found.groupBy("scc").agg(F.count("*").alias("members"), F.min("node").alias("first_node"), F.max("node").alias("last_node"))


@register("module_adjacency", f"WITH {MODULE_EDGE_SQL} SELECT src, string_agg(DISTINCT dst, ',' ORDER BY dst) AS depends_on FROM me GROUP BY src")
def module_adjacency(spark, sf_dir):
    return module_edge_rows(spark, sf_dir).groupBy("src").agg(F.array_join(F.array_sort(F.collect_set("dst")), ",").alias("depends_on"))


@register("degree_topk", f"SELECT node, count(*) AS degree FROM (SELECT src AS node FROM ({EDGE}) a UNION ALL SELECT dst FROM ({EDGE}) b) t GROUP BY node ORDER BY degree DESC, node LIMIT 10")
def degree_topk(spark, sf_dir):
    e = B.source(spark, sf_dir, B.EDGES).select(F.explode(F.array("src", "dst")).alias("node"))
    return e.groupBy("node").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "node").limit(10)


@register("isolated_nodes", f"WITH n AS (SELECT DISTINCT name FROM ({COMP}) c), d AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM ({EDGE}) a UNION ALL SELECT dst FROM ({EDGE}) b) t GROUP BY node) SELECT name, coalesce(degree, 0) AS degree FROM n LEFT JOIN d ON d.node = n.name WHERE coalesce(degree, 0) <= 1")
def isolated_nodes(spark, sf_dir):
    degree = B.source(spark, sf_dir, B.EDGES).select(F.explode(F.array("src", "dst")).alias("name")).groupBy("name").agg(F.count("*").alias("degree"))
    names = B.source(spark, sf_dir, B.COMPONENTS).select("name").distinct()
    return names.join(degree, "name", "left").select("name", F.coalesce("degree", F.lit(0)).alias("degree")).where("degree <= 1")


#: Pairs of nodes with their distance and number of shortest paths, from walks counted by length; a node lies between two others where the distances add up.
BRIDGE_SQL = f"""WITH RECURSIVE e AS ({B.duck(B.DIGRAPH)}), w(s, v, steps, walks) AS (SELECT src, dst, 1, 1::DOUBLE FROM e UNION ALL (SELECT w.s, e.dst, any_value(w.steps) + 1, sum(w.walks) FROM w JOIN e ON e.src = w.v WHERE w.steps < 7 GROUP BY w.s, e.dst)),
  d AS (SELECT s, v, min(steps) AS far, arg_min(walks, steps) AS paths FROM w WHERE s <> v GROUP BY s, v),
  b AS (SELECT x.v AS node, sum(x.paths * y.paths / z.paths) AS score FROM d x JOIN d y ON y.s = x.v JOIN d z ON z.s = x.s AND z.v = y.v AND z.far = x.far + y.far GROUP BY x.v)
  SELECT node, round(coalesce(score, 0), 3) AS betweenness FROM (SELECT DISTINCT unnest([src, dst]) AS node FROM e) n LEFT JOIN b USING (node)"""


@register("bridge_nodes", BRIDGE_SQL)
def bridge_nodes(spark, sf_dir):
    """From every node, whatever their number: the statement samples none."""
    return G.betweenness(B.source(spark, sf_dir, B.DIGRAPH), pivots=None).select("node", F.round("betweenness", 3).alias("betweenness"))


@register("communities")
def communities(spark, sf_dir):
    edges = B.source(spark, sf_dir, B.DIGRAPH)
    labels = G.label_communities(edges)
    pairs = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    inner = pairs.join(labels.select(F.col("node").alias("a"), F.col("community").alias("ca")), "a").join(labels.select(F.col("node").alias("b"), F.col("community").alias("cb")), "b").where("ca = cb").groupBy(F.col("ca").alias("community")).agg(F.count("*").alias("inner_edges"))
    sized = labels.groupBy("community").agg(F.count("*").alias("members")).join(inner, "community", "left")
    possible = F.col("members") * (F.col("members") - 1) / 2
    return sized.select("community", "members", F.round(F.when(possible > 0, F.coalesce("inner_edges", F.lit(0)) / possible).otherwise(0.0), 4).alias("cohesion"), (F.col("members") < 3).alias("thin"))


STARTS = "SELECT seq AS entry, name AS owner FROM ({}) c"
LEVELS = "".join(
    f""", m{n} AS (SELECT f.entry, k.dst AS node, {n} AS level, min(list_append(f.path, k.place)) AS path FROM f{n - 1} f JOIN k ON k.src = f.node GROUP BY f.entry, k.dst),
    f{n} AS (SELECT * FROM m{n} m WHERE NOT EXISTS (SELECT 1 FROM ({' UNION ALL '.join(f'SELECT entry, node FROM f{j}' for j in range(n))}) s WHERE s.entry = m.entry AND s.node = m.node))"""
    for n in range(1, 5)
)


@register("call_flows", f"""WITH e AS (SELECT DISTINCT src, dst, file, line, {SCORE} AS score FROM ({B.duck(SCORED)}) t), k AS (SELECT src, dst, place FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, file, line, dst) AS place FROM e) t WHERE place <= 6),
  f0 AS (SELECT entry, owner AS node, 0 AS level, [0::BIGINT] AS path FROM ({STARTS.format(COMP)}) s){LEVELS}, a AS ({' UNION ALL '.join(f'SELECT * FROM f{n}' for n in range(1, 5))})
  SELECT entry, step, node, level FROM (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY level, path) AS step FROM a) t WHERE step <= 10""")
def call_flows(spark, sf_dir):
    edges = B.source(spark, sf_dir, SCORED).withColumn("score", F.expr(SCORE))
    return G.call_flows(edges, B.source(spark, sf_dir, STARTS.format(B.COMPONENTS)))


@register("symbol_registry", f"SELECT 'component' AS fact, count(*) AS n FROM ({COMP}) c UNION ALL SELECT 'dependency', count(*) FROM ({EDGE}) e UNION ALL SELECT 'best_component', count(DISTINCT name) FROM ({COMP}) c UNION ALL SELECT 'route', count(*) FROM ({B.duck(B.CS)}) t")
def symbol_registry(spark, sf_dir):
    c, e, cs = (B.source(spark, sf_dir, s) for s in (B.COMPONENTS, B.EDGES, B.CS))
    one = lambda name, rows: rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("fact"), "n")
    return one("component", c).unionByName(one("dependency", e)).unionByName(one("best_component", best_component(c))).unionByName(one("route", cs.where(F.col("text").contains("[Http"))))
