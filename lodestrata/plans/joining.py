"""Queries of joins, lookups and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions import fixed
from lodestrata.functions.rules import is_any, quote
from lodestrata.operators import joins as J
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import register

COMP, EDGE, FILE = B.duck(B.COMPONENTS), B.duck(B.EDGES), B.duck(B.FILES)
PRIMITIVE = is_any("dst", fixed.PRIMITIVE_TYPES)
ALIASES_SQL = f"""c AS ({COMP}), e AS ({EDGE}), al0 AS (SELECT seq, name, name AS alias FROM c UNION ALL SELECT seq, name, substring(name, 2) FROM c WHERE regexp_matches(name, '^I[A-Z]') UNION ALL SELECT seq, name, contract FROM c),
  al AS (SELECT alias, name FROM (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY seq DESC, name DESC) AS k FROM al0) t WHERE k = 1),
  di AS (SELECT service, implementation FROM (SELECT e.src AS service, al.name AS implementation, row_number() OVER (PARTITION BY e.src ORDER BY e.seq DESC, al.name DESC) AS k FROM e JOIN al ON e.dst = al.alias WHERE kind = 'di_registration') t WHERE k = 1),
  rs AS (SELECT e.*, CASE WHEN NOT ({PRIMITIVE}) THEN coalesce(d1.implementation, a1.name, d2.implementation, a2.name) END AS resolved FROM e LEFT JOIN di d1 ON d1.service = e.dst LEFT JOIN al a1 ON a1.alias = e.dst
    LEFT JOIN di d2 ON d2.service = substring(e.dst, 2) AND regexp_matches(e.dst, '^I[A-Z]') LEFT JOIN al a2 ON a2.alias = substring(e.dst, 2) AND regexp_matches(e.dst, '^I[A-Z]'))"""


def _known(spark, sf_dir):
    components, edges = B.source(spark, sf_dir, B.COMPONENTS), B.source(spark, sf_dir, B.EDGES)
    known = J.aliases(components)
    return components, edges, known, J.registrations(edges, known)


PREFIXES = "SELECT DISTINCT concat('src/', p_type) AS prefix, concat('P:', p_type) AS project FROM <<part>> UNION SELECT DISTINCT concat('src/', p_type, '/', p_brand) AS prefix, concat('P:', p_type, p_brand) AS project FROM <<part>> WHERE p_size % 2 = 0"
PLACED = "SELECT p_partkey AS seq, concat(CASE WHEN p_size % 10 = 0 THEN 'docs/' ELSE 'src/' END, p_type, CASE WHEN p_size % 3 = 0 THEN concat('/', p_brand) ELSE '' END, '/W', cast(p_partkey as varchar(20)), '.cs') AS path FROM <<part>>"


@register("longest_prefix_join", f"""WITH f AS ({B.duck(PLACED)}), p AS ({B.duck(PREFIXES)}), m AS (SELECT f.seq, p.project, row_number() OVER (PARTITION BY f.seq ORDER BY length(p.prefix) DESC, p.project) AS k FROM f JOIN p ON f.path LIKE concat(p.prefix, '/%'))
  SELECT f.seq, f.path, m.project FROM f LEFT JOIN m ON m.seq = f.seq AND m.k = 1""")
def longest_prefix_join(spark, sf_dir):
    return J.longest_prefix(B.source(spark, sf_dir, PLACED), B.source(spark, sf_dir, PREFIXES)).select("seq", "path", "project")


@register("best_component", f"SELECT seq, name, confidence, is_test FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_test, confidence DESC, seq) AS k FROM ({COMP}) c) t WHERE k = 1")
def best_component(spark, sf_dir):
    return J.best_component(B.source(spark, sf_dir, B.COMPONENTS)).select("seq", "name", "confidence", "is_test")


@register("type_alias_index", f"WITH {ALIASES_SQL} SELECT alias, name FROM al")
def type_alias_index(spark, sf_dir):
    return _known(spark, sf_dir)[2]


@register("di_resolution", f"WITH {ALIASES_SQL} SELECT service, implementation FROM di")
def di_resolution(spark, sf_dir):
    return _known(spark, sf_dir)[3]


@register("resolve_target", f"WITH {ALIASES_SQL} SELECT seq, src, dst, line, resolved FROM rs")
def resolve_target(spark, sf_dir):
    _, edges, known, registered = _known(spark, sf_dir)
    return J.resolve(edges, known, registered, F.expr(PRIMITIVE)).select("seq", "src", "dst", "line", "resolved")


PROVIDED = "SELECT seq AS p_seq, name AS provider, confidence AS p_confidence, contract AS dst FROM ({}) c"
SERVICE = "concat('I', CASE seq % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO' WHEN 4 THEN 'SMALL' ELSE 'STANDARD' END, 'Service')"
for _key, _kind, _ceiling in (("di_candidates", "constructor_injection", 0.82), ("handler_candidates", "mediatr_send", 0.84)):

    @register(_key, f"""WITH e AS (SELECT seq, src, line, confidence, {SERVICE} AS dst FROM ({EDGE}) t WHERE kind = {quote(_kind)}), p AS ({PROVIDED.format(COMP)}),
      m AS (SELECT e.seq, e.src, e.line, p.provider, p.p_seq, least(cast({_ceiling} AS DOUBLE), e.confidence, p.p_confidence) AS confidence, row_number() OVER (PARTITION BY e.seq, e.src, e.line ORDER BY p.p_seq, p.provider) AS rank FROM e JOIN p ON e.dst = p.dst)
      SELECT seq, src, line, provider, rank, confidence FROM m WHERE rank <= 3""")
    def _candidates(spark, sf_dir, kind=_kind, ceiling=_ceiling):
        injected = B.source(spark, sf_dir, B.EDGES).where(F.col("kind") == kind).select("seq", "src", "line", "confidence", F.expr(SERVICE).alias("dst"))
        providers = B.source(spark, sf_dir, PROVIDED.format(B.COMPONENTS))
        return J.top_candidates(injected, providers, "dst", 3, ceiling).select("seq", "src", "line", "provider", "rank", "confidence")


MODULE_EDGE_SQL = f"""c AS (SELECT name, module FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_test, confidence DESC, seq) AS k FROM ({COMP}) t) t WHERE k = 1), e AS ({EDGE}),
  j AS (SELECT e.*, a.module AS m_src, b.module AS m_dst FROM e JOIN c a ON a.name = e.src JOIN c b ON b.name = e.dst WHERE a.module <> 'Unknown' AND b.module <> 'Unknown' AND a.module <> b.module),
  me AS (SELECT m_src AS src, m_dst AS dst, kind, seq, file, least(cast(0.72 AS DOUBLE), confidence) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY m_src, m_dst, kind ORDER BY seq, src, dst, line, points) AS k FROM j) t WHERE k = 1)"""


def module_edge_rows(spark, sf_dir):
    names = J.best_component(B.source(spark, sf_dir, B.COMPONENTS)).select("name", "module")
    edges = B.source(spark, sf_dir, B.EDGES)
    met = edges.join(names.select(F.col("name").alias("src"), F.col("module").alias("m_src")), "src").join(names.select(F.col("name").alias("dst"), F.col("module").alias("m_dst")), "dst")
    met = met.where("m_src <> 'Unknown' AND m_dst <> 'Unknown' AND m_src <> m_dst")
    first = J.pick(met, ["m_src", "m_dst", "kind"], *map(F.col, ("seq", "src", "dst", "line", "points")))
    return first.select(F.col("m_src").alias("src"), F.col("m_dst").alias("dst"), "kind", "seq", "file", F.least(F.lit(0.72), "confidence").alias("confidence"))


@register("module_edges", f"WITH {MODULE_EDGE_SQL} SELECT * FROM me")
def module_edges(spark, sf_dir):
    return module_edge_rows(spark, sf_dir)


COUPLED = """a AS (SELECT src AS name, count(DISTINCT dst) AS efferent, 0 AS afferent FROM {e} GROUP BY src UNION ALL SELECT dst, 0, count(DISTINCT src) FROM {e} GROUP BY dst),
  cp AS (SELECT name, cast(sum(afferent) AS BIGINT) AS afferent, cast(sum(efferent) AS BIGINT) AS efferent, cast(sum(afferent) + sum(efferent) AS BIGINT) AS total FROM a GROUP BY name)"""


def coupling_of(edges):
    """(name, afferent, efferent, total): distinct neighbours in each direction."""
    out = edges.groupBy(F.col("src").alias("name")).agg(F.lit(0).cast("long").alias("afferent"), F.count_distinct("dst").alias("efferent"))
    into = edges.groupBy(F.col("dst").alias("name")).agg(F.count_distinct("src").alias("afferent"), F.lit(0).cast("long").alias("efferent"))
    return out.unionByName(into).groupBy("name").agg(F.sum("afferent").alias("afferent"), F.sum("efferent").alias("efferent")).withColumn("total", F.col("afferent") + F.col("efferent"))


@register("module_dependencies", f"WITH {MODULE_EDGE_SQL}, {COUPLED.format(e='me')} SELECT name AS module, afferent, efferent, total, CASE WHEN total >= 6 THEN 'Weak' WHEN total <= 1 THEN 'Strong' ELSE 'Medium' END AS boundary FROM cp")
def module_dependencies(spark, sf_dir):
    boundary = F.when(F.col("total") >= 6, "Weak").when(F.col("total") <= 1, "Strong").otherwise("Medium")
    return coupling_of(module_edge_rows(spark, sf_dir)).select(F.col("name").alias("module"), "afferent", "efferent", "total", boundary.alias("boundary"))


@register("component_edges", f"""WITH {ALIASES_SQL}, b AS (SELECT name, is_test FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_test, confidence DESC, seq) AS k FROM c) t WHERE k = 1)
  SELECT DISTINCT src, resolved AS dst, relationship, kind, file, line FROM rs WHERE resolved IS NOT NULL AND resolved <> src AND src IN (SELECT name FROM b WHERE NOT is_test) AND resolved NOT IN (SELECT name FROM b WHERE is_test)""")
def component_edges(spark, sf_dir):
    components, edges, known, registered = _known(spark, sf_dir)
    best = J.best_component(components)
    rows = J.resolve(edges, known, registered, F.expr(PRIMITIVE)).where("resolved IS NOT NULL AND resolved <> src")
    rows = rows.join(best.where("NOT is_test").select(F.col("name").alias("src")), "src", "left_semi").join(best.where("is_test").select(F.col("name").alias("resolved")), "resolved", "left_anti")
    return rows.select("src", F.col("resolved").alias("dst"), "relationship", "kind", "file", "line").distinct()


CHUNKS = """SELECT concat('src/', f, '/F', cast(n as varchar(20)), '.cs') AS file, cast(k * 10 + 1 as bigint) AS start_line, cast(k * 10 + 16 as bigint) AS end_line FROM (SELECT DISTINCT l_returnflag AS f, l_suppkey % 40 AS n FROM <<lineitem>>) a, (SELECT DISTINCT l_linenumber - 1 AS k FROM <<lineitem>>) b"""
FACTS = "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS fact_id, concat('src/', l_returnflag, '/F', cast(l_suppkey % 40 as varchar(20)), '.cs') AS file, CASE WHEN l_linenumber = 2 THEN NULL ELSE cast(l_linenumber * 9 as bigint) END AS line FROM <<lineitem>>"


@register("interval_chunk_join", f"""WITH f AS (SELECT fact_id, min(file) AS file, min(line) AS line FROM ({B.duck(FACTS)}) t GROUP BY fact_id), c AS ({B.duck(CHUNKS)}), m AS (SELECT fact_id, f.file, line, start_line, row_number() OVER (PARTITION BY fact_id ORDER BY start_line) AS rank FROM f JOIN c ON f.file = c.file AND (line IS NULL OR line BETWEEN start_line AND end_line))
  SELECT fact_id, file, line, start_line, rank FROM m WHERE rank <= 3""")
def interval_chunk_join(spark, sf_dir):
    facts = B.source(spark, sf_dir, FACTS).groupBy("fact_id").agg(F.min("file").alias("file"), F.min("line").alias("line"))
    return J.line_chunks(facts, B.source(spark, sf_dir, CHUNKS)).select("fact_id", "file", "line", "start_line", "rank")


SEMANTIC = "SELECT name, file, max(cast(50 + seq % 50 as double) / 100) AS semantic FROM ({}) c WHERE seq % 3 = 0 GROUP BY name, file"


@register("semantic_enrich", f"WITH c AS ({COMP}), s AS ({SEMANTIC.format(COMP)}) SELECT c.seq, c.name, greatest(confidence, coalesce(least(cast(0.97 AS DOUBLE), semantic), confidence)) AS confidence, CASE WHEN semantic IS NULL THEN 'structural' ELSE 'structural+semantic' END AS backend FROM c LEFT JOIN s ON c.name = s.name AND c.file = s.file")
def semantic_enrich(spark, sf_dir):
    c = B.source(spark, sf_dir, B.COMPONENTS)
    met = c.join(B.source(spark, sf_dir, SEMANTIC.format(B.COMPONENTS)), ["name", "file"], "left")
    raised = F.greatest("confidence", F.coalesce(F.least(F.lit(0.97), "semantic"), "confidence"))
    return met.select("seq", "name", raised.alias("confidence"), F.when(F.col("semantic").isNull(), "structural").otherwise("structural+semantic").alias("backend"))


@register("semantic_union", f"SELECT src, dst, kind, confidence, 'structural' AS origin FROM ({EDGE}) e UNION ALL SELECT name, contract, 'implements', cast(0.94 AS DOUBLE), 'semantic' FROM ({COMP}) c")
def semantic_union(spark, sf_dir):
    edges = B.source(spark, sf_dir, B.EDGES).select("src", "dst", "kind", "confidence", F.lit("structural").alias("origin"))
    more = B.source(spark, sf_dir, B.COMPONENTS).select(F.col("name").alias("src"), F.col("contract").alias("dst"), F.lit("implements").alias("kind"))
    return edges.unionByName(more, allowMissingColumns=True).withColumns({"confidence": F.coalesce("confidence", F.lit(0.94)), "origin": F.coalesce("origin", F.lit("semantic"))})


REFS = "SELECT p_partkey AS seq, concat('src/', p_type, '/sub/../../', CASE WHEN p_size % 4 = 0 THEN '' ELSE concat(p_type, '/') END, p_brand, '.csproj') AS reference FROM <<part>>"


@register("project_refs", f"""WITH r AS ({B.duck(REFS)}), k AS (SELECT DISTINCT concat('src/', p_type, '/', p_brand, '.csproj') AS path FROM part WHERE p_size % 2 = 0), n AS (SELECT seq, regexp_replace(reference, '^src/[^/]+/sub/\\.\\./\\.\\./', 'src/') AS target FROM r)
  SELECT seq, target, path IS NOT NULL AS resolved, cast(CASE WHEN path IS NOT NULL THEN 0.93 ELSE 0.65 END AS DOUBLE) AS confidence FROM n LEFT JOIN k ON n.target = k.path""")
def project_refs(spark, sf_dir):
    known = B.source(spark, sf_dir, "SELECT DISTINCT concat('src/', p_type, '/', p_brand, '.csproj') AS target, true AS found FROM <<part>> WHERE p_size % 2 = 0")
    rows = B.source(spark, sf_dir, REFS).select("seq", J.normal_path(F.col("reference")).alias("target")).join(known, "target", "left")
    return rows.select("seq", "target", F.coalesce("found", F.lit(False)).alias("resolved"), F.when(F.col("found"), 0.93).otherwise(0.65).alias("confidence"))


OWNERS = "SELECT p_partkey AS seq, CASE WHEN p_size % 3 = 0 THEN concat('src/P', cast(p_size as varchar(20)), '.cshtml') ELSE concat('src/W', cast(p_partkey as varchar(20)), '.cs') END AS file, concat('W', cast(p_partkey % 700 as varchar(20)), CASE WHEN p_partkey % 9 = 0 THEN '' ELSE 'Dto' END) AS owner FROM <<part>>"
BEHIND = "SELECT concat('src/P', cast(p_size as varchar(20)), '.cshtml') AS file, min(concat('Behind', cast(p_partkey as varchar(20)))) AS behind FROM <<part>> WHERE p_size % 6 = 0 GROUP BY p_size"


@register("entry_owner", f"""WITH o AS ({B.duck(OWNERS)}), b AS ({B.duck(BEHIND)}), n AS (SELECT DISTINCT name FROM ({COMP}) c) SELECT o.seq, coalesce(CASE WHEN o.file LIKE '%.cshtml' THEN b.behind END, m.name, w.name, o.owner) AS owner
  FROM o LEFT JOIN b ON o.file = b.file LEFT JOIN n m ON m.name = concat(o.owner, 'Model') LEFT JOIN n w ON w.name = o.owner""")
def entry_owner(spark, sf_dir):
    names = B.source(spark, sf_dir, B.COMPONENTS).select("name").distinct()
    rows = B.source(spark, sf_dir, OWNERS).join(B.source(spark, sf_dir, BEHIND), "file", "left").withColumn("as_model", F.concat("owner", F.lit("Model")))
    rows = rows.join(names.select(F.col("name").alias("as_model"), F.col("name").alias("m")), "as_model", "left").join(names.select(F.col("name").alias("owner"), F.col("name").alias("w")), "owner", "left")
    return rows.select("seq", F.coalesce(F.when(F.col("file").like("%.cshtml"), F.col("behind")), "m", "w", "owner").alias("owner"))


RISKS = "SELECT c_custkey AS risk_id, concat('Brand#', cast(c_nationkey as varchar(20)), ', Brand#', cast(c_custkey % 25 as varchar(20))) AS modules, c_mktsegment AS category FROM <<customer>>"


@register("risk_match", f"WITH r AS (SELECT DISTINCT risk_id, category, trim(m) AS module FROM (SELECT risk_id, category, unnest(string_split(modules, ', ')) AS m FROM ({B.duck(RISKS)}) t) u), m AS (SELECT DISTINCT p_brand AS module FROM part) SELECT m.module, risk_id, category FROM m JOIN r USING (module)")
def risk_match(spark, sf_dir):
    modules = B.source(spark, sf_dir, "SELECT DISTINCT p_brand AS module FROM <<part>>")
    return J.member_of(modules, B.source(spark, sf_dir, RISKS), "module", "modules").select("module", "risk_id", "category")


CALLS = "SELECT o_orderkey AS seq, concat('W', cast(o_custkey % 700 as varchar(20)), 'Controller') AS owner, concat('/api/', o_orderstatus) AS path FROM <<orders>>"


@register("api_contracts", f"""WITH i AS ({B.duck(CALLS)}), c AS (SELECT name, module, seq AS component_seq FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_test, confidence DESC, seq) AS k FROM ({COMP}) t) t WHERE k = 1), m AS (SELECT DISTINCT p_brand AS module, min(p_size) AS cap FROM part GROUP BY p_brand)
  SELECT concat('API-CONTRACT-', lpad(cast(row_number() OVER (ORDER BY i.seq) AS VARCHAR), 6, '0')) AS contract_id, i.seq, i.path, coalesce(c.module, 'Unknown') AS owner_module, coalesce(m.cap, 0) AS capability, coalesce(c.component_seq, -1) AS entry_component FROM i LEFT JOIN c ON c.name = i.owner LEFT JOIN m ON m.module = c.module""")
def api_contracts(spark, sf_dir):
    from lodestrata.operators.windows import sequential_ids

    best = J.best_component(B.source(spark, sf_dir, B.COMPONENTS)).select(F.col("name").alias("owner"), "module", F.col("seq").alias("component_seq"))
    modules = B.source(spark, sf_dir, "SELECT p_brand AS module, min(p_size) AS cap FROM <<part>> GROUP BY p_brand")
    met = B.source(spark, sf_dir, CALLS).join(best, "owner", "left").join(modules, "module", "left")
    return sequential_ids(met, "contract_id", "API-CONTRACT-%06d", "seq").select("contract_id", "seq", "path", F.coalesce("module", F.lit("Unknown")).alias("owner_module"), F.coalesce("cap", F.lit(0)).alias("capability"), F.coalesce("component_seq", F.lit(-1)).cast("long").alias("entry_component"))


@register("graph_nodes_complete", f"""WITH n AS (SELECT DISTINCT ON (name) name AS id, component_type AS type, file FROM ({COMP}) c ORDER BY name, seq), e AS ({EDGE}), x AS (SELECT seq, file, src AS id FROM e UNION ALL SELECT seq, file, dst FROM e), f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq, file) AS k FROM x WHERE id NOT IN (SELECT id FROM n))
  SELECT id, type, file FROM n UNION ALL SELECT id, 'external_system', file FROM f WHERE k = 1""")
def graph_nodes_complete(spark, sf_dir):
    nodes = J.pick(B.source(spark, sf_dir, B.COMPONENTS), ["name"], F.col("seq")).select(F.col("name").alias("id"), F.col("component_type").alias("type"), "file")
    return J.endpoints_completed(nodes, B.source(spark, sf_dir, B.EDGES))


@register("invalid_edges", f"WITH n AS (SELECT DISTINCT name FROM ({COMP}) c), e AS ({EDGE}) SELECT 'source' AS side, src AS name, count(*) AS n FROM e WHERE src NOT IN (SELECT name FROM n) GROUP BY src UNION ALL SELECT 'target', dst, count(*) FROM e WHERE dst NOT IN (SELECT name FROM n) GROUP BY dst")
def invalid_edges(spark, sf_dir):
    names, edges = B.source(spark, sf_dir, B.COMPONENTS).select("name").distinct(), B.source(spark, sf_dir, B.EDGES)
    lost = lambda side, column: edges.select(F.col(column).alias("name")).join(names, "name", "left_anti").groupBy("name").agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "name", "n")
    return lost("source", "src").unionByName(lost("target", "dst"))


SNAP = "SELECT o_orderkey AS k, concat('f', cast(o_orderkey as varchar(20))) AS path, md5(concat(o_orderstatus, CASE WHEN {} THEN 'x' ELSE '' END)) AS hash FROM <<orders>> WHERE {}"
BEFORE, AFTER = SNAP.format("o_orderkey < 0", "o_orderkey % 10 <> 0"), SNAP.format("o_orderkey % 7 = 0", "o_orderkey % 11 <> 0")


@register("snapshot_diff", f"WITH b AS (SELECT DISTINCT path, hash FROM ({B.duck(BEFORE)}) t), a AS (SELECT DISTINCT path, hash FROM ({B.duck(AFTER)}) t) SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'added' WHEN a.path IS NULL THEN 'removed' ELSE 'modified' END AS change FROM a FULL JOIN b ON a.path = b.path WHERE a.hash IS DISTINCT FROM b.hash")
def snapshot_diff(spark, sf_dir):
    return J.snapshot_diff(*(B.source(spark, sf_dir, x).select("path", "hash").distinct() for x in (BEFORE, AFTER)))


FRONT_TYPES = "('FrontendComponent', 'FrontendService', 'RouteGuard', 'StateStore')"


@register("frontend_apps", f"WITH p AS (SELECT DISTINCT p_type AS project, concat('src/', p_type) AS root FROM part), c AS ({COMP}) SELECT p.project, count(*) AS components FROM p JOIN c ON c.project = p.project OR c.file LIKE concat(p.root, '/%') OR c.component_type IN {FRONT_TYPES} GROUP BY p.project")
def frontend_apps(spark, sf_dir):
    """An OR of three keys, as a union of three equi-joins made distinct: no nested loop over components."""
    c = B.source(spark, sf_dir, B.COMPONENTS).select("seq", "project", "file", "component_type")
    projects = B.source(spark, sf_dir, "SELECT DISTINCT p_type AS project, concat('src/', p_type) AS root FROM <<part>>")
    by_project = c.select("seq", "project").join(projects.select("project"), "project")
    by_path = J.longest_prefix(c.select("seq", F.col("file").alias("path")), projects, prefix="root").where("project IS NOT NULL").select("seq", "project")
    by_type = c.where(f"component_type IN {FRONT_TYPES}").agg(F.count("*").alias("n"))
    own = by_project.unionByName(by_path).distinct().join(c.where(f"component_type NOT IN {FRONT_TYPES}").select("seq"), "seq", "left_semi").groupBy("project").agg(F.count("*").alias("own"))
    every = projects.select("project").join(own, "project", "left").withColumn("one", F.lit(1)).join(by_type.withColumn("one", F.lit(1)), "one")
    return every.select("project", (F.coalesce("own", F.lit(0)) + F.col("n")).alias("components")).where("components > 0")


@register("package_intersection", "SELECT p_partkey AS seq FROM part WHERE list_has_any([p_type, p_brand], ['PROMO', 'Brand#7'])")
def package_intersection(spark, sf_dir):
    rows = B.source(spark, sf_dir, "SELECT p_partkey AS seq, array(p_type, p_brand) AS packages FROM <<part>>")
    return rows.where(F.arrays_overlap("packages", F.array(F.lit("PROMO"), F.lit("Brand#7")))).select("seq")


# --- set operations ---
@register("union_all", "SELECT name AS id, 'component' AS kind FROM ({0}) c UNION ALL SELECT src, 'edge' FROM ({1}) e".format(COMP, EDGE))
def union_all(spark, sf_dir):
    a = B.source(spark, sf_dir, B.COMPONENTS).select(F.col("name").alias("id"), F.lit("component").alias("kind"))
    return a.unionByName(B.source(spark, sf_dir, B.EDGES).select(F.col("src").alias("id"), F.lit("edge").alias("kind")))


@register("set_union", f"SELECT name FROM ({COMP}) c UNION SELECT dst FROM ({EDGE}) e")
def set_union(spark, sf_dir):
    return B.source(spark, sf_dir, B.COMPONENTS).select("name").union(B.source(spark, sf_dir, B.EDGES).select("dst")).distinct()


LAYERED = ["Presentation/UI", "API", "Application", "Domain", "Infrastructure", "DataAccess"]


@register("layer_intersection", f"WITH l AS (SELECT module, array_agg(DISTINCT layer) AS have FROM ({COMP}) c GROUP BY module) SELECT module, len(list_intersect(have, {LAYERED!r})) AS common, len(list_intersect(have, {LAYERED!r})) >= 3 AS layered FROM l")
def layer_intersection(spark, sf_dir):
    have = B.source(spark, sf_dir, B.COMPONENTS).groupBy("module").agg(F.collect_set("layer").alias("have"))
    common = F.size(F.array_intersect("have", F.array(*map(F.lit, LAYERED)))).cast("long")
    return have.select("module", common.alias("common"), (common >= 3).alias("layered"))


@register("set_difference", f"SELECT name FROM ({COMP}) c EXCEPT SELECT src FROM ({EDGE}) e")
def set_difference(spark, sf_dir):
    return B.source(spark, sf_dir, B.COMPONENTS).select("name").subtract(B.source(spark, sf_dir, B.EDGES).select("src"))


@register("subset_test", f"WITH l AS (SELECT module, array_agg(DISTINCT layer) AS have FROM ({COMP}) c GROUP BY module) SELECT module, list_has_all(have, ['Application', 'Domain', 'Infrastructure']) AS clean FROM l")
def subset_test(spark, sf_dir):
    have = B.source(spark, sf_dir, B.COMPONENTS).groupBy("module").agg(F.collect_set("layer").alias("have"))
    return have.select("module", (F.size(F.array_except(F.array(*map(F.lit, ("Application", "Domain", "Infrastructure"))), "have")) == 0).alias("clean"))


EXPECTED = "SELECT concat('out', cast(n_nationkey as varchar(20)), '.md') AS name FROM <<nation>>"
PRESENT = "SELECT DISTINCT concat('out', cast(s_nationkey as varchar(20)), '.md') AS name FROM <<supplier>> WHERE s_suppkey % 3 = 0"


@register("missing_outputs", f"SELECT name FROM ({B.duck(EXPECTED)}) e WHERE name NOT IN (SELECT name FROM ({B.duck(PRESENT)}) p)")
def missing_outputs(spark, sf_dir):
    return B.source(spark, sf_dir, EXPECTED).join(B.source(spark, sf_dir, PRESENT), "name", "left_anti")


@register("input_completeness", f"WITH e AS ({B.duck(EXPECTED)}), p AS ({B.duck(PRESENT)}) SELECT count(*) AS expected, count(p.name) AS present, count(p.name) >= 10 AS sufficient FROM e LEFT JOIN p ON p.name = e.name")
def input_completeness(spark, sf_dir):
    met = B.source(spark, sf_dir, EXPECTED).join(B.source(spark, sf_dir, PRESENT).withColumn("there", F.lit(1)), "name", "left")
    return met.agg(F.count("*").alias("expected"), F.count("there").alias("present")).withColumn("sufficient", F.col("present") >= 10)
