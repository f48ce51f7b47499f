"""Queries of aggregations, deduplication, windows and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestrata.functions import fixed
from lodestrata.functions.rules import case_sql, column, lookup_sql, quote
from lodestrata.operators import aggregates as A
from lodestrata.operators import classify as C
from lodestrata.operators import windows as W
from lodestrata.operators.joins import best_component, pick
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import register
from lodestrata.plans.classification import ENTRIES, FLOWS, MODULES
from lodestrata.plans.joining import coupling_of, module_edge_rows, MODULE_EDGE_SQL, COUPLED

COMP, EDGE, FILE = B.duck(B.COMPONENTS), B.duck(B.EDGES), B.duck(B.FILES)
PARTS = [("kind", EDGE, B.EDGES), ("relationship", EDGE, B.EDGES), ("component_type", COMP, B.COMPONENTS), ("layer", COMP, B.COMPONENTS)]


@register("histograms", " UNION ALL ".join(f"SELECT {quote(k)} AS histogram, {k} AS key, count(*) AS n FROM ({d}) t GROUP BY {k}" for k, d, _ in PARTS))
def histograms(spark, sf_dir):
    found = None
    for key, _, statement in PARTS:
        one = A.histogram(B.source(spark, sf_dir, statement), key, key)
        found = one if found is None else found.unionByName(one)
    return found


@register("language_summary", f"SELECT {C.INVENTORY_LANGUAGE} AS language, count(*) AS file_count, cast(sum(size_bytes) AS BIGINT) AS total_bytes, cast(sum(coalesce(line_count, 0)) AS BIGINT) AS total_lines FROM ({FILE}) t GROUP BY 1")
def language_summary(spark, sf_dir):
    files = B.source(spark, sf_dir, B.FILES).withColumn("language", F.expr(C.INVENTORY_LANGUAGE))
    return files.groupBy("language").agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes"), F.sum(F.coalesce("line_count", F.lit(0))).alias("total_lines")).orderBy(F.desc("file_count"), "language")


@register("extraction_summary", f"SELECT count(*) AS artifacts, count(*) FILTER (WHERE component_type = 'Service') AS services, count(*) FILTER (WHERE is_test) AS tests, count(*) FILTER (WHERE confidence >= 0.7) AS confident, count(DISTINCT file) AS files, count(DISTINCT module) AS modules FROM ({COMP}) t")
def extraction_summary(spark, sf_dir):
    c = B.source(spark, sf_dir, B.COMPONENTS)
    return c.agg(F.count("*").alias("artifacts"), F.count_if(F.col("component_type") == "Service").alias("services"), F.count_if("is_test").alias("tests"), F.count_if(F.col("confidence") >= 0.7).alias("confident"), F.count_distinct("file").alias("files"), F.count_distinct("module").alias("modules"))


@register("avg_confidence", f"SELECT module, coalesce(round(cast(sum(points) AS DOUBLE) / (count(points) * 100), 3), 0.5) AS confidence FROM ({COMP}) t GROUP BY module")
def avg_confidence(spark, sf_dir):
    return B.source(spark, sf_dir, B.COMPONENTS).groupBy("module").agg(A.mean_points(F.col("points"), 0.5).alias("confidence"))


@register("coupling", f"WITH e AS ({EDGE}), {COUPLED.format(e='e')} SELECT * FROM cp WHERE total >= 8")
def coupling(spark, sf_dir):
    return A.coupling(B.source(spark, sf_dir, B.EDGES)).where("total >= 8")


@register("module_buckets", f"SELECT module, count(*) AS components, count(DISTINCT file) AS files, string_agg(DISTINCT component_type, ',' ORDER BY component_type) AS types, string_agg(DISTINCT layer, ',' ORDER BY layer) AS layers, round(cast(sum(points) AS DOUBLE) / (count(points) * 100), 3) AS confidence FROM ({COMP}) t GROUP BY module")
def module_buckets(spark, sf_dir):
    return A.module_buckets(B.source(spark, sf_dir, B.COMPONENTS))


@register("grouped_names", f"SELECT 'type' AS grouping, component_type AS key, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM ({COMP}) t GROUP BY component_type UNION ALL SELECT 'layer', layer, count(*), string_agg(DISTINCT name, ',' ORDER BY name) FROM ({COMP}) t GROUP BY layer")
def grouped_names(spark, sf_dir):
    c = B.source(spark, sf_dir, B.COMPONENTS)
    one = lambda label, key: c.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"), A.sorted_names("name").alias("names")).select(F.lit(label).alias("grouping"), "key", "n", "names")
    return one("type", "component_type").unionByName(one("layer", "layer"))


@register("entrypoints_by_type", f"SELECT type, count(*) AS n, count(*) FILTER (WHERE method = 'GET') AS n_get, count(*) FILTER (WHERE method = 'POST') AS n_post, count(DISTINCT owner) AS owners FROM ({B.duck(ENTRIES)}) t GROUP BY type")
def entrypoints_by_type(spark, sf_dir):
    return B.source(spark, sf_dir, ENTRIES).groupBy("type").agg(F.count("*").alias("n"), F.count_if(F.col("method") == "GET").alias("n_get"), F.count_if(F.col("method") == "POST").alias("n_post"), F.count_distinct("owner").alias("owners"))


BEST_SQL = f"b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_test, confidence DESC, seq) AS k FROM ({COMP}) t) t WHERE k = 1), e AS ({EDGE})"


def _ends(spark, sf_dir):
    """Edges with layer, type and module of both ends."""
    best = best_component(B.source(spark, sf_dir, B.COMPONENTS))
    side = lambda s: best.select(F.col("name").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in ("layer", "component_type", "module", "file")))
    return B.source(spark, sf_dir, B.EDGES).join(side("src"), "src").join(side("dst"), "dst")


@register("layer_matrix", f"WITH {BEST_SQL} SELECT x.layer AS source_layer, y.layer AS target_layer, count(*) AS n FROM e JOIN b x ON x.name = e.src JOIN b y ON y.name = e.dst GROUP BY ALL")
def layer_matrix(spark, sf_dir):
    return _ends(spark, sf_dir).groupBy(F.col("src_layer").alias("source_layer"), F.col("dst_layer").alias("target_layer")).agg(F.count("*").alias("n"))


VIOLATION_RULES = C.VIOLATION_RULES
@register("layer_violations", f"WITH {BEST_SQL}, v AS (SELECT e.src, e.dst, e.line, x.layer AS sl, y.layer AS tl, x.component_type AS st, y.component_type AS tt FROM e JOIN b x ON x.name = e.src JOIN b y ON y.name = e.dst WHERE NOT (x.file LIKE 'tests/%' OR y.file LIKE 'tests/%')) SELECT src, dst, line, {case_sql(VIOLATION_RULES)} AS violation FROM v WHERE {case_sql(VIOLATION_RULES)} IS NOT NULL")
def layer_violations(spark, sf_dir):
    return violating_edges(spark, sf_dir).select("src", "dst", "line", "violation")


def violating_edges(spark, sf_dir):
    """Edges between production components that break a layer rule."""
    v = _ends(spark, sf_dir).where("NOT (src_file LIKE 'tests/%' OR dst_file LIKE 'tests/%')")
    v = v.select("seq", "src", "dst", "line", "points", F.col("src_layer").alias("sl"), F.col("dst_layer").alias("tl"), F.col("src_component_type").alias("st"), F.col("dst_component_type").alias("tt"))
    return v.withColumn("violation", column(VIOLATION_RULES)).where("violation IS NOT NULL")


VIOLATIONS_SQL = f"""{BEST_SQL}, v AS (SELECT e.seq, e.src, e.dst, e.points, x.layer AS sl, y.layer AS tl, x.component_type AS st, y.component_type AS tt FROM e JOIN b x ON x.name = e.src JOIN b y ON y.name = e.dst WHERE NOT (x.file LIKE 'tests/%' OR y.file LIKE 'tests/%')),
  g1 AS (SELECT 1 AS generator, min(seq) AS first_seq, 'layer_violation' AS type, concat(src, ' -> ', dst, ': ', {case_sql(VIOLATION_RULES)}) AS subject, count(*) AS n FROM v WHERE {case_sql(VIOLATION_RULES)} IS NOT NULL GROUP BY src, dst, {case_sql(VIOLATION_RULES)}),
  {COUPLED.format(e='e')}, g3 AS (SELECT 3 AS generator, total AS first_seq, 'high_coupling' AS type, name AS subject, total AS n FROM cp WHERE total >= 8 ORDER BY total DESC, name LIMIT 2)"""


@register("violations", f"WITH {VIOLATIONS_SQL}, m AS ({B.duck(MODULES)}), g2 AS (SELECT 2 AS generator, seq AS first_seq, 'circular_dependency' AS type, name AS subject, 1 AS n FROM m WHERE in_cycle), u AS (SELECT * FROM g1 UNION ALL SELECT * FROM g2 UNION ALL SELECT generator, -first_seq, type, subject, n FROM g3) SELECT concat('ARCH-VIOL-', lpad(cast(row_number() OVER (ORDER BY generator, first_seq, subject) AS VARCHAR), 5, '0')) AS violation_id, type, subject, n FROM u")
def violations(spark, sf_dir):
    """Layer violations by kind and components, then module cycles, then the two most coupled components."""
    layer = violating_edges(spark, sf_dir).groupBy("src", "dst", "violation").agg(F.min("seq").alias("first_seq"), F.count("*").alias("n"))
    layer = layer.select(F.lit(1).alias("generator"), "first_seq", F.lit("layer_violation").alias("type"), F.concat("src", F.lit(" -> "), "dst", F.lit(": "), "violation").alias("subject"), "n")
    cycles = B.source(spark, sf_dir, MODULES).where("in_cycle").select(F.lit(2).alias("generator"), F.col("seq").alias("first_seq"), F.lit("circular_dependency").alias("type"), F.col("name").alias("subject"), F.lit(1).cast("long").alias("n"))
    top = A.coupling(B.source(spark, sf_dir, B.EDGES)).where("total >= 8").orderBy(F.desc("total"), "name").limit(2)
    top = top.select(F.lit(3).alias("generator"), (-F.col("total")).alias("first_seq"), F.lit("high_coupling").alias("type"), F.col("name").alias("subject"), F.col("total").alias("n"))
    return W.sequential_ids(layer.unionByName(cycles).unionByName(top), "violation_id", "ARCH-VIOL-%05d", "generator", "first_seq", "subject").select("violation_id", "type", "subject", "n")


@register("capability_map", f"WITH m AS (SELECT module, project, count(*) AS n, count(*) FILTER (WHERE component_type = 'Repository') AS data, cast(sum(points) AS BIGINT) AS points FROM ({COMP}) t GROUP BY module, project) SELECT project AS capability, count(*) AS modules, cast(sum(n) AS BIGINT) AS components, cast(sum(data) AS BIGINT) AS data_components, count(*) FILTER (WHERE n <= 2) AS weak_modules, round(cast(sum(points) AS DOUBLE) / (sum(n) * 100), 3) AS confidence FROM m GROUP BY project")
def capability_map(spark, sf_dir):
    m = B.source(spark, sf_dir, B.COMPONENTS).groupBy("module", "project").agg(F.count("*").alias("n"), F.count_if(F.col("component_type") == "Repository").alias("data"), F.sum("points").alias("points"))
    total = m.groupBy(F.col("project").alias("capability")).agg(F.count("*").alias("modules"), F.sum("n").alias("components"), F.sum("data").alias("data_components"), F.count_if(F.col("n") <= 2).alias("weak_modules"), F.round(F.sum("points").cast("double") / (F.sum("n") * 100), 3).alias("confidence"))
    return total.orderBy(F.desc("components"), "capability")


@register("test_evidence", f"SELECT project AS capability, count(*) AS tests, count(DISTINCT file) AS files FROM ({COMP}) t WHERE file LIKE 'tests/%' GROUP BY project")
def test_evidence(spark, sf_dir):
    return B.source(spark, sf_dir, B.COMPONENTS).where("file LIKE 'tests/%'").groupBy(F.col("project").alias("capability")).agg(F.count("*").alias("tests"), F.count_distinct("file").alias("files")).orderBy(F.desc("tests"), "capability")


@register("confidence_report", f"SELECT 'components' AS section, count(*) FILTER (WHERE confidence >= 0.8) AS high, count(*) FILTER (WHERE confidence < 0.8 AND confidence >= 0.6) AS medium, count(*) FILTER (WHERE confidence < 0.6) AS low FROM ({COMP}) t UNION ALL SELECT 'edges', count(*) FILTER (WHERE confidence >= 0.8), count(*) FILTER (WHERE confidence < 0.8 AND confidence >= 0.6), count(*) FILTER (WHERE confidence < 0.6) FROM ({EDGE}) t")
def confidence_report(spark, sf_dir):
    one = lambda name, rows: rows.agg(F.count_if(F.expr("confidence >= 0.8")).alias("high"), F.count_if(F.expr("confidence < 0.8 AND confidence >= 0.6")).alias("medium"), F.count_if(F.expr("confidence < 0.6")).alias("low")).select(F.lit(name).alias("section"), "high", "medium", "low")
    return one("components", B.source(spark, sf_dir, B.COMPONENTS)).unionByName(one("edges", B.source(spark, sf_dir, B.EDGES)))


@register("invocation_summary", f"SELECT type, method, count(*) AS n, count(*) FILTER (WHERE steps = 0) AS unresolved FROM ({B.duck(ENTRIES)}) t GROUP BY type, method")
def invocation_summary(spark, sf_dir):
    return B.source(spark, sf_dir, ENTRIES).groupBy("type", "method").agg(F.count("*").alias("n"), F.count_if(F.col("steps") == 0).alias("unresolved"))


@register("confidence_composite", f"SELECT seq, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, points / 100.0::DOUBLE * 0.62::DOUBLE + (points * 7 % 100) / 100.0::DOUBLE * 0.28::DOUBLE + least(seq % 6, 4) * 0.025::DOUBLE - least(0.18::DOUBLE, (seq % 7) * 0.04::DOUBLE))), 3) AS composite FROM ({COMP}) t")
def confidence_composite(spark, sf_dir):
    c = B.source(spark, sf_dir, B.COMPONENTS)
    return c.select("seq", A.composite(F.col("points"), F.col("points") * 7 % 100, F.col("seq") % 6, F.col("seq") % 7).alias("composite"))


@register("argmax_pattern", f"SELECT module, name, confidence FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY confidence DESC, seq) AS k FROM ({COMP}) t) t WHERE k = 1")
def argmax_pattern(spark, sf_dir):
    return pick(B.source(spark, sf_dir, B.COMPONENTS), ["module"], F.desc("confidence"), F.col("seq")).select("module", "name", "confidence")


RISKS_SQL = f"""{VIOLATIONS_SQL}, m AS ({B.duck(MODULES)}), fl AS (SELECT *, {C.FLOW_PARTIAL} AS partial FROM ({B.duck(FLOWS)}) f0), c0 AS ({COMP}),
  r AS ((SELECT 1 AS generator, 0 AS place, 'unclear_boundary' AS category, name AS subject, 'High' AS severity FROM m WHERE confidence < 0.7 OR coupling >= 5 ORDER BY coupling DESC, seq LIMIT 1)
    UNION ALL SELECT 2, seq, 'circular_dependency', name, 'High' FROM m WHERE in_cycle
    UNION ALL SELECT 3, 0, 'high_coupling', string_agg(name, ', ' ORDER BY coupling DESC, seq), 'High' FROM (SELECT * FROM m WHERE coupling >= 3 ORDER BY coupling DESC, seq LIMIT 5) t HAVING count(*) > 0
    UNION ALL (SELECT 4, 0, 'shared_dependency', subject, 'High' FROM g3 ORDER BY n DESC, subject LIMIT 1)
    UNION ALL SELECT 5, 0, 'unknown', concat(cast(count(*) AS VARCHAR), ' partial flows'), 'Medium' FROM fl WHERE partial
    UNION ALL SELECT 6, 0, 'frontend_backend_coupling', concat(cast(count(*) AS VARCHAR), ' frontend calls'), 'Medium' FROM fl WHERE type = 'FrontendRoute' AND external HAVING count(*) > 0
    UNION ALL (SELECT 7, 0, 'unknown', subject, 'Medium' FROM g1 ORDER BY first_seq, subject LIMIT 1)
    UNION ALL SELECT 8, 0, 'unclear_boundary', concat(cast(count(*) FILTER (WHERE module = 'Unknown') AS VARCHAR), ' without module, ', cast(count(*) FILTER (WHERE component_type = 'Unknown') AS VARCHAR), ' without type'), 'Medium' FROM c0
    UNION ALL SELECT 9, 0, 'integration_scatter', concat(cast(count(DISTINCT dst) AS VARCHAR), ' external targets'), 'Medium' FROM e WHERE kind = 'http_client_call' HAVING count(*) > 0)"""


@register("risk_register", f"WITH {RISKS_SQL} SELECT concat('APP-RISK-', lpad(cast(row_number() OVER (ORDER BY generator, place, subject) AS VARCHAR), 5, '0')) AS risk_id, category, subject, severity FROM r")
def risk_register(spark, sf_dir):
    """Nine generators in a fixed order; some look at the first or largest row only, as their definition says."""
    m, e, flows = B.source(spark, sf_dir, MODULES), B.source(spark, sf_dir, B.EDGES), B.source(spark, sf_dir, FLOWS)
    row = lambda rows, generator, category, subject, severity, place=F.lit(0): rows.select(F.lit(generator).alias("generator"), place.cast("long").alias("place"), F.lit(category).alias("category"), subject.alias("subject"), F.lit(severity).alias("severity"))
    named = lambda count, text: F.concat(F.col(count).cast("string"), F.lit(text))
    count = lambda rows: rows.agg(F.count("*").alias("n"))
    high = m.where("coupling >= 3").orderBy(F.desc("coupling"), "seq").limit(5).agg(F.array_sort(F.collect_list(F.struct((-F.col("coupling")).alias("c"), "seq", "name"))).alias("h")).where(F.size("h") > 0)
    layer = violating_edges(spark, sf_dir).groupBy("src", "dst", "violation").agg(F.min("seq").alias("first_seq")).withColumn("subject", F.concat("src", F.lit(" -> "), "dst", F.lit(": "), "violation"))
    unknown = B.source(spark, sf_dir, B.COMPONENTS).agg(F.count_if(F.col("module") == "Unknown").alias("m"), F.count_if(F.col("component_type") == "Unknown").alias("t"))
    made = [
        row(m.where("confidence < 0.7 OR coupling >= 5").orderBy(F.desc("coupling"), "seq").limit(1), 1, "unclear_boundary", F.col("name"), "High"),
        row(m.where("in_cycle"), 2, "circular_dependency", F.col("name"), "High", F.col("seq")),
        row(high, 3, "high_coupling", F.array_join(F.col("h")["name"], ", "), "High"),
        row(A.coupling(e).where("total >= 8").orderBy(F.desc("total"), "name").limit(1), 4, "shared_dependency", F.col("name"), "High"),
        row(count(flows.where(C.FLOW_PARTIAL)), 5, "unknown", named("n", " partial flows"), "Medium"),
        row(count(flows.where("type = 'FrontendRoute' AND external")).where("n > 0"), 6, "frontend_backend_coupling", named("n", " frontend calls"), "Medium"),
        row(layer.orderBy("first_seq", "subject").limit(1), 7, "unknown", F.col("subject"), "Medium"),
        row(unknown, 8, "unclear_boundary", F.concat(named("m", " without module, "), named("t", " without type")), "Medium"),
        row(e.where("kind = 'http_client_call'").agg(F.count_distinct("dst").alias("n")).where("n > 0"), 9, "integration_scatter", named("n", " external targets"), "Medium"),
    ]
    every = made[0]
    for one in made[1:]:
        every = every.unionByName(one)
    return W.sequential_ids(every, "risk_id", "APP-RISK-%05d", "generator", "place", "subject").select("risk_id", "category", "subject", "severity")


# --- dedup ---
ARTIFACTS = "SELECT doc_id AS seq, source AS name, text AS content FROM <<documents>>"


@register("dedup_md5", r"SELECT seq, name, content_hash FROM (SELECT seq, name, md5(concat(name, '|', trim(content, chr(10) || ' '))) AS content_hash, row_number() OVER (PARTITION BY md5(concat(name, '|', trim(content, chr(10) || ' '))) ORDER BY seq) AS k FROM (SELECT doc_id AS seq, source AS name, text AS content FROM documents) t WHERE length(trim(content, chr(10) || ' ')) >= 10) t WHERE k = 1")
def dedup_md5(spark, sf_dir):
    rows = B.source(spark, sf_dir, ARTIFACTS).withColumn("stripped", F.expr("trim(BOTH concat(chr(10), ' ') FROM content)")).where("length(stripped) >= 10")
    keyed = rows.select("seq", "name", F.md5(F.concat("name", F.lit("|"), "stripped")).alias("content_hash"))
    return keyed.groupBy("content_hash").agg(F.min(F.struct("seq", "name")).alias("first")).select("first.seq", "first.name", "content_hash")


OBJECTS = "SELECT p_partkey AS seq, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_name END AS name, CASE WHEN p_size % 8 = 0 THEN p_brand END AS entity_name FROM <<part>>"


@register("dedup_db", f"SELECT seq, key FROM (SELECT seq, coalesce(name, entity_name) AS key, row_number() OVER (PARTITION BY coalesce(name, entity_name) ORDER BY seq) AS k FROM ({B.duck(OBJECTS)}) t WHERE coalesce(name, entity_name) IS NOT NULL) t WHERE k = 1")
def dedup_db(spark, sf_dir):
    rows = B.source(spark, sf_dir, OBJECTS).withColumn("key", F.coalesce("name", "entity_name")).where("key IS NOT NULL")
    return rows.groupBy("key").agg(F.min("seq").alias("seq"))


@register("dedup_multikey", f"SELECT src, dst, kind, min(seq) AS seq FROM ({EDGE}) t GROUP BY src, dst, kind")
def dedup_multikey(spark, sf_dir):
    return B.source(spark, sf_dir, B.EDGES).groupBy("src", "dst", "kind").agg(F.min("seq").alias("seq"))


@register("array_distinct", f"SELECT src, count(*) AS n FROM (SELECT DISTINCT src, dst, kind, line FROM ({EDGE}) t) u GROUP BY src")
def array_distinct(spark, sf_dir):
    return B.source(spark, sf_dir, B.EDGES).select("src", "dst", "kind", "line").distinct().groupBy("src").agg(F.count("*").alias("n"))


@register("unique_sorted", f"SELECT project, string_agg(DISTINCT module, ',' ORDER BY module) FILTER (WHERE module NOT IN ('', 'unknown', 'Unknown')) AS modules FROM ({COMP}) t GROUP BY project")
def unique_sorted(spark, sf_dir):
    known = F.when(~F.col("module").isin("", "unknown", "Unknown"), F.col("module"))
    return B.source(spark, sf_dir, B.COMPONENTS).groupBy("project").agg(F.array_join(F.array_sort(F.collect_set(known)), ",").alias("modules"))


@register("merge_first_wins", f"SELECT seq, item FROM (SELECT seq, coalesce(name, entity_name, cast(seq AS VARCHAR)) AS item, row_number() OVER (PARTITION BY coalesce(name, entity_name, cast(seq AS VARCHAR)) ORDER BY seq) AS k FROM ({B.duck(OBJECTS)}) t) t WHERE k = 1")
def merge_first_wins(spark, sf_dir):
    return B.source(spark, sf_dir, OBJECTS).groupBy(F.coalesce("name", "entity_name", F.col("seq").cast("string")).alias("item")).agg(F.min("seq").alias("seq"))


# --- windows, order, limits ---
LOG_SQL = f"""l AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY seq) AS ln, dense_rank() OVER (ORDER BY path) AS fn FROM ({B.duck(B.LOGS)}) t), ev AS (SELECT seq, path, upper(regexp_extract(line, '(?i)\\b({'|'.join(fixed.LOG_ACTIONS)})\\b', 1)) AS action,
  CASE WHEN regexp_matches(line, '(?i)\\b({'|'.join(fixed.LOG_LEVELS)})\\b') THEN upper(regexp_extract(line, '(?i)\\b({'|'.join(fixed.LOG_LEVELS)})\\b', 1)) ELSE 'INFO' END AS log_level, substring(line, 1, 200) AS raw_line FROM l WHERE fn <= 10 AND ln <= 5000 AND regexp_matches(line, '(?i)\\b({'|'.join(fixed.LOG_ACTIONS)})\\b'))"""


def log_event_rows(spark, sf_dir):
    """Action events of the first 10 log files' first 5000 lines (the limits are the operator's)."""
    lines = B.source(spark, sf_dir, B.LOGS)
    files = lines.select("path").distinct().orderBy("path").limit(10)
    rows = lines.join(files, "path", "left_semi").withColumn("ln", F.row_number().over(Window.partitionBy("path").orderBy("seq"))).where("ln <= 5000")
    action, level = rf"(?i)\b({'|'.join(fixed.LOG_ACTIONS)})\b", rf"(?i)\b({'|'.join(fixed.LOG_LEVELS)})\b"
    found = F.regexp_extract("line", level, 1)
    rows = rows.where(F.col("line").rlike(action))
    return rows.select("seq", "path", F.upper(F.regexp_extract("line", action, 1)).alias("action"), F.when(found != "", F.upper(found)).otherwise("INFO").alias("log_level"), F.substring("line", 1, 200).alias("raw_line"))


@register("log_events", f"WITH {LOG_SQL} SELECT seq, path, action, log_level, raw_line FROM ev")
def log_events(spark, sf_dir):
    return log_event_rows(spark, sf_dir)


@register("event_transitions", f"WITH {LOG_SQL}, p AS (SELECT seq, concat(lag(action) OVER (ORDER BY seq), ' → ', action) AS sequence, lag(action) OVER (ORDER BY seq) IS NOT NULL AS ok FROM ev) SELECT sequence, count(*) AS frequency FROM p WHERE ok GROUP BY sequence ORDER BY frequency DESC, min(seq) LIMIT 15")
def event_transitions(spark, sf_dir):
    pairs = W.bigrams(log_event_rows(spark, sf_dir), [])
    return pairs.groupBy("sequence").agg(F.count("*").alias("frequency"), F.min("seq").alias("first_seq")).orderBy(F.desc("frequency"), "first_seq").limit(15).select("sequence", "frequency")


@register("sequential_ids", f"SELECT printf('COMP-%04d', row_number() OVER (ORDER BY seq)) AS component_id, seq, name FROM ({COMP}) t")
def sequential_ids(spark, sf_dir):
    return W.sequential_ids(B.source(spark, sf_dir, B.COMPONENTS).select("seq", "name"), "component_id", "COMP-%04d", "seq")


@register("source_chunks", """WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), c AS (SELECT doc_id, ls, unnest(range(0, greatest(0, len(ls) - 1 - 1) + 1, 3)) AS s FROM d)
  SELECT doc_id, s + 1 AS start_line, cast(least(s + 4, len(ls)) AS BIGINT) AS end_line, sha256(array_to_string(ls[s + 1:s + 4], chr(10))) AS chunk_sha256 FROM c""")
def source_chunks(spark, sf_dir):
    rows = W.chunks(B.source(spark, sf_dir, "SELECT doc_id, text FROM <<documents>>"), 4, 1)
    return rows.select("doc_id", "start_line", "end_line", F.sha2("chunk_text", 256).alias("chunk_sha256"))


@register("topk_per_group", f"SELECT module, name, seq, rank FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY confidence DESC, seq) AS rank FROM ({COMP}) t) t WHERE rank <= 6")
def topk_per_group(spark, sf_dir):
    return W.top_k(B.source(spark, sf_dir, B.COMPONENTS), ["module"], 6, F.desc("confidence"), F.col("seq")).select("module", "name", "seq", "rank")


#: Edges with what the relevance score asks of the caller and the target.
SCORED = f"""SELECT e.*, CASE WHEN line % 3 = 0 THEN 'HandleAsync' WHEN line % 3 = 1 THEN 'Run' END AS source_method, CASE WHEN points >= 95 THEN 'HandleAsync' ELSE 'unknown' END AS route_action, coalesce(t.component_type, 'Unknown') AS target_type, coalesce(t.layer, 'Unknown') AS target_layer
  FROM ({B.EDGES}) e LEFT JOIN (SELECT name, component_type, layer FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_test, confidence DESC, seq) AS k FROM ({B.COMPONENTS}) c0) c1 WHERE k = 1) t ON t.name = e.dst"""
SCORE = C.EDGE_SCORE


@register("edge_ranking", f"SELECT src, dst, file, line, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, file, line, dst, seq) AS rank FROM (SELECT *, {SCORE} AS score FROM ({B.duck(SCORED)}) t) u) v WHERE rank <= 6")
def edge_ranking(spark, sf_dir):
    rows = B.source(spark, sf_dir, SCORED).withColumn("score", F.expr(SCORE))
    return W.top_k(rows, ["src"], 6, F.desc("score"), *map(F.col, ("file", "line", "dst", "seq"))).select("src", "dst", "file", "line", "score", "rank")


SKIP = ", ".join(quote(x) for x in fixed.CHUNK_SKIP_FOLDERS)


@register("module_chunks", f"""WITH f AS (SELECT seq, path, list_filter(string_split(path, '/'), lambda p: lower(p) NOT IN ({SKIP}) AND p <> '') AS ps, string_split(path, '/') AS a FROM ({FILE}) t), k AS (SELECT seq, coalesce(ps[1], a[-2], 'unknown') AS key FROM f), n AS (SELECT key, row_number() OVER (ORDER BY count(*) DESC, key) AS place FROM k GROUP BY key)
  SELECT key, place, seq, rank FROM (SELECT k.key, place, seq, row_number() OVER (PARTITION BY k.key ORDER BY seq) AS rank FROM k JOIN n USING (key) WHERE place <= 6) t WHERE rank <= 80""")
def module_chunks(spark, sf_dir):
    parts = F.split("path", "/")
    kept = F.filter(parts, lambda p: ~F.lower(p).isin(fixed.CHUNK_SKIP_FOLDERS) & (p != ""))
    keyed = B.source(spark, sf_dir, B.FILES).select("seq", F.coalesce(F.get(kept, F.lit(0)), F.try_element_at(parts, F.lit(-2)), F.lit("unknown")).alias("key"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "key"))
    top = keyed.groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "key").limit(6).withColumn("place", place).select("key", "place")
    return W.top_k(keyed.join(top, "key"), ["key"], 80, F.col("seq")).select("key", "place", "seq", "rank")


@register("adaptive_limit", f"WITH n AS (SELECT CASE WHEN count(*) > 5000 THEN 20 WHEN count(*) > 1000 THEN 35 ELSE 60 END AS k FROM ({COMP}) t) SELECT component_type, name, seq, rank FROM (SELECT *, row_number() OVER (PARTITION BY component_type ORDER BY seq) AS rank FROM ({COMP}) t) t, n WHERE rank <= k")
def adaptive_limit(spark, sf_dir):
    c = B.source(spark, sf_dir, B.COMPONENTS)
    n = c.count()
    k = 20 if n > 5000 else 35 if n > 1000 else 60
    return W.top_k(c, ["component_type"], k, F.col("seq")).select("component_type", "name", "seq", "rank")


@register("context_trim", "SELECT doc_id, substring(text, 1, 800) AS head, length(text) > 800 AS cut FROM documents ORDER BY doc_id LIMIT 50")
def context_trim(spark, sf_dir):
    return B.source(spark, sf_dir, "SELECT doc_id, text FROM <<documents>>").orderBy("doc_id").limit(50).select("doc_id", F.substring("text", 1, 800).alias("head"), (F.length("text") > 800).alias("cut"))


PROMPT_BUDGET = 60_000

#: Of each layer (source) the first 10 documents with 3000 characters each, serialised in order.
SERIALISED = "SELECT layer, doc_id, concat(chr(34), layer, '/', cast(doc_id AS varchar(20)), chr(34), ': ', chr(34), substring(text, 1, 3000), chr(34), ',', chr(10)) AS entry FROM (SELECT coalesce(source, 'none') AS layer, doc_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) AS k FROM <<documents>>) d WHERE k <= 10"


@register("prompt_budget", f"WITH e AS ({B.duck(SERIALISED)}), r AS (SELECT *, sum(length(entry)) OVER (ORDER BY layer, doc_id) - length(entry) AS start FROM e) SELECT layer, doc_id, start::BIGINT AS start, length(entry) > {PROMPT_BUDGET} - start AS cut, sha256(substring(entry, 1, ({PROMPT_BUDGET} - start)::BIGINT)) AS entry_sha256 FROM r WHERE start < {PROMPT_BUDGET}")
def prompt_budget(spark, sf_dir):
    """What of all layers' serialised outputs fits the prompt: entries in order, the last one cut in its midst."""
    found = W.within_budget(B.source(spark, sf_dir, SERIALISED), "entry", PROMPT_BUDGET, "layer", "doc_id")
    return found.select("layer", "doc_id", "start", "cut", F.sha2("entry", 256).alias("entry_sha256"))


@register("context_budget", f"WITH e AS (SELECT doc_id, substring(coalesce(text, ''), 1, 800) AS head FROM documents), r AS (SELECT *, sum(length(head)) OVER (ORDER BY doc_id) - length(head) AS start FROM e) SELECT doc_id, start::BIGINT AS start, length(head) > {PROMPT_BUDGET} - start AS cut, sha256(substring(head, 1, ({PROMPT_BUDGET} - start)::BIGINT)) AS head_sha256 FROM r WHERE start < {PROMPT_BUDGET} AND head <> ''")
def context_budget(spark, sf_dir):
    """Heads of 800 characters of all documents in order, as far as the budget goes."""
    heads = B.source(spark, sf_dir, "SELECT doc_id, substring(coalesce(text, ''), 1, 800) AS head FROM <<documents>>")
    return W.within_budget(heads, "head", PROMPT_BUDGET, "doc_id").select("doc_id", "start", "cut", F.sha2("head", 256).alias("head_sha256"))


CONTEXT = f"(regexp_like(lower_name, {quote('^(' + '|'.join(fixed.CONTEXT_FILES) + ')$')}) OR regexp_like(concat('/', lower_path), {quote('/(' + '|'.join(x.replace('.', '[.]') for x in fixed.CONTEXT_FOLDERS) + ')/')}))"


#: Files with the texts of documents as their bodies.
BODIES = f"SELECT f.path, f.seq, f.lower_path, f.lower_name, f.suffix, d.text FROM ({B.FILES}) f JOIN <<documents>> d ON d.doc_id = f.seq"
PRUNED = "regexp_like(concat('/', lower_path), '/(node_modules|bin|obj|dist|build|target|vendor)/') OR regexp_like(lower_name, '[.]min[.](js|css)$')"


@register("context_topk_truncate", f"SELECT path, seq, substring(text, 1, 4000) AS content, length(text) > 4000 AS truncated FROM ({B.duck(BODIES)}) t WHERE {CONTEXT} AND NOT ({PRUNED}) AND text IS NOT NULL ORDER BY path, seq LIMIT 80")
def context_topk_truncate(spark, sf_dir):
    """The first 80 build and deployment files by path, at most 4,000 characters of each, without pruned folders and minified files: the collector's own limits."""
    rows = B.source(spark, sf_dir, BODIES).where(f"{CONTEXT} AND NOT ({PRUNED}) AND text IS NOT NULL").orderBy("path", "seq").limit(80)
    return rows.select("path", "seq", F.substring("text", 1, 4000).alias("content"), (F.length("text") > 4000).alias("truncated"))


@register("per_layer_top10", f"SELECT layer, seq, substring(file, 1, 30) AS head, rank FROM (SELECT *, row_number() OVER (PARTITION BY layer ORDER BY file, seq) AS rank FROM ({COMP}) t) t WHERE rank <= 10")
def per_layer_top10(spark, sf_dir):
    return W.top_k(B.source(spark, sf_dir, B.COMPONENTS), ["layer"], 10, F.col("file"), F.col("seq")).select("layer", "seq", F.substring("file", 1, 30).alias("head"), "rank")


SCORES = case_sql([(c, r.split(", ")[1]) for c, r in C.STRANGLER_RULES])


@register("strangler_order", f"WITH m AS (SELECT seq, name, {SCORES} AS score FROM ({B.duck(MODULES)}) t) SELECT name, score, place FROM ((SELECT name, score, row_number() OVER (ORDER BY seq) AS place FROM m WHERE score = 90 QUALIFY place <= 4) UNION ALL (SELECT name, score, 4 + row_number() OVER (ORDER BY score DESC, seq) AS place FROM m WHERE score IN (55, 70) QUALIFY place <= 9)) t")
def strangler_order(spark, sf_dir):
    """The first four good candidates, then the first five possible ones, best score first."""
    m = B.source(spark, sf_dir, MODULES).select("seq", "name", F.expr(SCORES).alias("score"))
    first = lambda rows, k, shift: rows.orderBy(F.desc("score"), "seq").limit(k).select("name", "score", (F.row_number().over(Window.orderBy(F.desc("score"), "seq")) + shift).cast("long").alias("place"))
    return first(m.where("score = 90"), 4, 0).unionByName(first(m.where("score IN (55, 70)"), 5, 4))


# --- packs and reports ---
@register("source_files", f"SELECT src, string_agg(DISTINCT file, ',' ORDER BY file) AS files FROM ({EDGE}) t GROUP BY src")
def source_files(spark, sf_dir):
    return B.source(spark, sf_dir, B.EDGES).groupBy("src").agg(A.sorted_names("file").alias("files"))


@register("interface_catalogue", f"SELECT concat('INT-', lpad(cast(row_number() OVER (ORDER BY seq) AS VARCHAR), 6, '0')) AS interface_id, seq, path, {case_sql(C.INTERFACE_RULES, quote('unknown'))} AS visibility, type = 'HTTP_API' AS is_http, steps > 0 AS resolved FROM ({B.duck(ENTRIES)}) t")
def interface_catalogue(spark, sf_dir):
    rows = W.sequential_ids(B.source(spark, sf_dir, ENTRIES), "interface_id", "INT-%06d", "seq")
    return rows.select("interface_id", "seq", "path", column(C.INTERFACE_RULES, "'unknown'").alias("visibility"), (F.col("type") == "HTTP_API").alias("is_http"), (F.col("steps") > 0).alias("resolved"))


@register("module_blueprint", f"WITH {MODULE_EDGE_SQL}, {COUPLED.format(e='me')}, m AS (SELECT module, count(*) AS components, string_agg(DISTINCT component_type, ',' ORDER BY component_type) AS types FROM ({COMP}) t GROUP BY module) SELECT m.module, components, types, coalesce(afferent, 0) AS afferent, coalesce(efferent, 0) AS efferent FROM m LEFT JOIN cp ON cp.name = m.module")
def module_blueprint(spark, sf_dir):
    m = B.source(spark, sf_dir, B.COMPONENTS).groupBy("module").agg(F.count("*").alias("components"), A.sorted_names("component_type").alias("types"))
    cp = coupling_of(module_edge_rows(spark, sf_dir)).withColumnRenamed("name", "module")
    return m.join(cp, "module", "left").select("module", "components", "types", F.coalesce("afferent", F.lit(0)).alias("afferent"), F.coalesce("efferent", F.lit(0)).alias("efferent"))
