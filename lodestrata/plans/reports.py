"""Packs and planning reports: inventories, boundaries, stacks, scenarios, backlog, waves, questions.

Lists that a report cuts (the first eight reviews, say) are cut by the report's own definition, in a stated order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.rules import case_sql, quote
from lodestrata.operators import classify as C
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import ORACLES, register
from lodestrata.plans.classification import CAPABILITIES, CLASSED, ENTRIES, FLOWS, MODULES, PACKAGES, PROJECTS
from lodestrata.plans.rollups import BODIES, risk_register, violations

COMP, EDGE, FILE = B.duck(B.COMPONENTS), B.duck(B.EDGES), B.duck(B.FILES)
HAND_CLASS = """CASE WHEN all_tests THEN 'TestVerification' WHEN name = 'Cache' THEN 'TechnicalSupport' WHEN repositories >= 1 THEN 'DataInfrastructure' WHEN entities >= 1 THEN 'DomainCapabilityCandidate' WHEN interfaces >= 1 THEN 'InterfaceCapabilityCandidate' ELSE 'Other' END"""
HAND_CAPS = f"""SELECT *, CASE WHEN k IN ('TestVerification', 'TechnicalSupport') THEN 'review' WHEN weak_modules >= 1 OR risk_count > 2 THEN 'review_before_extraction' WHEN interfaces >= 1 AND efferent < 3 THEN 'candidate_for_early_modernization'
  WHEN interfaces = 0 AND data_access >= 1 THEN 'preserve_as_internal_until_ownership_confirmed' ELSE 'review' END AS decision FROM (SELECT *, {HAND_CLASS} AS k FROM ({B.duck(CAPABILITIES)}) c) c"""
HAND_CONTRACTS = f"""SELECT seq, concat(CASE method WHEN 'unknown' THEN 'ANY' ELSE method END, ' ', path) AS name, CASE WHEN type = 'HTTP_API' AND method <> 'unknown' AND confidence >= 0.7 AND (confidence >= 0.85 OR position('{{' IN path) = 0) THEN 'preserve' ELSE 'review' END AS decision FROM ({B.duck(ENTRIES)}) e"""


def capabilities(spark, sf_dir) -> DataFrame:
    return B.source(spark, sf_dir, CLASSED).withColumn("decision", F.expr(case_sql(C.CAPABILITY_DECISION, "'review'")))


def contracts(spark, sf_dir) -> DataFrame:
    rows = B.source(spark, sf_dir, ENTRIES).withColumn("decision", F.expr(case_sql(C.INTERFACE_DECISION, "'preserve'")))
    return rows.select("seq", F.concat(F.when(F.col("method") == "unknown", "ANY").otherwise(F.col("method")), F.lit(" "), "path").alias("name"), "decision")


def first(rows: DataFrame, k: int, *order: str) -> DataFrame:
    """The first ``k`` rows in ``order``, numbered from 1; Spark keeps no more than that of each partition."""
    return rows.orderBy(*order).limit(k).withColumn("place", F.row_number().over(Window.orderBy(*order)))


# --- backlog: generators in a fixed order; ids are dense over all of them ---
QUESTIONS = ["Confirm the authoritative system name; evidence packs leave system_name as unknown.", "Review generated/migration source exclusions before relying on this package for database migration planning."]
REVIEWS, RISKS, PRESERVED, REVIEWED, ASKED = 8, 8, 8, 8, 6
# What closes an item.
DONE = {
    0: "System name and deployable ownership are confirmed or intentionally kept unknown.",
    1: "Architect records preserve/merge/extract decision with data ownership and API impact.",
    2: "Risk is accepted, mitigated, or converted into implementation constraints.",
    3: "Forward implementation can prove behavioral compatibility or intentional redesign.",
    4: "Contract is classified as preserve, redesign, or retire with owner approval.",
}


def _item(rows: DataFrame, generator: int, title, source: str, priority, acceptance=None) -> DataFrame:
    done = F.lit(DONE[generator]) if acceptance is None else acceptance
    return rows.select(F.lit(generator).alias("generator"), "place", title.alias("title"), F.lit(source).alias("source"), priority.alias("priority"), done.alias("acceptance"))


@register("backlog", f"""WITH k AS ({HAND_CAPS}), t AS ({HAND_CONTRACTS}), r AS ({ORACLES['risk_register']}), b AS (
  SELECT 0 AS g, 1 AS p, 'Confirm authoritative system name and deployment ownership' AS title, 'open-questions.md' AS source, 'High' AS priority, {quote(DONE[0])} AS acceptance
  UNION ALL (SELECT 1, row_number() OVER (ORDER BY seq), concat('Review future boundary for ', name), 'business-capability-map.json', CASE WHEN risk_count > 0 THEN 'High' ELSE 'Medium' END, {quote(DONE[1])} FROM k WHERE decision = 'review_before_extraction' ORDER BY seq LIMIT 8)
  UNION ALL (SELECT 2, row_number() OVER (ORDER BY risk_id), concat('Resolve architecture risk ', risk_id), 'application-risk-register.json', CASE WHEN severity IN ('Critical', 'High') THEN 'High' ELSE 'Medium' END, {quote(DONE[2])} FROM r ORDER BY risk_id LIMIT 8)
  UNION ALL (SELECT 3, row_number() OVER (ORDER BY seq), concat('Create contract test for ', name), 'api-contract-preservation-map.json', 'Medium', {quote(DONE[3])} FROM t WHERE decision = 'preserve' ORDER BY seq LIMIT 8)
  UNION ALL (SELECT 4, row_number() OVER (ORDER BY seq), concat('Review API contract ', name), 'api-contract-preservation-map.json', 'Medium', {quote(DONE[4])} FROM t WHERE decision = 'review' ORDER BY seq LIMIT 8)
  UNION ALL SELECT 5, 1, 'Resolve open architecture question', 'open-questions.md', 'Medium', {quote(QUESTIONS[0])} UNION ALL SELECT 5, 2, 'Resolve open architecture question', 'open-questions.md', 'Medium', {quote(QUESTIONS[1])})
  SELECT concat('FE-', lpad(cast(row_number() OVER (ORDER BY g, p) AS VARCHAR), 3, '0')) AS backlog_id, title, source, priority, acceptance FROM b""")
def backlog(spark, sf_dir):
    """Planning tasks: one on the system's name, then capability reviews, risks, contracts to preserve, contracts to review, open questions; at most 39 rows in all."""
    caps = first(capabilities(spark, sf_dir).where("decision = 'review_before_extraction'"), REVIEWS, "seq")
    risks = first(risk_register(spark, sf_dir), RISKS, "risk_id")
    kept, open_ = (first(contracts(spark, sf_dir).where(F.col("decision") == d), n, "seq") for d, n in (("preserve", PRESERVED), ("review", REVIEWED)))
    asked = spark.createDataFrame(list(enumerate(QUESTIONS[:ASKED], 1)), "place int, question string")
    medium = F.lit("Medium")
    parts = [
        _item(spark.range(1).withColumn("place", F.lit(1)), 0, F.lit("Confirm authoritative system name and deployment ownership"), "open-questions.md", F.lit("High")),
        _item(caps, 1, F.concat(F.lit("Review future boundary for "), "name"), "business-capability-map.json", F.when(F.col("risk_count") > 0, "High").otherwise("Medium")),
        _item(risks, 2, F.concat(F.lit("Resolve architecture risk "), "risk_id"), "application-risk-register.json", F.when(F.col("severity").isin("Critical", "High"), "High").otherwise("Medium")),
        _item(kept, 3, F.concat(F.lit("Create contract test for "), "name"), "api-contract-preservation-map.json", medium),
        _item(open_, 4, F.concat(F.lit("Review API contract "), "name"), "api-contract-preservation-map.json", medium),
        _item(asked, 5, F.lit("Resolve open architecture question"), "open-questions.md", medium, F.col("question")),
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    number = F.row_number().over(Window.orderBy("generator", "place"))  # 39 rows at most
    return found.select(F.format_string("FE-%03d", number).alias("backlog_id"), "title", "source", "priority", "acceptance")


@register("wave_plan", f"""WITH k AS ({HAND_CAPS}), t AS ({HAND_CONTRACTS})
  (SELECT 0 AS wave, row_number() OVER (ORDER BY seq) AS place, name FROM t WHERE decision = 'preserve' ORDER BY seq LIMIT 12) UNION ALL (SELECT 1, row_number() OVER (ORDER BY seq), name FROM k WHERE decision = 'candidate_for_early_modernization' ORDER BY seq LIMIT 5)
  UNION ALL (SELECT 2, row_number() OVER (ORDER BY seq), name FROM t WHERE decision = 'review' ORDER BY seq LIMIT 12) UNION ALL (SELECT 4, row_number() OVER (ORDER BY seq), name FROM k WHERE decision = 'review_before_extraction' ORDER BY seq LIMIT 8)""")
def wave_plan(spark, sf_dir):
    """What each wave names: contracts to stabilise (0), capabilities with low coupling (1), contracts to align (2), capabilities to defer (4)."""
    caps, told = capabilities(spark, sf_dir), contracts(spark, sf_dir)
    waves = [(0, told, "preserve", 12), (1, caps, "candidate_for_early_modernization", 5), (2, told, "review", 12), (4, caps, "review_before_extraction", 8)]
    parts = [first(rows.where(F.col("decision") == d), n, "seq").select(F.lit(w).alias("wave"), "place", "name") for w, rows, d, n in waves]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


OPTIONS = [("A", "review_before_extraction"), ("B", "candidate_for_early_modernization"), ("C", "preserve_as_internal_until_ownership_confirmed")]


@register("boundary_options", f"WITH k AS ({HAND_CAPS}) " + " UNION ALL ".join(f"(SELECT '{o}' AS option, row_number() OVER (ORDER BY seq) AS place, name FROM k WHERE decision = '{d}' ORDER BY seq LIMIT 8)" for o, d in OPTIONS))
def boundary_options(spark, sf_dir):
    """The first eight capabilities of each option."""
    caps = capabilities(spark, sf_dir)
    parts = [first(caps.where(F.col("decision") == d), 8, "seq").select(F.lit(o).alias("option"), "place", "name") for o, d in OPTIONS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("open_question_rows", f"""WITH m AS (SELECT count(*) FILTER (WHERE confidence < 0.6 OR in_cycle OR coupling >= 6 OR folders > 10) AS weak FROM ({B.duck(MODULES)}) x), c AS (SELECT count(*) FILTER (WHERE component_type = 'Unknown') AS types, count(*) FILTER (WHERE module = 'Unknown') AS modules FROM ({COMP}) x),
  f AS (SELECT count(*) FILTER (WHERE status = 'partial') AS partial FROM ({ORACLES['flow_status']}) x), e AS (SELECT count(*) FILTER (WHERE type = 'HTTP_API') AS apis, count(*) FILTER (WHERE type = 'FrontendRoute') AS routes FROM ({B.duck(ENTRIES)}) x)
  SELECT 1 AS number, {quote(QUESTIONS[0])} AS question UNION ALL SELECT 2, concat('Confirm ownership and boundaries for ', weak, ' weak or unknown module candidates.') FROM m UNION ALL SELECT 3, concat('Review the ', modules, ' components with unknown module ownership before finalizing module boundaries.') FROM c
  UNION ALL SELECT 4, concat('Review the ', types, ' components with Unknown type/layer classification to decide whether they are architecture-significant.') FROM c UNION ALL SELECT 5, concat('Review ', partial, ' partial call flows before using them as behavior-preservation contracts.') FROM f
  UNION ALL SELECT 6, concat('Confirm controller and route coverage for convention-based framework routes, because extraction found ', apis, ' HTTP APIs, ', routes, ' frontend routes.') FROM e UNION ALL SELECT 7, {quote(QUESTIONS[1])}""")
def open_question_rows(spark, sf_dir):
    """Questions with the counts that raise them, in a fixed order."""
    weak = F.expr(case_sql(C.BOUNDARY_RULES, "'Medium'")).isin("Weak", "Unknown")
    one = lambda rows, **counts: rows.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items())).withColumn("one", F.lit(1))
    a = one(B.source(spark, sf_dir, MODULES), weak=weak).join(one(B.source(spark, sf_dir, B.COMPONENTS), types=F.col("component_type") == "Unknown", modules=F.col("module") == "Unknown"), "one")
    flows = one(B.source(spark, sf_dir, FLOWS).withColumn("status", F.expr(case_sql(C.FLOW_STATUS, "'traced_from_dependency_candidates'"))), partial=F.col("status") == "partial")
    a = a.join(flows, "one").join(one(B.source(spark, sf_dir, ENTRIES), apis=F.col("type") == "HTTP_API", routes=F.col("type") == "FrontendRoute"), "one")
    asked = [
        F.lit(QUESTIONS[0]), F.format_string("Confirm ownership and boundaries for %d weak or unknown module candidates.", "weak"), F.format_string("Review the %d components with unknown module ownership before finalizing module boundaries.", "modules"),
        F.format_string("Review the %d components with Unknown type/layer classification to decide whether they are architecture-significant.", "types"), F.format_string("Review %d partial call flows before using them as behavior-preservation contracts.", "partial"),
        F.format_string("Confirm controller and route coverage for convention-based framework routes, because extraction found %d HTTP APIs, %d frontend routes.", "apis", "routes"), F.lit(QUESTIONS[1]),
    ]
    return a.select(F.inline(F.array(*(F.struct(F.lit(k).alias("number"), text.alias("question")) for k, text in enumerate(asked, 1)))))


# What a decision input asks and advises, and the sentence on retirement.
BOUNDARY_ASKED = "Should `{}` be a separate future module/service boundary, remain internal, or merge with another capability?"
BOUNDARY_REVIEW = "confirm ownership, public interfaces, data ownership, and call flows before extraction."
QUESTION_EVIDENCE = "`open-questions.md` and related final JSON artifacts."
QUESTION_REVIEW = "assign to architecture/product/application owner and record preserve/redesign/review decision."
NOTHING_RETIRED = "No component or API is marked for retirement from static architecture evidence alone. Retirement requires usage, telemetry, production logs, or explicit product-owner confirmation."


@register("decision_inputs", f"""WITH k AS ({HAND_CAPS}), o AS ({{questions}}), i AS (
  (SELECT 1 AS g, row_number() OVER (ORDER BY seq) AS p, concat('Confirm `', name, '` Boundary') AS title, replace({quote(BOUNDARY_ASKED)}, '{{}}', name) AS asked, concat('capability ', seq, '; risks ', risk_count, ', weak modules ', weak_modules, ', coupling ', efferent) AS evidence, {quote(BOUNDARY_REVIEW)} AS review FROM k WHERE decision = 'review_before_extraction' ORDER BY seq LIMIT 8)
  UNION ALL (SELECT 2, number, 'Resolve Open Question', question, {quote(QUESTION_EVIDENCE)}, {quote(QUESTION_REVIEW)} FROM o ORDER BY number LIMIT 10))
  SELECT concat('ADR-INPUT-', lpad(cast(row_number() OVER (ORDER BY g, p) AS VARCHAR), 3, '0')) AS input_id, title, asked, evidence, review FROM i""".replace("{questions}", ORACLES["open_question_rows"]).replace("{{}}", "{}"))
def decision_inputs(spark, sf_dir):
    """What architects must decide: the first eight boundaries to review, then the first ten open questions; at most 18 rows."""
    caps = first(capabilities(spark, sf_dir).where("decision = 'review_before_extraction'"), 8, "seq")
    evidence = F.format_string("capability %d; risks %d, weak modules %d, coupling %d", "seq", "risk_count", "weak_modules", "efferent")
    before, after = BOUNDARY_ASKED.split("{}")
    bounds = caps.select(F.lit(1).alias("g"), F.col("place").alias("p"), F.concat(F.lit("Confirm `"), "name", F.lit("` Boundary")).alias("title"), F.concat(F.lit(before), "name", F.lit(after)).alias("asked"), evidence.alias("evidence"), F.lit(BOUNDARY_REVIEW).alias("review"))
    asked = open_question_rows(spark, sf_dir).where("number <= 10").select(F.lit(2).alias("g"), F.col("number").alias("p"), F.lit("Resolve Open Question").alias("title"), F.col("question").alias("asked"), F.lit(QUESTION_EVIDENCE).alias("evidence"), F.lit(QUESTION_REVIEW).alias("review"))
    number = F.row_number().over(Window.orderBy("g", "p"))  # 18 rows at most
    return bounds.unionByName(asked).select(F.format_string("ADR-INPUT-%03d", number).alias("input_id"), "title", "asked", "evidence", "review")


@register("preserve_redesign_retire", f"""WITH k AS ({HAND_CAPS}), t AS ({HAND_CONTRACTS}), r AS ({ORACLES['risk_register']}), v AS ({ORACLES['violations']})
  (SELECT 'preserve' AS section, row_number() OVER (ORDER BY seq) AS place, name AS item FROM t WHERE decision = 'preserve' ORDER BY seq LIMIT 15) UNION ALL (SELECT 'redesign_risk', row_number() OVER (ORDER BY risk_id), concat(risk_id, ': ', category, ' ', subject) FROM r ORDER BY risk_id LIMIT 10)
  UNION ALL (SELECT 'redesign_violation', row_number() OVER (ORDER BY violation_id), concat(violation_id, ': ', type, ' ', subject) FROM v ORDER BY violation_id LIMIT 10) UNION ALL (SELECT 'review', row_number() OVER (ORDER BY seq), name FROM t WHERE decision = 'review' ORDER BY seq LIMIT 15)
  UNION ALL (SELECT 'review_capability', row_number() OVER (ORDER BY seq), concat(name, ': risks ', risk_count, ', weak modules ', weak_modules) FROM k WHERE decision = 'review_before_extraction' ORDER BY seq LIMIT 12) UNION ALL SELECT 'retire', 1, {quote(NOTHING_RETIRED)}""")
def preserve_redesign_retire(spark, sf_dir):
    """Contracts to preserve (15), risks and violations not to carry forward (10 each), contracts (15) and capabilities (12) to review, and what may be retired: nothing, on this evidence."""
    told, caps = contracts(spark, sf_dir), capabilities(spark, sf_dir).where("decision = 'review_before_extraction'")
    part = lambda section, rows, k, order, item: first(rows, k, order).select(F.lit(section).alias("section"), "place", item.alias("item"))
    parts = [
        part("preserve", told.where("decision = 'preserve'"), 15, "seq", F.col("name")), part("redesign_risk", risk_register(spark, sf_dir), 10, "risk_id", F.concat("risk_id", F.lit(": "), "category", F.lit(" "), "subject")),
        part("redesign_violation", violations(spark, sf_dir), 10, "violation_id", F.concat("violation_id", F.lit(": "), "type", F.lit(" "), "subject")), part("review", told.where("decision = 'review'"), 15, "seq", F.col("name")),
        part("review_capability", caps, 12, "seq", F.format_string("%s: risks %d, weak modules %d", "name", "risk_count", "weak_modules")), spark.range(1).select(F.lit("retire").alias("section"), F.lit(1).alias("place"), F.lit(NOTHING_RETIRED).alias("item")),
    ]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


@register("data_ownership", f"""WITH c AS ({COMP}), n AS (SELECT project, count(*) AS n FROM c GROUP BY project), o AS (SELECT module, project, row_number() OVER (PARTITION BY module ORDER BY n, project DESC) AS k FROM (SELECT DISTINCT module, project FROM c) m JOIN n USING (project)), w AS (SELECT module, project AS capability FROM o WHERE k = 1)
  SELECT 'entity' AS section, seq, name, component_type AS type, layer, module, capability, file, NULL AS note FROM c JOIN w USING (module) WHERE component_type = 'Entity'
  UNION ALL SELECT 'data_access', seq, name, component_type, layer, module, capability, file, CASE WHEN component_type = 'Repository' OR layer = 'DataAccess' THEN 'review shared ownership' ELSE 'review' END FROM c JOIN w USING (module) WHERE component_type = 'Repository' OR layer IN ('DataAccess', 'Infrastructure')""")
def data_ownership(spark, sf_dir):
    """Every entity, and every repository or component of a data layer, with the capability of its module: the last in the capabilities' order that holds the module."""
    c = B.source(spark, sf_dir, B.COMPONENTS)
    sizes = c.groupBy("project").agg(F.count("*").alias("n"))
    held = c.select("module", "project").distinct().join(sizes, "project").groupBy("module").agg(F.min(F.struct("n", "project")).alias("least"), F.collect_set(F.struct("n", "project")).alias("every"))
    last = F.array_max(F.transform(F.filter("every", lambda x: x["n"] == F.col("least.n")), lambda x: x["project"]))
    owned = c.join(held.select("module", last.alias("capability")), "module")
    shown = lambda section, rows, note: rows.select(F.lit(section).alias("section"), "seq", "name", F.col("component_type").alias("type"), "layer", "module", "capability", "file", note.alias("note"))
    is_data = (F.col("component_type") == "Repository") | F.col("layer").isin("DataAccess", "Infrastructure")
    shared = F.when((F.col("component_type") == "Repository") | (F.col("layer") == "DataAccess"), "review shared ownership").otherwise("review")
    return shown("entity", owned.where("component_type = 'Entity'"), F.lit(None).cast("string")).unionByName(shown("data_access", owned.where(is_data), shared))


# Stacks in their published order: (name, evidence, how it is parsed, condition over counts).
STACKS = [
    (".NET / C#", "language-summary:csharp", "compiler/AST-backed parser when available; otherwise C# source structural parser; project XML parsed structurally", "csharp > 0"),
    ("ASP.NET Core", "Microsoft.NET.Sdk.Web", "ASP.NET route/DI/framework-call extraction", "web_projects > 0"),
    ("MinimalApi.Endpoint", "PackageReference:MinimalApi.Endpoint", "IEndpoint/AddRoute and app.Map* extraction", "minimal_packages > 0"),
    ("Ardalis.ApiEndpoints", "PackageReference:Ardalis.ApiEndpoints", "EndpointBaseAsync + HTTP attribute extraction", "endpoint_packages > 0"),
    ("Entity Framework Core", "PackageReference:Microsoft.EntityFrameworkCore.*", "DbContext, IEntityTypeConfiguration, AddDbContext, repository usage extraction", "orm_packages > 0"),
    ("Razor / Blazor", "language-summary:razor", "@page/@inject/@inherits directive extraction", "razor > 0"),
    ("MediatR", "PackageReference:MediatR", "IRequest/IRequestHandler and IMediator.Send call extraction", "mediator_packages > 0"),
]


@register("stack_detection", f"""WITH f AS (SELECT lower(suffix) AS s FROM ({FILE}) t), k AS (SELECT package FROM ({B.duck(PACKAGES)}) t), p AS (SELECT project_type FROM ({ORACLES['project_type']}) t), s AS (
  SELECT 1 AS place, '.NET / C#' AS stack, EXISTS (FROM f WHERE s = '.cs') AS found UNION ALL SELECT 2, 'ASP.NET Core', EXISTS (FROM p WHERE project_type LIKE 'backend_web%') UNION ALL SELECT 3, 'MinimalApi.Endpoint', EXISTS (FROM k WHERE package = 'MinimalApi.Endpoint')
  UNION ALL SELECT 4, 'Ardalis.ApiEndpoints', EXISTS (FROM k WHERE package = 'Ardalis.ApiEndpoints') UNION ALL SELECT 5, 'Entity Framework Core', EXISTS (FROM k WHERE contains(package, 'EntityFrameworkCore')) UNION ALL SELECT 6, 'Razor / Blazor', EXISTS (FROM f WHERE s IN ('.razor', '.cshtml'))
  UNION ALL SELECT 7, 'MediatR', EXISTS (FROM k WHERE package = 'MediatR')) SELECT place, stack, ['language-summary:csharp', 'Microsoft.NET.Sdk.Web', 'PackageReference:MinimalApi.Endpoint', 'PackageReference:Ardalis.ApiEndpoints', 'PackageReference:Microsoft.EntityFrameworkCore.*', 'language-summary:razor', 'PackageReference:MediatR'][place] AS detected_from FROM s WHERE found""")
def stack_detection(spark, sf_dir):
    """Stacks by languages of files, types of projects and package references."""
    one = lambda rows, **counts: rows.agg(*(F.count_if(F.expr(c)).alias(n) for n, c in counts.items())).withColumn("one", F.lit(1))
    files = one(B.source(spark, sf_dir, B.FILES).withColumn("language", F.expr(C.INVENTORY_LANGUAGE)), csharp="language = 'csharp'", razor="language = 'razor'")
    projects = one(B.source(spark, sf_dir, PROJECTS).withColumn("type", F.expr(case_sql(C.PROJECT_RULES, "'library'"))), web_projects="type IN ('backend_web_api', 'backend_web_app')")
    packages = one(B.source(spark, sf_dir, PACKAGES), minimal_packages="package = 'MinimalApi.Endpoint'", endpoint_packages="package = 'Ardalis.ApiEndpoints'", orm_packages="contains(package, 'EntityFrameworkCore')", mediator_packages="package = 'MediatR'")
    rows = F.array(*(F.when(F.expr(w), F.struct(F.lit(k).alias("place"), F.lit(n).alias("stack"), F.lit(e).alias("detected_from"))) for k, (n, e, _, w) in enumerate(STACKS, 1)))
    return files.join(projects, "one").join(packages, "one").select(F.inline(F.array_compact(rows)))


#: Flows with the module that they touch.
TOUCHED = f"SELECT *, CASE seq % 5 WHEN 0 THEN 'Catalog' WHEN 1 THEN 'Identity' WHEN 2 THEN 'Admin' WHEN 3 THEN 'Basket' ELSE 'Shipping' END AS touched FROM ({ENTRIES}) t"
# Scenarios, the name shown where no flow fits, and what fits.
SCENARIOS = [
    ("READ_PATH", "Read/browse flow", "type = 'HTTP_API' AND method = 'GET' AND touched IN ('Catalog', 'Basket', 'Order')"),
    ("WRITE_PATH", "Write/mutation flow", "type = 'HTTP_API' AND method IN ('POST', 'PUT', 'DELETE') AND NOT contains(lower(path), 'authenticate')"),
    ("AUTH_PATH", "Authentication/identity flow", "contains(lower(path), 'auth') OR touched = 'Identity'"),
    ("ADMIN_PATH", "Admin/privileged flow", "contains(lower(path), 'admin') OR touched = 'Admin'"),
    ("ERROR_OR_RESILIENCE_PATH", "Reliability/health-check flow", "contains(lower(path), 'health')"),
]


@register("scenario_pick", f"""WITH t AS (SELECT *, seq % 5 AS r FROM ({B.duck(ENTRIES)}) t), p AS (SELECT 1 AS n, 'READ_PATH' AS scenario, (SELECT min(seq) FROM t WHERE type = 'HTTP_API' AND method = 'GET' AND r IN (0, 3)) AS seq
  UNION ALL SELECT 2, 'WRITE_PATH', (SELECT min(seq) FROM t WHERE type = 'HTTP_API' AND method = 'POST') UNION ALL SELECT 3, 'AUTH_PATH', (SELECT min(seq) FROM t WHERE path ILIKE '%auth%' OR r = 1) UNION ALL SELECT 4, 'ADMIN_PATH', (SELECT min(seq) FROM t WHERE path ILIKE '%admin%' OR r = 2)
  UNION ALL SELECT 5, 'ERROR_OR_RESILIENCE_PATH', (SELECT min(seq) FROM t WHERE path ILIKE '%health%'))
  SELECT concat('SC-', scenario) AS scenario_id, coalesce(concat(t.method, ' ', t.path), ['Read/browse flow', 'Write/mutation flow', 'Authentication/identity flow', 'Admin/privileged flow', 'Reliability/health-check flow'][n]) AS name, p.seq AS flow, coalesce(t.confidence, 0) AS confidence
  FROM p LEFT JOIN (SELECT seq, min(method) AS method, min(path) AS path, min(confidence) AS confidence FROM t GROUP BY seq) t ON t.seq = p.seq""")
def scenario_pick(spark, sf_dir):
    """The first flow (by seq) that fits each scenario, or a placeholder; one aggregate over all flows."""
    flow = F.struct("seq", F.concat("method", F.lit(" "), "path").alias("name"), "confidence")
    found = B.source(spark, sf_dir, TOUCHED).agg(*(F.min(F.when(F.expr(w), flow)).alias(n) for n, _, w in SCENARIOS))
    rows = (F.struct(F.lit(f"SC-{n}").alias("scenario_id"), F.coalesce(F.col(n)["name"], F.lit(shown)).alias("name"), F.col(n)["seq"].alias("flow"), F.coalesce(F.col(n)["confidence"], F.lit(0.0)).alias("confidence")) for n, shown, _ in SCENARIOS)
    return found.select(F.inline(F.array(*rows)))


#: Services of compose files, and packages that tell of a cloud service.
SERVICES = "SELECT p_partkey AS seq, CASE p_partkey % 9 WHEN 0 THEN 'SqlServer' WHEN 1 THEN 'redis' WHEN 2 THEN 'web' WHEN 3 THEN 'postgres' WHEN 4 THEN 'mysql-admin' ELSE lower(p_brand) END AS name FROM <<part>>"
CLOUD = "SELECT p_partkey AS seq, CASE p_partkey % 50 WHEN 0 THEN 'Azure.Identity' WHEN 1 THEN 'Azure.Extensions.AspNetCore.Configuration.Secrets' ELSE p_brand END AS package FROM <<part>>"
# Services that are infrastructure, packages of one cloud service.
INFRASTRUCTURE = "sqlserver postgres mysql redis".split()
CLOUD_PACKAGES = ["Azure.Identity", "Azure.Extensions.AspNetCore.Configuration.Secrets"]


@register("external_boundaries", f"""SELECT DISTINCT 'database_or_infrastructure_service' AS type, name AS target_system, 0.82::DOUBLE AS confidence FROM ({B.duck(SERVICES)}) s WHERE lower(name) = 'sqlserver' OR lower(name) = 'postgres' OR lower(name) = 'mysql' OR lower(name) = 'redis'
  UNION ALL SELECT 'HTTP_endpoint_or_configured_base_url', dst, max(confidence) FROM ({EDGE}) e WHERE kind = 'http_client_call' GROUP BY dst UNION ALL SELECT DISTINCT 'possible_external_cloud_dependency', 'Azure configuration/identity service', 0.55::DOUBLE FROM ({B.duck(CLOUD)}) c WHERE package LIKE 'Azure.%'""")
def external_boundaries(spark, sf_dir):
    """Infrastructure services, targets of HTTP calls with their best confidence, and a cloud service if a package tells of it."""
    services = B.source(spark, sf_dir, SERVICES).where(F.lower("name").isin(INFRASTRUCTURE)).select(F.lit("database_or_infrastructure_service").alias("type"), F.col("name").alias("target_system"), F.lit(0.82).alias("confidence")).distinct()
    http = B.source(spark, sf_dir, B.EDGES).where("kind = 'http_client_call'").groupBy(F.col("dst").alias("target_system")).agg(F.max("confidence").alias("confidence")).select(F.lit("HTTP_endpoint_or_configured_base_url").alias("type"), "target_system", "confidence")
    cloud = B.source(spark, sf_dir, CLOUD).where(F.col("package").isin(CLOUD_PACKAGES)).select(F.lit("possible_external_cloud_dependency").alias("type"), F.lit("Azure configuration/identity service").alias("target_system"), F.lit(0.55).alias("confidence")).distinct()
    return services.unionByName(http).unionByName(cloud)


WORKERS = f"SELECT name, file, CASE seq % 11 WHEN 0 THEN 'ScheduledJob' WHEN 1 THEN 'MessageConsumer' WHEN 2 THEN 'BatchJob' ELSE component_type END AS component_type FROM ({B.COMPONENTS}) c"
# Groups of the inventory by project category.
GROUPS = {"backend": "backend_projects", "frontend": "frontend_projects", "support": "supporting_projects", "database_support": "database_support_projects", "test": "test_projects"}


@register("system_inventory", f"""SELECT DISTINCT CASE category WHEN 'test' THEN 'test_projects' WHEN 'backend' THEN 'backend_projects' WHEN 'frontend' THEN 'frontend_projects' WHEN 'database_support' THEN 'database_support_projects' ELSE 'supporting_projects' END AS section, lower_name AS name, lower_path AS path
  FROM ({ORACLES['project_type']}) o JOIN (SELECT seq, lower_path FROM ({B.duck(PROJECTS)}) x) p USING (seq) UNION SELECT DISTINCT 'deployable_units', lower_name, lower_path FROM ({ORACLES['project_type']}) o JOIN (SELECT seq, lower_path FROM ({B.duck(PROJECTS)}) x) p USING (seq) WHERE project_type LIKE 'backend_web%'
  UNION SELECT DISTINCT 'workers_or_jobs', name, file FROM ({COMP}) c WHERE seq % 11 < 3""")
def system_inventory(spark, sf_dir):
    """Projects by group, deployable units, and workers or jobs; each (section, name, path) once."""
    kind = F.expr(case_sql(C.PROJECT_RULES, "'library'"))
    group = F.create_map(*(F.lit(x) for k, c in C.PROJECT_CATEGORY.items() for x in (k, GROUPS[c])))
    projects = B.source(spark, sf_dir, PROJECTS).select(kind.alias("type"), F.col("lower_name").alias("name"), F.col("lower_path").alias("path"))
    grouped = projects.select(group[F.col("type")].alias("section"), "name", "path")
    deployable = projects.where("type IN ('backend_web_api', 'backend_web_app')").select(F.lit("deployable_units").alias("section"), "name", "path")
    workers = B.source(spark, sf_dir, WORKERS).where("component_type IN ('ScheduledJob', 'MessageConsumer', 'BatchJob')").select(F.lit("workers_or_jobs").alias("section"), "name", F.col("file").alias("path"))
    return grouped.unionByName(deployable).unionByName(workers).distinct()


CONTEXT_SUFFIXES, CONTEXT_CHARS, CONTEXT_FILES = [".json", ".md", ".mmd"], 3500, 40


@register("artifact_context", f"SELECT path, seq, concat(substring(text, 1, 3500), CASE WHEN length(text) > 3500 THEN chr(10) || '... [truncated]' ELSE '' END) AS body FROM ({B.duck(BODIES)}) f WHERE (path LIKE '%.json' OR path LIKE '%.md' OR path LIKE '%.mmd') AND text IS NOT NULL ORDER BY path, seq LIMIT 40")
def artifact_context(spark, sf_dir):
    """The first 40 artifacts by path, at most 3,500 characters of each: the collector's own limits."""
    rows = B.source(spark, sf_dir, BODIES).where(F.lower("suffix").isin(CONTEXT_SUFFIXES) & F.col("text").isNotNull()).orderBy("path", "seq").limit(CONTEXT_FILES)
    more = F.when(F.length("text") > CONTEXT_CHARS, "\n... [truncated]").otherwise("")
    return rows.select("path", "seq", F.concat(F.substring("text", 1, CONTEXT_CHARS), more).alias("body"))
