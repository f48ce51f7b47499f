"""Quality review, sanity checks and gates: one row of counts, and rules over it.

Every check of the published review has its row. A check that rests on counts is PASS, or PARTIAL or FAIL as stated;
one that the published review states as a constant, or that no table here can answer, is NOT_CHECKED.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.rules import quote
from lodestrata.operators import classify as C
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import register
from lodestrata.functions.rules import case_sql
from lodestrata.plans.classification import CLASSED, FLOWS, MODULES
from lodestrata.plans.rollups import VIOLATIONS_SQL, violating_edges

COMP, EDGE, FLOW = B.duck(B.COMPONENTS), B.duck(B.EDGES), B.duck(FLOWS)
HIGH = 8
MAJOR = "component_type = 'Unknown' AND NOT is_test"
STRATEGY = "CASE WHEN marker THEN 'unknown' ELSE lower(type) END"

#: Counts over components, edges and flows: name -> aggregate, alike in both engines.
COMPONENT_COUNTS = {
    "components": "true", "major_unknown": MAJOR, "support_unknown": "component_type = 'Unknown' AND is_test", "unknown": "component_type = 'Unknown'", "unknown_module": "module = 'Unknown'", "repositories": "component_type = 'Repository'",
    "frontend_components": "component_type = 'FrontendComponent'", "frontend_services": "component_type = 'FrontendService'", "missing_file": "file IS NULL",
}
EDGE_COUNTS = {"edges": "true", "missing_from": "src IS NULL", "missing_to": "dst IS NULL"}
FLOW_COUNTS = {
    "flows": "true", "http_apis": "type = 'HTTP_API'", "frontend_routes": "type = 'FrontendRoute'", "cli_entries": "type = 'CLI'", "interfaces_missing_source": "source_file IS NULL", "strategies": f"{STRATEGY} <> 'unknown'", "partial_flows": C.FLOW_PARTIAL,
    "downstream_flows": "steps > 1", "data_flows": "data_access", "jobs": "type = 'Job'",
}

READINESS = case_sql(C.READINESS_RULES, "'Needs Refactoring'")
MODULE_COUNTS = {"module_candidates": "true", "module_cycles": "in_cycle", "coupled_modules": "coupling >= 6", "candidates": f"({READINESS}) = 'Ready'", "blocked_modules": f"({READINESS}) = 'Blocked'"}
DECISION = case_sql(C.CAPABILITY_DECISION, "'review'")
CAPABILITY_COUNTS = {"early": f"({DECISION}) = 'candidate_for_early_modernization'", "to_review": f"({DECISION}) = 'review_before_extraction'"}

METRICS = f"""mo AS (SELECT * FROM ({B.duck(MODULES)}) t), ca AS (SELECT * FROM ({B.duck(CLASSED)}) t), lv AS (WITH {VIOLATIONS_SQL} SELECT count(*) AS n FROM g1), c AS (SELECT * FROM ({COMP}) t), e AS (SELECT * FROM ({EDGE}) t), f AS (SELECT * FROM ({FLOW}) t), hot AS (SELECT src FROM e GROUP BY src HAVING count(DISTINCT dst) >= {HIGH}),
  q AS (SELECT {', '.join(f'(SELECT count(*) FROM c WHERE {w}) AS {n}' for n, w in COMPONENT_COUNTS.items())}, {', '.join(f'(SELECT count(*) FROM e WHERE {w}) AS {n}' for n, w in EDGE_COUNTS.items())}, {', '.join(f'(SELECT count(*) FROM f WHERE {w}) AS {n}' for n, w in FLOW_COUNTS.items())}, {', '.join(f'(SELECT count(*) FROM mo WHERE {w}) AS {n}' for n, w in MODULE_COUNTS.items())}, {', '.join(f'(SELECT count(*) FROM ca WHERE {w}) AS {n}' for n, w in CAPABILITY_COUNTS.items())},
    (SELECT n FROM lv) AS layer_violations, (SELECT count(DISTINCT layer) FROM c) AS known_layers, (SELECT count(DISTINCT project) FROM c) AS deployables, (SELECT count(DISTINCT module) FROM c WHERE module <> 'Unknown') AS modules, (SELECT count(*) FROM (SELECT module FROM c GROUP BY module HAVING count(file) = 0) m) AS modules_without_source,
    (SELECT cast(sum(steps) AS BIGINT) FROM f) AS steps, (SELECT count(*) FROM f WHERE owner NOT IN (SELECT name FROM c)) AS missing_steps, (SELECT count(*) FROM hot) AS risks, (SELECT count(*) FROM hot WHERE src NOT IN (SELECT name FROM c)) AS risks_without_component,
    (SELECT count(DISTINCT src) FROM hot JOIN c ON c.name = hot.src WHERE c.module = 'Unknown') AS risks_without_module, (SELECT count(*) FROM e WHERE dst NOT IN (SELECT name FROM c)) AS dangling, (SELECT string_agg(concat(layer, '=', n), ', ' ORDER BY layer) FROM (SELECT layer, count(*) AS n FROM c GROUP BY layer) x) AS layers)"""


def metrics(spark, sf_dir) -> DataFrame:
    """One row of counts that checks and gates read: one aggregate over each table, and anti-joins."""
    c, e, f = B.source(spark, sf_dir, B.COMPONENTS), B.source(spark, sf_dir, B.EDGES), B.source(spark, sf_dir, FLOWS)
    counted = lambda rows, counts, *more: rows.agg(*(F.count_if(F.coalesce(F.expr(w), F.lit(False))).alias(n) for n, w in counts.items()), *more)
    names = c.select("name").distinct()
    hot = e.groupBy("src").agg(F.count_distinct("dst").alias("n")).where(F.col("n") >= HIGH).select(F.col("src").alias("name"))
    lost = lambda rows, column, name: rows.select(F.col(column).alias("name")).join(names, "name", "left_anti").agg(F.count("*").alias(name))
    shown = F.array_join(F.array_sort(F.collect_list(F.concat("layer", F.lit("="), F.col("n").cast("string")))), ", ")
    rows = [
        counted(B.source(spark, sf_dir, MODULES), MODULE_COUNTS), counted(B.source(spark, sf_dir, CLASSED), CAPABILITY_COUNTS), violating_edges(spark, sf_dir).select("src", "dst", "violation").distinct().agg(F.count("*").alias("layer_violations")),
        counted(c, COMPONENT_COUNTS, F.count_distinct("layer").alias("known_layers"), F.count_distinct("project").alias("deployables"), F.count_distinct(F.when(F.col("module") != "Unknown", F.col("module"))).alias("modules")),
        counted(e, EDGE_COUNTS), counted(f, FLOW_COUNTS, F.sum("steps").alias("steps")), lost(f, "owner", "missing_steps"), lost(e, "dst", "dangling"), lost(hot, "name", "risks_without_component"), hot.agg(F.count("*").alias("risks")),
        hot.join(c.where("module = 'Unknown'"), "name").agg(F.count_distinct("name").alias("risks_without_module")), c.groupBy("module").agg(F.count("file").alias("n")).where("n = 0").agg(F.count("*").alias("modules_without_source")),
        c.groupBy("layer").agg(F.count("*").alias("n")).agg(shown.alias("layers")),
    ]
    whole = rows[0].withColumn("one", F.lit(1))
    for row in rows[1:]:  # single rows, joined on a constant
        whole = whole.join(row.withColumn("one", F.lit(1)), "one")
    return whole.drop("one")


def _text(template: str) -> str:
    """A SQL text with the counts that the template names."""
    parts = [quote(p) if k % 2 == 0 else f"cast({p} as varchar(40))" for k, p in enumerate(template.replace("{", "\x00").replace("}", "\x00").split("\x00"))]
    return "concat(" + ", ".join(parts) + ", '')"


NO_FIX, NONE = "No fix needed.", "None."
# The published checks in their order: (check, when it passes, status else, evidence, gap else, action else). Without a condition: (check, None, "", evidence, gap, "").
QUALITY = [
    ("All deployable projects identified", "deployables >= 1", "FAIL", "{deployables} deployable units detected.", "No deployable units found.", "Review system inventory evidence."),
    ("All major source folders represented", "modules_without_source = 0", "PARTIAL", "{modules} modules; {modules_without_source} missing source evidence.", "Some modules lack source folders/evidence.", "Add module source evidence."),
    ("All controllers/routes/API entry points detected if present", "flows > 0 AND interfaces_missing_source = 0 AND strategies > 0", "PARTIAL", "{http_apis} HTTP APIs, {frontend_routes} frontend routes, {cli_entries} CLI/bootstrap entries.", "Route/source/parser evidence is incomplete.", "Improve framework-specific route parsing."),
    ("All major services/components classified", "major_unknown = 0", "PARTIAL", "{components} components; major production Unknown={major_unknown}; verification/support Unknown={support_unknown}; total Unknown type classifications={unknown}; Unknown module ownership cases={unknown_module}.", "Some architecture-significant components remain Unknown and can hide ownership or migration risk.", "Review major Unknown component classifications."),
    ("All repositories/data-access components classified if present", "repositories > 0", "PARTIAL", "{repositories} Repository components detected; high-coupling data-access components captured where evidence exists.", "No repository type detected, although data-access may still exist under other classifications.", NO_FIX),
    ("Frontend apps/components/routes detected if present", "frontend_components > 0 OR frontend_routes > 0", "PARTIAL", "{frontend_components} frontend components, {frontend_services} frontend services, {frontend_routes} frontend routes.", "Frontend evidence is limited.", NO_FIX),
    ("Scheduled jobs/message consumers/batch jobs detected if present", "jobs > 0", "PARTIAL", "{jobs} job entry points detected.", "No static evidence found.", NO_FIX),
    ("Modules have clear responsibilities", "modules > 0 AND modules_without_source = 0 AND unknown_module = 0", "PARTIAL", "{modules} modules have source-backed responsibility candidates; unknown boundary: {unknown_module}.", "Some modules lack enough source-backed responsibility evidence.", "Review low-evidence module responsibility candidates."),
    ("Layers are identified", "known_layers > 0", "PARTIAL", "Detected layers: {layers}", "No layer was found.", NO_FIX),
    ("Architecture pattern has evidence", None, "", "", "", ""),
    ("Layer violations are detected", "edges > 0", "PARTIAL", "Architecture violation register contains {layer_violations} layer findings and the dependency graph was checked for layer/coupling issues.", "No dependency was checked.", NO_FIX),
    ("Circular dependencies are checked", "module_candidates > 0", "PARTIAL", "{module_cycles} modules in cycles detected.", "No module was checked.", NO_FIX),
    ("High-coupling components/modules are flagged", "edges > 0 AND module_candidates > 0", "PARTIAL", "{risks} high-coupling components and {coupled_modules} high-coupling modules flagged.", "No dependency or module was checked.", NO_FIX),
    ("Migration candidates are identified", "candidates > 0", "PARTIAL", "{candidates} modules are ready, {blocked_modules} blocked.", "No module is ready.", NO_FIX),
    ("Every major claim has source file evidence", "missing_file = 0 AND modules_without_source = 0 AND interfaces_missing_source = 0", "PARTIAL", "JSON artifacts carry evidence; summary, pattern, risk, interface, and module outputs include source anchors.", "Some evidence fields/source anchors are missing.", "Backfill missing source evidence."),
    ("Every risk has affected module/component", "risks_without_module = 0 AND risks_without_component = 0", "PARTIAL", "{risks} risks; missing module={risks_without_module}; missing component={risks_without_component}.", "Some risks lack affected fields.", "Populate affected fields or mark unknown."),
    ("Every module has source folders or source evidence", "modules_without_source = 0", "PARTIAL", "{modules_without_source} modules missing source/evidence.", "Some module claims lack source traceability.", NO_FIX),
    ("Every dependency has from/to", "missing_from = 0 AND missing_to = 0", "FAIL", "{edges} edges; missing from={missing_from}; missing to={missing_to}.", "Invalid dependency edge shape.", NO_FIX),
    ("Every call flow has entry point and steps", "missing_steps = 0", "PARTIAL", "{flows} flows and {steps} steps; missing step components={missing_steps}.", "Some flow steps reference components missing from the registry.", "Normalize call-flow step component references."),
    ("Unknowns are listed in open questions", "unknown > 0 OR unknown_module > 0", "FAIL", "{unknown} unknown types and {unknown_module} unknown modules are asked about.", "Unknowns are not documented.", NO_FIX),
    ("Candidate future modules/services are identified", "early > 0", "PARTIAL", "{early} lower-risk capabilities and {to_review} that need review.", "No lower-risk capability was found.", NO_FIX),
    ("Risky modules are identified", "module_candidates > 0", "PARTIAL", "{coupled_modules} high-coupling and {module_cycles} cyclic modules identified.", "No module was checked.", NO_FIX),
    ("Architecture violations are marked not to blindly carry forward", "edges > 0 AND module_candidates > 0", "PARTIAL", "{layer_violations} layer violations and {module_cycles} modules in cycles are not to be carried forward.", "No violation was looked for.", NO_FIX),
    ("Existing APIs/flows are mapped for preserve/redesign decisions", "partial_flows = 0", "PARTIAL", "{flows} interfaces and {flows} flows; partial flows={partial_flows}; flows with downstream steps={downstream_flows}; flows with data access={data_flows}.", "Partial flows limit behavior-preservation completeness.", "Review remaining partial flows before using as behavior contracts."),
    ("Suggested migration order exists", "candidates > 0", "PARTIAL", "{candidates} candidates stand in the suggested order.", "No candidate to order.", NO_FIX),
    ("No generic textbook explanation", None, "", "", "", ""),
    ("No unsupported claims", None, "", "", "", ""),
    ("No invented cloud/platform assumptions", None, "", "", "", ""),
    ("No source code modified", None, "", "", "", ""),
    ("JSON artifacts are valid JSON", None, "", "", "", ""),
    ("Mermaid diagrams are syntactically reasonable", None, "", "", "", ""),
    ("Outputs are specific to this repo", None, "", "", "", ""),
]


def _status(good: str | None, otherwise: str) -> str:
    return "'NOT_CHECKED'" if good is None else f"CASE WHEN {good} THEN 'PASS' ELSE {quote(otherwise)} END"


def _row(number: int, check: str, good: str | None, otherwise: str, evidence: str, gap: str, action: str) -> dict[str, str]:
    """The columns of a check's row as SQL texts over the counts."""
    unless = lambda fine, bad: quote("") if good is None else f"CASE WHEN {good} THEN {quote(fine)} ELSE {quote(bad)} END"
    return {"number": str(number), "check_name": quote(check), "status": _status(good, otherwise), "evidence": _text(evidence), "gap": unless(NONE, gap), "action": unless(NO_FIX, action)}


ROWS = [_row(k, *check) for k, check in enumerate(QUALITY, 1)]
N_FAIL, N_PARTIAL = (" + ".join(f"CASE WHEN {r['status']} = '{s}' THEN 1 ELSE 0 END" for r in ROWS) for s in ("FAIL", "PARTIAL"))
ACCEPTANCE = f"CASE WHEN {N_FAIL} > 0 THEN 'FAIL' WHEN {N_PARTIAL} > 0 THEN 'PASS WITH PARTIALS' ELSE 'PASS' END"


def reviewed(counts: DataFrame) -> DataFrame:
    """The quality review of one row of counts, with its acceptance on every row."""
    rows = F.array(*(F.struct(*(F.expr(sql).alias(n) for n, sql in r.items())) for r in ROWS))
    return counts.select("*", F.expr(ACCEPTANCE).alias("acceptance")).select(F.inline(rows), "acceptance")


@register("quality_rows", f"WITH {METRICS} " + " UNION ALL ".join(f"SELECT {', '.join(f'{sql} AS {n}' for n, sql in r.items())}, {ACCEPTANCE} AS acceptance FROM q" for r in ROWS))
def quality_rows(spark, sf_dir):
    """A check that the data cannot answer is NOT_CHECKED, never a stated PASS."""
    return reviewed(metrics(spark, sf_dir))


# The published sanity checks in their order: (check, when it passes, finding).
SANITY = [
    ("Do module names in `module-boundary-map.json` match `component-registry.json`?", "unknown_module = 0", "{modules} module candidates. Components without a module: {unknown_module}."),
    ("Do dependency-graph nodes match actual components/modules?", "dangling = 0", "Edges whose endpoint is not a graph node: {dangling}."),
    ("Do `call-flow-map.json` steps reference components that exist in `component-registry.json`?", "missing_steps = 0", "{steps} flow steps checked; missing step components: {missing_steps}."),
    ("Do diagrams match the JSON artifacts?", None, ""),
    ("Does `architecture-pattern-report.md` provide evidence from the repo?", None, ""),
    ("Does `executive-summary-for-review.md` avoid unsupported claims?", None, ""),
    ("Are migration candidates justified by coupling and boundary evidence?", "module_candidates > 0", "{candidates} of {module_candidates} module candidates are ready by coupling, cycles and entries."),
    ("Are all limitations clearly stated?", "flows > 0", "Partial flows: {partial_flows}; Unknown module components: {unknown_module}."),
    ("Are there any claims that sound invented or not source-backed?", None, ""),
    ("Is the output usable for SDLC reverse engineering and forward engineering?", None, ""),
]


@register("sanity_checks", f"WITH {METRICS} " + " UNION ALL ".join(f"SELECT {k} AS number, {quote(n)} AS check_name, {_status(g, 'PARTIAL')} AS status, {_text(t)} AS finding FROM q" for k, (n, g, t) in enumerate(SANITY, 1)))
def sanity_checks(spark, sf_dir):
    rows = F.array(*(F.struct(F.lit(k).alias("number"), F.lit(n).alias("check_name"), F.expr(_status(g, "PARTIAL")).alias("status"), F.expr(_text(t)).alias("finding")) for k, (n, g, t) in enumerate(SANITY, 1)))
    return metrics(spark, sf_dir).select(F.inline(rows))


#: Gates: (name, measured value, threshold).
GATES = [("max_fail", "n_fail", 0), ("max_partial", "n_partial", 2), ("max_invalid_graph_edges", "dangling", 0), ("max_unknown_components", "unknown", 50)]


@register("quality_gates", f"WITH {METRICS}, w AS (SELECT *, {N_FAIL} AS n_fail, {N_PARTIAL} AS n_partial FROM q) " + " UNION ALL ".join(f"SELECT {quote(n)} AS gate, cast({v} AS BIGINT) AS measured, cast({t} AS BIGINT) AS threshold, {v} > {t} AS violated FROM w" for n, v, t in GATES))
def quality_gates(spark, sf_dir):
    w = metrics(spark, sf_dir).select("*", F.expr(N_FAIL).alias("n_fail"), F.expr(N_PARTIAL).alias("n_partial"))
    return w.select(F.inline(F.array(*(F.struct(F.lit(n).alias("gate"), F.col(v).cast("long").alias("measured"), F.lit(t).cast("long").alias("threshold"), (F.col(v) > t).alias("violated")) for n, v, t in GATES))))


def enforce_gates(gates: DataFrame, strict: bool) -> bool:
    """Whether the run passes: always in warning mode; in strict mode only without a violated gate."""
    return not strict or gates.where("violated").limit(1).count() == 0
