"""Queries of the classification operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions import fixed
from lodestrata.functions.rules import case_sql, column, lookup_sql, quote
from lodestrata.operators import classify as C
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import register

FILES_D, COMPONENTS_D = B.duck(B.FILES), B.duck(B.COMPONENTS)
LOWER_FOLDER = "lower(folder)"


def _ladder(key: str, statement: str, carried: str, made: dict[str, str], where: str = "", oracle: str | None = None):
    """A query that adds rule columns to bridge rows; ``oracle`` says by hand what they must be (without it, DuckDB reads the same rules)."""
    columns = ", ".join(f"{sql} AS {name}" for name, sql in made.items())

    @register(key, oracle or f"SELECT {carried}, {columns} FROM ({B.duck(statement)}) t {('WHERE ' + where) if where else ''}")
    def plan(spark, sf_dir):
        rows = B.source(spark, sf_dir, statement)
        rows = rows.where(where) if where else rows
        return rows.select(*(c.strip() for c in carried.split(",")), *(F.expr(sql).alias(name) for name, sql in made.items()))

    return plan


_ladder("scan_keep_filter", B.FILES, "seq, path", {"kept": C.KEEP_FILE.replace("lower_folder", LOWER_FOLDER)})
_ladder("inventory_language", B.FILES, "seq, path", {"language": C.INVENTORY_LANGUAGE}, oracle=f"SELECT seq, path, CASE WHEN name = 'Dockerfile' THEN 'dockerfile' ELSE coalesce(map {{'cs': 'csharp', 'razor': 'razor', 'json': 'json', 'csproj': 'msbuild', 'js': 'javascript', 'yml': 'yaml', 'md': 'markdown', 'config': 'xml', 'sln': 'dotnet_solution', 'png': 'image', 'css': 'css', 'txt': 'text'}}[string_split(name, '.')[-1]], 'unknown') END AS language FROM ({FILES_D}) f")
_ladder("inventory_files", B.FILES, "seq, path, size_bytes, line_count", {"language": C.INVENTORY_LANGUAGE, "candidate_type": case_sql(C.CANDIDATE_RULES, "'unknown'"), "ignore_reason": case_sql(C.IGNORE_RULES), "ignored": f"{case_sql(C.IGNORE_RULES)} IS NOT NULL"})
_ladder("candidate_type", B.FILES, "seq, path", {"candidate_type": case_sql(C.CANDIDATE_RULES, "'unknown'")})
_ladder("build_deployment_role", B.FILES, "seq, path", {"role": case_sql(C.ROLE_RULES)})
_ladder("config_format", B.FILES, "seq, path", {"format": case_sql(C.CONFIG_FORMAT_RULES)}, oracle=f"SELECT seq, path, CASE WHEN path LIKE '%.json' THEN 'json' WHEN path LIKE '%.yml' THEN 'yaml' WHEN path LIKE '%.config' THEN 'xml' END AS format FROM ({FILES_D}) f")
_ladder("generated_source_filter", B.FILES, "seq, path", {"generated": C.GENERATED_SOURCE})
_ladder("extractor_files", B.FILES, "seq, path", {"extractor": case_sql([(f"lower(suffix) IN ({', '.join(quote(e) for e in v)})", quote(k)) for k, v in fixed.EXTRACTOR_EXTENSIONS.items()])}, oracle=f"SELECT seq, path, CASE WHEN path LIKE '%.cs' THEN 'dotnet' WHEN path LIKE '%.java' THEN 'java' WHEN path LIKE '%.py' THEN 'python' WHEN path LIKE '%.js' OR path LIKE '%.ts' THEN 'javascript' END AS extractor FROM ({FILES_D}) f")

PROJECTS = f"""SELECT p_partkey AS seq, lower(concat({B.FOLDER}, '/P', {B.KEY}, '.csproj')) AS lower_path, lower(concat('P', {B.KEY}, CASE WHEN p_size % 5 = 0 THEN 'Api' WHEN p_size % 11 = 0 THEN 'Tests' ELSE '' END)) AS lower_name,
  CASE p_size % 3 WHEN 0 THEN 'Microsoft.NET.Sdk.Web' WHEN 1 THEN 'Microsoft.NET.Sdk' ELSE 'Microsoft.NET.Sdk.BlazorWebAssembly' END AS sdk,
  CASE p_size % 4 WHEN 0 THEN 'microsoft.entityframeworkcore.sqlserver' WHEN 1 THEN 'xunit,microsoft.net.test.sdk' WHEN 2 THEN 'minimalapi.endpoint' ELSE '' END AS packages FROM <<part>>"""
_type = case_sql(C.PROJECT_RULES, "'library'")
_ladder("project_type", PROJECTS, "seq, lower_name", {
    "project_type": _type, "category": lookup_sql(_type, C.PROJECT_CATEGORY), "deployable": f"{_type} IN ('backend_web_api', 'backend_web_app')",
    "confidence": case_sql([(f"{_type} = {quote(k)}", f"cast({v} as double)") for k, v in C.PROJECT_CONFIDENCE.items()]),
})

METHODS = """SELECT p_partkey AS seq, concat(CASE p_partkey % 14 WHEN 0 THEN 'ApplyDiscount' WHEN 1 THEN 'cancelOrder' WHEN 2 THEN 'IsValidName' WHEN 3 THEN 'Render' WHEN 4 THEN 'mapToDto' WHEN 5 THEN 'SendEmail' WHEN 6 THEN 'Login'
  WHEN 7 THEN 'GetById' WHEN 8 THEN 'ReviewItem' WHEN 9 THEN 'pushAll' WHEN 10 THEN 'TotalPrice' WHEN 11 THEN 'Seed' WHEN 12 THEN 'Paint' ELSE 'exportRows' END, cast(p_size as varchar(20))) AS name FROM <<part>>"""
_ladder("business_category", METHODS, "seq, name", {"category": case_sql(C.CATEGORY_RULES, "'general'")}, oracle=f"SELECT seq, name, ['calculation', 'validation', 'validation', 'general', 'transformation', 'notification', 'authentication', 'data_operation', 'approval', 'integration', 'calculation', 'process', 'general', 'integration'][1 + seq % 14] AS category FROM ({B.duck(METHODS)}) m")


@register("business_method_flag", f"SELECT seq, name, seq % 14 IN (0, 1, 5, 6, 10, 11, 13) AS is_business FROM ({B.duck(METHODS)}) m")
def business_method_flag(spark, sf_dir):
    return B.source(spark, sf_dir, METHODS).select("seq", "name", C.is_business_method(F.col("name")).alias("is_business"))


PARAMS = """SELECT p_partkey AS seq, CASE p_partkey % 10 WHEN 0 THEN 'Max.Page-Size' WHEN 1 THEN 'ConnectionStrings.Main' WHEN 2 THEN 'feature_x.enabled' WHEN 3 THEN 'user.role' WHEN 4 THEN 'title' WHEN 5 THEN 'db.pass_word' WHEN 6 THEN 'API-KEY'
  WHEN 7 THEN 'monkey' WHEN 8 THEN 'retry.count' ELSE 'data.source' END AS key, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_name END AS value FROM <<part>>"""
_ladder("redact_values", PARAMS, "seq, key", {"value": C.REDACT}, oracle=f"SELECT seq, key, CASE WHEN seq % 10 IN (1, 5, 6, 7) THEN '***REDACTED***' ELSE coalesce(value, '') END AS value FROM ({B.duck(PARAMS)}) p")


@register(
    "config_labels",
    " UNION ALL ".join(f"SELECT seq, key, {quote(label)} AS label FROM ({B.duck(PARAMS)}) t WHERE {condition}" for label, condition in C.LABEL_RULES),
)
def config_labels(spark, sf_dir):
    labels = F.array_compact(F.array(*(F.when(F.expr(condition), label) for label, condition in C.LABEL_RULES)))
    return B.source(spark, sf_dir, PARAMS).select("seq", "key", F.explode(labels).alias("label"))


RICH = f"""SELECT p_partkey AS seq, concat('W', {B.KEY}, CASE p_partkey % 26 WHEN 0 THEN 'Controller' WHEN 1 THEN 'Service' WHEN 2 THEN 'Repository' WHEN 3 THEN 'Settings' WHEN 4 THEN 'Exception' WHEN 5 THEN 'Specification' WHEN 6 THEN 'Seed'
  WHEN 7 THEN 'HealthCheck' WHEN 8 THEN 'Helper' WHEN 9 THEN 'Attribute' WHEN 10 THEN 'Adapter' WHEN 11 THEN 'Handler' WHEN 12 THEN 'Middleware' WHEN 13 THEN 'Validator' WHEN 14 THEN 'Dto' WHEN 15 THEN 'Job' WHEN 16 THEN 'Consumer' WHEN 17 THEN 'Gateway'
  WHEN 18 THEN 'Client' WHEN 19 THEN 'Endpoint' WHEN 20 THEN 'Configuration' WHEN 21 THEN 'Profile' WHEN 22 THEN 'Item' WHEN 23 THEN 'Model' WHEN 24 THEN 'DbContext' ELSE 'Thing' END) AS name,
  CASE WHEN p_partkey % 31 = 0 THEN 'interface' ELSE 'class' END AS kind, concat({B.FOLDER}, '/W', {B.KEY}, '.cs') AS file,
  CASE p_size % 9 WHEN 0 THEN 'BaseEntity' WHEN 1 THEN 'ComponentBase' WHEN 2 THEN 'IRequest<int>' WHEN 3 THEN 'PageModel' WHEN 4 THEN 'BackgroundService' ELSE '' END AS bases,
  CASE WHEN p_size % 13 = 0 THEN 'ApiController' ELSE '' END AS annotations, CASE WHEN p_size % 6 = 0 THEN 'HttpClient' ELSE '' END AS dep_types, CASE WHEN p_size % 10 = 0 THEN 'frontend' ELSE 'backend' END AS category FROM <<part>>"""


@register("component_classify", f"SELECT seq, name, {', '.join(f'{sql} AS {name}' for name, sql in C.component_sql().items())} FROM ({B.duck(RICH)}) t")
def component_classify(spark, sf_dir):
    return C.classify_components(B.source(spark, sf_dir, RICH)).select("seq", "name", "component_type", "layer", "confidence", "evidence", "uncertainty")


_ladder("significance", B.COMPONENTS, "seq, name, file", {"significance": case_sql(C.SIGNIFICANCE_RULES, "'UnclassifiedCandidate'")})

TYPES = """SELECT p_partkey AS seq, CASE p_partkey % 9 WHEN 0 THEN 'int' WHEN 1 THEN 'IOrderService' WHEN 2 THEN 'OrderDto' WHEN 3 THEN 'HttpClient' WHEN 4 THEN 'II' WHEN 5 THEN 'Widget' WHEN 6 THEN 'AppDbContext' WHEN 7 THEN 'LoginResult' ELSE 'IList' END AS simple_type FROM <<part>>"""
_ladder("dependency_type_filter", TYPES, "seq, simple_type", {"is_primitive": C.PRIMITIVE, "is_dto": C.DTO_LIKE, "is_dependency": C.ARCHITECTURE_DEPENDENCY}, oracle="SELECT p_partkey AS seq, t[1 + p_partkey % 9] AS simple_type, p_partkey % 9 = 0 AS is_primitive, p_partkey % 9 IN (2, 7) AS is_dto, p_partkey % 9 IN (1, 3, 6, 8) AS is_dependency FROM part, (SELECT ['int', 'IOrderService', 'OrderDto', 'HttpClient', 'II', 'Widget', 'AppDbContext', 'LoginResult', 'IList'] AS t) x")

ENTRIES = """SELECT o_orderkey AS seq, cast(50 + o_orderkey % 46 as double) / 100 AS confidence, concat('src/Web/Pages/P', cast(o_custkey % 40 as varchar(20)), CASE WHEN o_custkey % 5 = 0 THEN '.cshtml' ELSE '.cs' END) AS source_file, o_custkey % 6 = 0 AS external, o_custkey % 4 = 0 AS data_access,
  o_custkey % 3 = 0 AS application, o_custkey % 7 = 0 AS semantic, o_orderkey % 97 = 0 AS marker, CASE o_orderkey % 4 WHEN 0 THEN 'HTTP_API' WHEN 1 THEN 'FrontendRoute' WHEN 2 THEN 'CLI' ELSE 'Job' END AS type,
  concat(CASE o_orderkey % 3 WHEN 0 THEN '/api/' WHEN 1 THEN '/' ELSE '' END, lower(substring(o_orderpriority, 3, 20)), CASE o_orderkey % 11 WHEN 0 THEN '/{id}' WHEN 1 THEN '/auth' WHEN 2 THEN '/admin' WHEN 3 THEN '/health' ELSE '' END) AS path, CASE o_orderstatus WHEN 'P' THEN 'GET' WHEN 'F' THEN 'POST' ELSE 'unknown' END AS method,
  concat('W', cast(o_custkey % 600 as varchar(20)), 'Controller') AS owner, concat('Brand#', cast(o_custkey % 25 + 1 as varchar(20))) AS module, cast(floor(o_totalprice) as bigint) % 12 AS steps FROM <<orders>>"""
_ladder("interface_visibility", ENTRIES, "seq, type, path", {"visibility": case_sql(C.INTERFACE_RULES, "'unknown'")}, oracle=f"SELECT seq, type, path, CASE WHEN type = 'FrontendRoute' THEN 'user_facing' WHEN starts_with(lower(path), '/api/') THEN 'external_system' WHEN type <> 'CLI' AND starts_with(path, '/') THEN 'user_facing' WHEN type = 'CLI' THEN 'internal' ELSE 'unknown' END AS visibility FROM ({B.duck(ENTRIES)}) e")

MODULES = """SELECT c_custkey AS seq, concat('M', cast(c_custkey as varchar(20))) AS name, cast(cast(floor(c_acctbal) as bigint) % 50 + 50 as double) / 100 AS confidence, c_custkey % 11 = 0 AS in_cycle, cast(c_nationkey % 9 as bigint) AS coupling,
  cast(c_custkey % 13 as bigint) AS folders, cast(c_nationkey % 4 as bigint) AS efferent, c_custkey % 3 = 0 AS has_entry, c_mktsegment AS segment, cast(c_custkey % 7 as bigint) AS components FROM <<customer>>"""
_ladder("boundary_quality", MODULES, "seq, name", {"boundary_quality": case_sql(C.BOUNDARY_RULES, "'Medium'")}, oracle=f"SELECT seq, name, CASE WHEN confidence < 0.6 THEN 'Unknown' WHEN NOT in_cycle AND coupling BETWEEN 0 AND 1 AND folders < 5 THEN 'Strong' WHEN NOT in_cycle AND coupling < 6 AND folders < 11 THEN 'Medium' ELSE 'Weak' END AS boundary_quality FROM ({B.duck(MODULES)}) m")
_ladder("migration_readiness", MODULES, "seq, name", {"migration_readiness": case_sql(C.READINESS_RULES, "'Needs Refactoring'")}, oracle=f"SELECT seq, name, CASE WHEN confidence < 0.6 THEN 'Unknown' WHEN coupling < 6 AND NOT in_cycle THEN CASE WHEN has_entry AND efferent < 2 THEN 'Ready' ELSE 'Needs Refactoring' END ELSE 'Blocked' END AS migration_readiness FROM ({B.duck(MODULES)}) m")

_ladder("strangler_score", MODULES, "seq, name", {
    "score": f"cast({case_sql([(c, r.split(', ')[1]) for c, r in C.STRANGLER_RULES])} as bigint)", "rank": case_sql([(c, r.split(", ")[0]) for c, r in C.STRANGLER_RULES]),
}, oracle=f"SELECT seq, name, CASE WHEN free AND efferent < 2 AND has_entry THEN 90 WHEN free AND coupling < 3 THEN 70 WHEN free THEN 55 ELSE 20 END::BIGINT AS score, CASE WHEN NOT free THEN 'Poor' WHEN efferent < 2 AND has_entry THEN 'Good' ELSE 'Possible' END AS rank FROM (SELECT *, NOT in_cycle AND coupling < 6 AS free FROM ({B.duck(MODULES)}) m) x")
CAPABILITIES = """SELECT c_custkey AS seq, CASE WHEN c_custkey % 19 = 0 THEN 'Cache' ELSE concat('Cap', cast(c_custkey as varchar(20))) END AS name, c_custkey % 29 = 0 AS all_tests, cast(c_custkey % 3 as bigint) AS repositories, cast(c_nationkey % 3 as bigint) AS entities, cast(c_custkey % 2 as bigint) AS interfaces,
  cast(c_nationkey % 2 as bigint) AS ui, cast(c_custkey % 5 as bigint) AS risk_count, cast(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END as bigint) AS weak_modules, cast(c_nationkey % 8 as bigint) AS efferent, cast(c_nationkey % 3 as bigint) AS data_access, cast(c_custkey % 3 as bigint) AS module_count, cast(c_custkey % 6 as bigint) AS component_count FROM <<customer>>"""
CLASSED = f"SELECT *, {case_sql(C.CAPABILITY_CLASS, quote('ApplicationCapabilityCandidate'))} AS class FROM ({CAPABILITIES}) k"
_ladder("capability_class", CAPABILITIES, "seq, name", {"class": case_sql(C.CAPABILITY_CLASS, "'ApplicationCapabilityCandidate'")}, oracle=f"SELECT seq, name, CASE WHEN all_tests THEN 'TestVerification' WHEN name = 'Cache' THEN 'TechnicalSupport' WHEN repositories >= 1 THEN 'DataInfrastructure' WHEN entities >= 1 THEN 'DomainCapabilityCandidate' WHEN interfaces >= 1 THEN 'InterfaceCapabilityCandidate' WHEN ui >= 1 THEN 'UICapabilityCandidate' ELSE 'ApplicationCapabilityCandidate' END AS class FROM ({B.duck(CAPABILITIES)}) k")
_ladder("contract_decision", CLASSED, "seq, name, class", {"decision": case_sql(C.CAPABILITY_DECISION, "'review'")}, oracle=f"SELECT seq, name, class, CASE WHEN class LIKE 'Test%' OR class LIKE 'Technical%' THEN 'review' WHEN weak_modules >= 1 OR risk_count > 2 THEN 'review_before_extraction' WHEN interfaces >= 1 AND efferent < 3 THEN 'candidate_for_early_modernization' WHEN interfaces = 0 AND data_access >= 1 THEN 'preserve_as_internal_until_ownership_confirmed' ELSE 'review' END AS decision FROM (SELECT *, CASE WHEN all_tests THEN 'TestVerification' WHEN name = 'Cache' THEN 'TechnicalSupport' WHEN repositories >= 1 THEN 'DataInfrastructure' WHEN entities >= 1 THEN 'DomainCapabilityCandidate' WHEN interfaces >= 1 THEN 'InterfaceCapabilityCandidate' WHEN ui >= 1 THEN 'UICapabilityCandidate' ELSE 'ApplicationCapabilityCandidate' END AS class FROM ({B.duck(CAPABILITIES)}) k) c")
_ladder("interface_decision", ENTRIES, "seq, type, path", {"decision": case_sql(C.INTERFACE_DECISION, "'preserve'")}, oracle=f"SELECT seq, type, path, CASE WHEN type = 'HTTP_API' AND method <> 'unknown' AND confidence >= 0.7 AND (confidence >= 0.85 OR position('{{' IN path) = 0) THEN 'preserve' ELSE 'review' END AS decision FROM ({B.duck(ENTRIES)}) e")
_ladder("module_consolidation", CLASSED, "seq, name, class", {"action": case_sql(C.CONSOLIDATION_RULES, "'consolidate_as_candidate_module'")}, oracle=f"SELECT seq, name, class, CASE WHEN module_count < 2 AND component_count < 3 AND class <> 'DataInfrastructure' AND class <> 'InterfaceCapabilityCandidate' THEN 'keep_as_component_or_submodule_candidate' WHEN weak_modules >= 1 OR risk_count >= 1 OR efferent >= 6 THEN 'review_before_consolidating' ELSE 'consolidate_as_candidate_module' END AS action FROM (SELECT *, CASE WHEN all_tests THEN 'TestVerification' WHEN name = 'Cache' THEN 'TechnicalSupport' WHEN repositories >= 1 THEN 'DataInfrastructure' WHEN entities >= 1 THEN 'DomainCapabilityCandidate' WHEN interfaces >= 1 THEN 'InterfaceCapabilityCandidate' WHEN ui >= 1 THEN 'UICapabilityCandidate' ELSE 'ApplicationCapabilityCandidate' END AS class FROM ({B.duck(CAPABILITIES)}) k) c")
FLOWS = f"SELECT *, steps = 1 AND type = 'HTTP_API' AND NOT (path LIKE '/api/%') AND (source_file LIKE '%.cshtml' OR contains(source_file, '/Pages/')) AS page_flow FROM ({ENTRIES}) f"
_ladder("flow_status", FLOWS, "seq, type, steps", {"status": case_sql(C.FLOW_STATUS, "'traced_from_dependency_candidates'"), "confidence": C.flow_confidence()})


@register("language_share", f"""
WITH k AS (SELECT seq, {lookup_sql('lower(suffix)', fixed.LANGUAGE_BY_EXTENSION)} AS language FROM ({FILES_D}) t), n AS (
  SELECT language, count(*) AS n, min(seq) AS first_seq FROM k WHERE language IS NOT NULL GROUP BY language
), p AS (SELECT language, n, round(cast(n AS DOUBLE) / sum(n) OVER () * 100, 1) AS percent, row_number() OVER (ORDER BY n DESC, first_seq) = 1 AS is_primary FROM n)
SELECT language, n, percent, is_primary, CASE WHEN max(percent) OVER () >= 5 THEN percent >= 5 ELSE is_primary END AS use_extractor FROM p""")
def language_share(spark, sf_dir):
    return C.language_share(B.source(spark, sf_dir, B.FILES))


FLAGGED = f"SELECT seq, module, component_type, layer, seq % 9 = 0 AS high, seq % 14 = 0 AS violates FROM ({B.COMPONENTS}) c"


@register("risk_flags", f"SELECT seq, concat_ws(',', {', '.join(f'CASE WHEN {c} THEN {quote(n)} END' for n, c in C.RISK_FLAGS)}) AS flags FROM ({B.duck(FLAGGED)}) t")
def risk_flags(spark, sf_dir):
    flags = F.array_compact(F.array(*(F.when(F.expr(condition), name) for name, condition in C.RISK_FLAGS)))
    return B.source(spark, sf_dir, FLAGGED).select("seq", F.array_join(flags, ",").alias("flags"))


MODULE_COUNTS = {"controllers": "component_type = 'Controller'", "services": "component_type = 'Service'", "repositories": "component_type = 'Repository'", "entities": "component_type = 'Entity'", "frontends": "component_type = 'FrontendComponent'", "data_layer": "layer = 'DataAccess'", "cross_layer": "layer = 'CrossCutting'", "interfaces": "name LIKE '%Endpoint'"}


@register("module_design_role", f"WITH m AS (SELECT module, project, {', '.join(f'count(*) FILTER (WHERE {c}) AS {n}' for n, c in MODULE_COUNTS.items())} FROM ({COMPONENTS_D}) t GROUP BY module, project) SELECT module, project, {case_sql(C.DESIGN_ROLES, quote('supporting'))} AS role FROM m")
def module_design_role(spark, sf_dir):
    found = B.source(spark, sf_dir, B.COMPONENTS).groupBy("module", "project").agg(*(F.count_if(F.expr(c)).alias(n) for n, c in MODULE_COUNTS.items()))
    return found.select("module", "project", column(C.DESIGN_ROLES, "'supporting'").alias("role"))


@register("module_responsibility", f"""WITH t AS (SELECT module, component_type, count(*) AS n, min(seq) AS s FROM ({COMPONENTS_D}) c GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY module ORDER BY n DESC, s) AS k FROM t),
  o AS (SELECT module, lower(string_agg(component_type, ', ' ORDER BY k) FILTER (WHERE component_type <> 'Unknown')) AS types FROM r WHERE k <= 4 GROUP BY module), d AS (SELECT DISTINCT module, regexp_replace(file, '/[^/]*$', '') AS folder FROM ({COMPONENTS_D}) c),
  f AS (SELECT module, string_agg(folder, ', ' ORDER BY folder) AS folders FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY folder) AS k FROM d) x WHERE k <= 3 GROUP BY module)
  SELECT o.module, concat_ws('; ', CASE WHEN types IS NOT NULL THEN concat('owns ', types, ' components') END, concat('evidenced by ', folders)) AS responsibility FROM o JOIN f ON f.module = o.module""")
def module_responsibility(spark, sf_dir):
    """What a module owns (its four most frequent types, ties by first seen) and where (its first three folders)."""
    c = B.source(spark, sf_dir, B.COMPONENTS)
    counts = c.groupBy("module", "component_type").agg(F.count("*").alias("n"), F.min("seq").alias("s"))
    top = F.filter(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "s", "component_type"))), 1, 4)["component_type"], lambda t: t != "Unknown")
    folders = F.slice(F.array_sort(F.collect_set(F.regexp_replace("file", "/[^/]*$", ""))), 1, 3)
    met = counts.groupBy("module").agg(top.alias("types")).join(c.groupBy("module").agg(folders.alias("folders")), "module")
    owns = F.when(F.size("types") > 0, F.concat(F.lit("owns "), F.lower(F.array_join("types", ", ")), F.lit(" components")))
    return met.select("module", F.concat_ws("; ", owns, F.concat(F.lit("evidenced by "), F.array_join("folders", ", "))).alias("responsibility"))


@register("component_registry", f"""WITH c AS ({COMPONENTS_D}), hot AS (SELECT src AS name FROM ({B.duck(B.EDGES)}) e GROUP BY src HAVING count(DISTINCT dst) >= 8)
  SELECT seq, name, coalesce(component_type, 'Unknown') AS component_type, coalesce(layer, 'Unknown') AS layer, module, confidence, name IN (SELECT name FROM hot) AS high_coupling, is_test FROM c""")
def component_registry(spark, sf_dir):
    hot = B.source(spark, sf_dir, B.EDGES).groupBy("src").agg(F.count_distinct("dst").alias("n")).where("n >= 8").select(F.col("src").alias("name"), F.lit(True).alias("hot"))
    c = B.source(spark, sf_dir, B.COMPONENTS).join(hot, "name", "left")
    return c.select("seq", "name", F.coalesce("component_type", F.lit("Unknown")).alias("component_type"), F.coalesce("layer", F.lit("Unknown")).alias("layer"), "module", "confidence", F.coalesce("hot", F.lit(False)).alias("high_coupling"), "is_test")


PATTERN_COUNTS = {
    "repositories": "component_type = 'Repository'", "specifications": "contains(name, 'Specification') OR contains(file, 'Specifications/')", "endpoints": "component_type = 'Controller' AND (name LIKE '%Endpoint' OR contains(file, 'Endpoints/'))",
    "page_controllers": "component_type = 'Controller' AND (contains(file, '/Controllers/') OR contains(file, '/Pages/'))", "frontends": "component_type = 'FrontendComponent'", "injected": "contract IS NOT NULL", "contexts": "contains(name, 'Context') OR contains(file, 'Data/Config')",
    "configurations": "component_type = 'Configuration'", "handlers": "component_type = 'Handler'", "core_projects": "project IN ('ApplicationCore', 'Infrastructure')",
}


#: Package references of projects, and what they tell.
PACKAGES = """SELECT p_partkey AS seq, CASE p_partkey % 7 WHEN 0 THEN 'Ardalis.Specification' WHEN 1 THEN 'MinimalApi.Endpoint' WHEN 2 THEN 'Microsoft.EntityFrameworkCore.SqlServer' WHEN 3 THEN 'MediatR' WHEN 4 THEN 'Serilog' ELSE p_brand END AS package FROM <<part>>"""
PACKAGE_COUNTS = {"specification_packages": "package = 'Ardalis.Specification'", "endpoint_packages": "package IN ('Ardalis.ApiEndpoints', 'MinimalApi.Endpoint')", "orm_packages": "contains(package, 'EntityFrameworkCore')", "mediator_packages": "package = 'MediatR'"}


@register("pattern_catalogue", f"""WITH c AS (SELECT * FROM ({COMPONENTS_D}) t), k AS (SELECT package FROM ({B.duck(PACKAGES)}) t), e AS (SELECT path FROM ({B.duck(ENTRIES)}) t) SELECT * FROM (
  SELECT 'Layered Monolith / Layered Application' AS pattern, 0.78::DOUBLE AS confidence, (SELECT count(DISTINCT layer) FROM c) >= 3 AS detected
  UNION ALL SELECT 'Clean Architecture influence', 0.72, EXISTS (FROM c WHERE project IN ('ApplicationCore', 'Infrastructure'))
  UNION ALL SELECT 'Repository Pattern', 0.86, EXISTS (FROM c WHERE component_type = 'Repository')
  UNION ALL SELECT 'Specification Pattern', 0.84, EXISTS (FROM c WHERE contains(name, 'Specification') OR contains(file, 'Specifications/')) OR EXISTS (FROM k WHERE package = 'Ardalis.Specification')
  UNION ALL SELECT 'Endpoint / Handler-style API', 0.86, EXISTS (FROM c WHERE component_type = 'Controller' AND (ends_with(name, 'Endpoint') OR contains(file, 'Endpoints/'))) OR EXISTS (FROM k WHERE package IN ('Ardalis.ApiEndpoints', 'MinimalApi.Endpoint'))
  UNION ALL SELECT 'MVC / Razor Pages Web UI', 0.78, EXISTS (FROM c WHERE component_type = 'Controller' AND (contains(file, '/Controllers/') OR contains(file, '/Pages/')))
  UNION ALL SELECT 'Blazor frontend component/service style', 0.82, EXISTS (FROM c WHERE component_type = 'FrontendComponent')
  UNION ALL SELECT 'Dependency Injection and Constructor Injection', 0.9, EXISTS (FROM c WHERE contract IS NOT NULL)
  UNION ALL SELECT 'EF Core Data Access / ORM Configuration', 0.86, EXISTS (FROM c WHERE contains(name, 'Context') OR contains(file, 'Data/Config')) OR EXISTS (FROM k WHERE contains(package, 'EntityFrameworkCore'))
  UNION ALL SELECT 'Configuration / Options / Cross-cutting constants', 0.77, EXISTS (FROM c WHERE component_type = 'Configuration')
  UNION ALL SELECT 'MediatR / CQRS-style handlers', 0.68, EXISTS (FROM c WHERE component_type = 'Handler') OR EXISTS (FROM k WHERE package = 'MediatR')
  UNION ALL SELECT 'Health Check / Operational Endpoint style', 0.8, EXISTS (FROM e WHERE contains(lower(path), 'health'))) p WHERE detected""")
def pattern_catalogue(spark, sf_dir):
    """Patterns by components, packages and interfaces: one aggregate over each, then one row a detected pattern."""
    one = lambda rows, counts: rows.agg(*(F.count_if(F.expr(c)).alias(n) for n, c in counts.items())).withColumn("one", F.lit(1))
    c = B.source(spark, sf_dir, B.COMPONENTS)
    layers = c.agg(F.count_distinct("layer").alias("layers")).withColumn("one", F.lit(1))
    a = one(c, PATTERN_COUNTS).join(layers, "one").join(one(B.source(spark, sf_dir, PACKAGES), PACKAGE_COUNTS), "one").join(one(B.source(spark, sf_dir, ENTRIES), {"health": "contains(lower(path), 'health')"}), "one")
    found = F.array(*(F.when(F.expr(w), F.struct(F.lit(n).alias("pattern"), F.lit(c).alias("confidence"), F.lit(True).alias("detected"))) for n, c, w in C.PATTERNS))
    return a.select(F.inline(F.array_compact(found)))
