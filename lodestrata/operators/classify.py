"""Ordered classifications as rule tables over columns of files, components and modules.

Each ``*_RULES`` list is (condition, result) SQL text for ``rules.column``; the columns that
conditions name are given with each list. A null input matches no rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions import fixed
from lodestrata.functions.rules import case_sql, column, contains_any, ends_any, is_any, lookup_sql, pattern, quote

PADDED = "concat('/', lower_path)"


def _folder(name: str) -> str:
    """A path part of that name above the file."""
    return f"contains({PADDED}, '/{name}/')"


# --- files: path, name, suffix, lower_path, lower_name ---
KEEP_FILE = (
    f"NOT regexp_like({PADDED}, {quote('/(' + pattern(fixed.EXCLUDED_DIRS) + ')/')}) AND NOT " + contains_any("lower_folder", fixed.TEST_FRAGMENTS)
    + " AND NOT " + is_any("lower_name", fixed.EXCLUDED_NAMES) + " AND NOT " + ends_any("lower_name", fixed.EXCLUDED_SUFFIXES)
)
INVENTORY_LANGUAGE = f"coalesce({lookup_sql('name', fixed.INVENTORY_BY_NAME)}, {lookup_sql('lower(suffix)', fixed.INVENTORY_BY_SUFFIX)}, 'unknown')"
IGNORE_RULES = [
    ("contains(concat('/', path), '/architecture-output/')", "'generated_output:architecture-output'"),
    *((f"contains(concat('/', path), '/{d}/')", quote(f"ignored_directory:{d}")) for d in fixed.IGNORED_DIRECTORIES),
    ("lower_name LIKE '%.min.js'", "'ignored_file:minified_js'"),
    ("lower_name LIKE '%.map%'", "'ignored_file:source_map'"),
    ("lower_name LIKE '%.log'", "'ignored_file:log'"),
    ("lower_name LIKE '%.g.cs' OR lower_name LIKE '%.g.i.cs'", "'ignored_file:generated_csharp'"),
    ("lower_name LIKE '%.designer.cs'", "'ignored_file:generated_designer_csharp'"),
    ("contains(lower_name, '.generated.')", "'ignored_file:generated_file'"),
]
SUFFIX = "lower(suffix)"
CANDIDATE_RULES = [
    (f"{is_any('name', fixed.BUILD_FILES)} OR {is_any(SUFFIX, fixed.BUILD_SUFFIXES)}", "'build'"),
    (f"{is_any('name', fixed.DEPLOYMENT_FILES)} OR ({_folder('.github')} AND {_folder('workflows')})", "'build'"),
    ("lower_name LIKE 'appsettings%' OR lower_name IN ('web.config', 'global.json')", "'config'"),
    (f"{is_any(SUFFIX, ['.json', '.config', '.xml', '.yaml', '.yml', '.runsettings'])} AND ({_folder('properties')} OR {_folder('configuration')} OR lower_name LIKE '%config.json')", "'config'"),
    (f"{SUFFIX} = '.cs' AND (lower_name LIKE '%controller.cs' OR contains(lower_name, 'endpoints') OR contains({PADDED}, 'endpoints/'))", "'controller'"),
    (f"{SUFFIX} = '.cs' AND (lower_name LIKE '%service.cs' OR {_folder('services')})", "'service'"),
    (f"{SUFFIX} = '.cs' AND (lower_name LIKE '%repository.cs' OR {_folder('repositories')})", "'repository'"),
    (f"{SUFFIX} = '.cs' AND ({_folder('entities')} OR lower_name LIKE '%entity.cs')", "'entity'"),
    (f"{is_any(SUFFIX, ['.razor', '.cshtml'])}", "'frontend_component'"),
    (f"{INVENTORY_LANGUAGE} IN ('css', 'html', 'javascript') AND ({_folder('pages')} OR {_folder('views')} OR {_folder('wwwroot')})", "'frontend_component'"),
]
ROLE_RULES = [
    (f"{is_any('name', fixed.DEPLOYMENT_FILES)} OR lower_path LIKE '.github/workflows/%' OR lower_path LIKE 'infra/%'", "'deployment'"),
    (f"{is_any('name', fixed.BUILD_FILES)} OR {is_any(SUFFIX, fixed.BUILD_SUFFIXES)}", "'build'"),
]
CONFIG_FORMAT_RULES = [
    (f"NOT ({is_any('lower_name', fixed.CONFIG_NAMES)} OR {is_any(SUFFIX, fixed.CONFIG_EXTENSIONS)} OR lower_name LIKE '.env%')", "NULL"),
    (f"{SUFFIX} = '.json'", "'json'"),
    (f"{SUFFIX} IN ('.xml', '.config')", "'xml'"),
    (f"{SUFFIX} IN ('.yml', '.yaml')", "'yaml'"),
    ("lower_name LIKE '.env%'", "'env'"),
    (f"{SUFFIX} = '.properties'", "'properties'"),
]
GENERATED_SOURCE = "contains(path, '/Migrations/') OR path LIKE '%ModelSnapshot.cs'"

# --- projects: sdk, packages (comma list), lower_path, lower_name ---
PROJECT_RULES = [
    ("contains(packages, 'microsoft.net.test.sdk') OR lower_path LIKE 'tests/%' OR contains(lower_path, '/tests/') OR lower_name LIKE '%tests'", "'test_project'"),
    ("contains(lower(sdk), 'microsoft.net.sdk.blazorwebassembly') OR contains(packages, 'microsoft.aspnetcore.components.webassembly')", "'frontend_spa'"),
    ("contains(lower(sdk), 'microsoft.net.sdk.web') AND (contains(lower_name, 'api') OR contains(packages, 'ardalis.apiendpoints') OR contains(packages, 'minimalapi.endpoint'))", "'backend_web_api'"),
    ("contains(lower(sdk), 'microsoft.net.sdk.web')", "'backend_web_app'"),
    ("contains(packages, 'microsoft.entityframeworkcore.sqlserver') OR contains(packages, 'microsoft.entityframeworkcore.inmemory')", "'database_support_library'"),
]
PROJECT_CATEGORY = {"test_project": "test", "frontend_spa": "frontend", "backend_web_api": "backend", "backend_web_app": "backend", "database_support_library": "database_support", "library": "support"}
PROJECT_CONFIDENCE = {"test_project": 0.95, "frontend_spa": 0.9, "backend_web_api": 0.92, "backend_web_app": 0.92, "database_support_library": 0.78, "library": 0.75}

# --- methods and parameters ---
CATEGORY_RULES = [(contains_any("lower(name)", words), quote(category)) for category, words in fixed.BUSINESS_CATEGORIES.items()]
BUSINESS_METHOD = contains_any("lower(name)", fixed.BUSINESS_KEYWORDS)
PLAIN_KEY = "replace(replace(replace(lower(key), '.', ''), '-', ''), '_', '')"
LABEL_RULES = [
    ("business", contains_any(PLAIN_KEY, fixed.CONFIG_BUSINESS)),
    ("connection", contains_any(PLAIN_KEY, ["connectionstring", "datasource"])),
    ("feature_flag", contains_any(PLAIN_KEY, ["enable", "feature", "flag", "toggle", "isenabled"])),
    ("role", contains_any(PLAIN_KEY, ["role", "permission", "access", "policy"])),
]
HALF_PLAIN_KEY = "replace(replace(lower(key), '_', ''), '-', '')"
REDACT = f"CASE WHEN {contains_any(HALF_PLAIN_KEY, fixed.SENSITIVE)} THEN {quote(fixed.REDACTED)} ELSE coalesce(value, '') END"
PRIMITIVE = is_any("simple_type", fixed.PRIMITIVE_TYPES)
DTO_LIKE = ends_any("simple_type", fixed.DTO_SUFFIXES)
ARCHITECTURE_DEPENDENCY = f"NOT {PRIMITIVE} AND NOT {DTO_LIKE} AND ((simple_type LIKE 'I%' AND length(simple_type) > 2) OR {contains_any('simple_type', fixed.DEPENDENCY_HINTS)})"

# --- components: name, kind, file, bases, annotations, dep_types, category ---
LN, LP = "lower(name)", "lower(file)"
FRONT = "category = 'frontend'"


def _ends(*words: str) -> str:
    return "(" + " OR ".join(f"{LN} LIKE '%{w}'" for w in words) + ")"


def _path(*words: str) -> str:
    return contains_any(LP, [f"/{w}/" for w in words])


# The published ladders, in their order, with their layers, confidences and evidence texts.
#: First ladder: (condition, type, layer, confidence, evidence).
FIRST_LADDER = [
    (f"file LIKE '%/Program.cs' OR {LN} IN ('dependencies', 'servicesconfiguration')", "Configuration", "'CrossCutting'", 0.78, "bootstrap or service configuration file"),
    (f"{LP} LIKE 'tests/%'", "Unknown", "'CrossCutting'", 0.62, "test project source artifact"),
    (f"{_ends('settings', 'options', 'constants')} OR {_path('constants')}", "Configuration", f"CASE WHEN {_path('applicationcore', 'web')} THEN 'CrossCutting' WHEN {FRONT} THEN 'Presentation/UI' ELSE 'Application' END", 0.76, "settings/constants/options naming or folder pattern"),
    (_ends("exception"), "Unknown", "'CrossCutting'", 0.66, "exception class naming pattern"),
    (f"{_ends('specification', 'spec')} OR {_path('specifications')}", "Repository", "'DataAccess'", 0.74, "Specification pattern query object used by repositories"),
    (_ends("seed"), "BatchJob", "'DataAccess'", 0.72, "database seed class naming pattern"),
    (_ends("healthcheck"), "Service", "'CrossCutting'", 0.74, "ASP.NET health check component naming pattern"),
    (f"{_ends('schemafilters', 'filter')} OR contains(bases, 'ISchemaFilter')", "Configuration", "'API'", 0.72, "API/schema/filter configuration naming or interface pattern"),
    (_ends("hostingstartup"), "Configuration", "'CrossCutting'", 0.74, "ASP.NET hosting startup naming pattern"),
    (f"{_ends('helper', 'helpers')} OR {_path('helpers', 'extensions')}", "Service", f"CASE WHEN {FRONT} THEN 'Presentation/UI' ELSE 'CrossCutting' END", 0.68, "helper/extension support utility naming or folder pattern"),
    (f"kind LIKE 'interface%' AND {LN} LIKE 'i%' AND contains({LN}, 'repository')", "Repository", "'DataAccess'", 0.84, "repository interface naming pattern"),
    (f"kind LIKE 'interface%' AND {LN} LIKE 'i%' AND {contains_any(LN, ['sender', 'client', 'gateway'])}", "ExternalClient", "'Integration'", 0.76, "integration interface naming pattern"),
    (f"kind LIKE 'interface%' AND {LN} LIKE 'i%' AND {contains_any(LN, ['aggregateroot', 'entity'])}", "Entity", "'Domain'", 0.78, "domain marker interface naming pattern"),
    (f"kind LIKE 'interface%' AND {LN} LIKE 'i%'", "Service", f"CASE WHEN {_path('applicationcore')} THEN 'Application' ELSE 'CrossCutting' END", 0.7, "interface classified as service contract by naming/path"),
    ("file LIKE '%.razor.cs' OR " + contains_any("bases", ["BlazorComponent", "InputSelect", "ViewComponent"]), "FrontendComponent", "'Presentation/UI'", 0.82, "Razor/Blazor/MVC view component code-behind or base class"),
    ("contains(bases, 'IdentityUser')", "Entity", "'Infrastructure'", 0.8, "ASP.NET Identity user entity base class"),
    (f"contains(bases, 'IOutboundParameterTransformer') OR {_ends('transformer')}", "Configuration", "'Presentation/UI'", 0.74, "ASP.NET route parameter transformer"),
    (f"{_path('views')} AND contains({LN}, 'nav')", "FrontendComponent", "'Presentation/UI'", 0.7, "MVC view navigation helper under Views folder"),
    (_ends("attribute"), "Configuration", "'CrossCutting'", 0.72, "custom attribute metadata class"),
    (f"{_path('authorization')} AND {LN} IN ('roles', 'constants')", "Configuration", "'CrossCutting'", 0.74, "authorization constants/configuration artifact"),
    (f"{_path('authorization')} OR {LN} IN ('claimvalue', 'userinfo')", "DTO", "'Application'", 0.76, "authorization data transfer object"),
    (f"contains(bases, 'IAppLogger') OR {_ends('adapter')}", "Service", "'CrossCutting'", 0.76, "adapter/service contract implementation"),
    ("contains(bases, 'IRequest')", "Handler", "'Application'", 0.74, "MediatR request/query message"),
    (f"{_path('data')} AND {_ends('item')}", "DTO", "'Infrastructure'", 0.7, "data/infrastructure transfer object naming and path"),
]
#: Second ladder: what it finds overrides type, layer and confidence of the first; evidence of both stays.
SECOND_LADDER = [
    (f"contains({LN}, 'controller') OR contains(bases, 'Controller') OR contains(annotations, 'ApiController')", "Controller", "'API'", 0.9, "controller name/base class/API controller attribute"),
    (f"{_ends('endpoint')} OR {contains_any('bases', ['IEndpoint', 'EndpointBaseAsync'])}", "Controller", "'API'", 0.86, "endpoint class implementing ASP.NET endpoint abstraction"),
    (f"contains(lower(bases), 'pagemodel') OR ({_ends('model')} AND {_path('pages')})", "Controller", "'Presentation/UI'", 0.8, "Razor PageModel class"),
    (f"{_ends('middleware')} OR {_path('middleware')}", "Middleware", "'CrossCutting'", 0.88, "middleware name/path"),
    (f"{_ends('handler')} OR contains(bases, 'IRequestHandler')", "Handler", "'Application'", 0.86, "handler name or MediatR IRequestHandler implementation"),
    (f"{_ends('repository')} OR {contains_any('bases', ['RepositoryBase', 'IRepository'])}", "Repository", "'DataAccess'", 0.9, "repository name/base/interface"),
    (f"contains(bases, 'DbContext') OR {_ends('dbcontext')}", "Repository", "'DataAccess'", 0.82, "database context class"),
    (f"contains(bases, 'IEntityTypeConfiguration') OR {_ends('configuration')} OR {_path('configuration', 'config')}", "Configuration", f"CASE WHEN {_path('infrastructure')} THEN 'Infrastructure' ELSE 'CrossCutting' END", 0.84, "configuration name/path/interface"),
    (f"{_ends('profile')} OR contains(bases, 'Profile')", "Mapper", "'Application'", 0.82, "mapping profile"),
    (f"contains({LN}, 'validator') OR contains({LP}, 'validation')", "Validator", "'Application'", 0.76, "validator name/path"),
    (f"({_ends('service')} OR {_path('services')}) AND {FRONT}", "FrontendService", "'Presentation/UI'", 0.82, "service class in frontend project"),
    (f"({_ends('service')} OR {_path('services')}) AND (contains(dep_types, 'HttpClient') OR {_ends('client')})", "ExternalClient", "'Integration'", 0.78, "service/client uses HttpClient"),
    (f"{_ends('service')} OR {_path('services')}", "Service", "'Application'", 0.84, "service name/path"),
    (f"{_ends('client')} OR contains(dep_types, 'HttpClient')", "ExternalClient", "'Integration'", 0.75, "client name or HttpClient dependency"),
    (_ends("gateway"), "Gateway", "'Integration'", 0.78, "gateway name"),
    (f"{_ends('stateprovider')} OR contains(bases, 'AuthenticationStateProvider')", "StateStore", "'Presentation/UI'", 0.76, "state provider base/name"),
    (f"{contains_any('bases', ['ComponentBase', 'LayoutComponentBase'])} OR contains({LP}, '/helpers/blazor')", "FrontendComponent", "'Presentation/UI'", 0.78, "Blazor component base class"),
    (f"{_path('entities')} OR {contains_any('bases', ['IAggregateRoot', 'BaseEntity'])}", "Entity", "'Domain'", 0.88, "entity path/base/interface"),
    (f"{contains_any(LN, ['dto', 'request', 'response', 'viewmodel', 'message'])} OR {_path('viewmodels', 'models')}", "DTO", f"CASE WHEN {FRONT} OR {_path('ui', 'web')} THEN 'Presentation/UI' ELSE 'Application' END", 0.78, "DTO/request/response/view-model name or path"),
    (_ends("job"), "ScheduledJob", "'Application'", 0.7, "job name"),
    (contains_any("bases", ["BackgroundService", "IHostedService"]), "ScheduledJob", "'Application'", 0.8, "hosted/background service base"),
    (_ends("consumer", "listener"), "MessageConsumer", "'Integration'", 0.78, "consumer/listener name"),
    (_ends("batch", "migration"), "BatchJob", "'DataAccess'", 0.68, "batch/migration name"),
]


# What is uncertain about a class, by the evidence that it was found by.
UNCERTAINTY = {
    "test project source artifact": "Test source component retained as verification evidence, not a production application component",
    "exception class naming pattern": "Exception type has no exact requested component category; layer classified as CrossCutting",
    "Specification pattern query object used by repositories": "Specification classified as Repository-adjacent DataAccess because requested type list has no Specification category",
    "database seed class naming pattern": "Seed class classified as BatchJob-style data initialization support",
    "helper/extension support utility naming or folder pattern": "Helper/extension classified as Service-style support component because requested type list has no Helper category",
    "interface classified as service contract by naming/path": "Generic interface classified as Service contract because no narrower category was detected",
    "MVC view navigation helper under Views folder": "Static MVC view helper classified as FrontendComponent because requested type list has no ViewHelper category",
    "MediatR request/query message": "MediatR request object classified as Handler-style application component because requested type list has no Command/Query category",
    "endpoint class implementing ASP.NET endpoint abstraction": "endpoint-style HTTP component classified as Controller because requested type list has no Endpoint category",
    "Razor PageModel class": "Razor PageModel classified as Controller-like presentation component",
    "database context class": "DbContext captured under Repository because requested type list has no DatabaseContext category",
}
UNCLASSIFIED = "No strong component classification signal from name, path, attributes, base types, or dependencies"


def ladder_sql(ladder, part: int) -> str:
    """One column of a ladder: 1 type, 2 layer, 3 confidence, 4 evidence."""
    shown = {1: quote, 2: str, 3: lambda x: f"cast({x} as double)", 4: quote}[part]
    return case_sql([(rule[0], shown(rule[part])) for rule in ladder])


def component_sql() -> dict[str, str]:
    """Type, layer, confidence, evidence and uncertainty of a component, by both ladders."""
    uncertain = lambda ladder: case_sql([(rule[0], quote(UNCERTAINTY[rule[4]]) if rule[4] in UNCERTAINTY else "cast(NULL as varchar(200))") for rule in ladder])
    one, two = (lambda p: ladder_sql(FIRST_LADDER, p)), (lambda p: ladder_sql(SECOND_LADDER, p))
    return {
        "component_type": f"coalesce({two(1)}, {one(1)}, 'Unknown')",
        "layer": f"coalesce({two(2)}, {one(2)}, 'Unknown')",
        "confidence": f"coalesce({two(3)}, {one(3)}, cast(0.5 as double))",
        "evidence": f"concat_ws('; ', {one(4)}, {two(4)})",
        "uncertainty": f"concat_ws('; ', {uncertain(FIRST_LADDER)}, {uncertain(SECOND_LADDER)}, CASE WHEN coalesce({two(1)}, {one(1)}, 'Unknown') = 'Unknown' THEN {quote(UNCLASSIFIED)} END)",
    }


def classify_components(components: DataFrame) -> DataFrame:
    """Adds ``component_type, layer, confidence, evidence, uncertainty``."""
    return components.select("*", *(F.expr(sql).alias(name) for name, sql in component_sql().items()))


SIGNIFICANCE_RULES = [
    (f"{LP} LIKE 'tests/%'", "'VerificationOnly'"),
    (is_any("component_type", fixed.MAJOR_TYPES), "'Major'"),
    (is_any("component_type", fixed.SUPPORTING_TYPES), "'Supporting'"),
    (f"{contains_any(LN, ['exception', 'constant', 'helper', 'extension'])} OR {_path('constants', 'helpers', 'extensions', 'javascript')}", "'SupportOnly'"),
]

# --- modules: confidence, in_cycle, coupling, folders, efferent, has_entry ---
BOUNDARY_RULES = [("confidence < 0.6", "'Unknown'"), ("in_cycle OR coupling >= 6 OR folders > 10", "'Weak'"), ("coupling <= 1 AND folders <= 4", "'Strong'")]
READINESS_RULES = [("confidence < 0.6", "'Unknown'"), ("in_cycle OR coupling >= 6", "'Blocked'"), ("efferent <= 1 AND has_entry", "'Ready'")]
INTERFACE_RULES = [("type = 'FrontendRoute'", "'user_facing'"), ("lower(path) LIKE '/api/%'", "'external_system'"), ("type = 'CLI'", "'internal'"), ("path LIKE '/%'", "'user_facing'")]
STRANGLER_RULES = [("in_cycle OR coupling >= 6", "'Poor', 20"), ("efferent <= 1 AND has_entry", "'Good', 90"), ("coupling <= 2", "'Possible', 70"), ("true", "'Possible', 55")]

# --- interfaces (type, method, path, confidence) and capabilities (class, risk_count, weak_modules, interfaces, efferent, data_access) ---
INTERFACE_DECISION = [("type <> 'HTTP_API'", "'review'"), ("method = 'unknown' OR confidence < 0.7", "'review'"), ("contains(path, '{') AND confidence < 0.85", "'review'")]
CAPABILITY_DECISION = [
    ("class IN ('TechnicalSupport', 'TestVerification')", "'review'"), ("risk_count >= 3 OR weak_modules > 0", "'review_before_extraction'"), ("interfaces > 0 AND efferent <= 2", "'candidate_for_early_modernization'"),
    ("data_access > 0 AND interfaces = 0", "'preserve_as_internal_until_ownership_confirmed'"),
]
# Capability names that are technical.
TECHNICAL_NAMES = "Application Cache Cached Configure Constants Custom Email File Imports Program Read Token Uri".split()
CAPABILITY_CLASS = [
    ("all_tests", "'TestVerification'"), (is_any("name", TECHNICAL_NAMES), "'TechnicalSupport'"), ("repositories > 0", "'DataInfrastructure'"), ("entities > 0", "'DomainCapabilityCandidate'"),
    ("interfaces > 0", "'InterfaceCapabilityCandidate'"), ("ui > 0", "'UICapabilityCandidate'"),
]
CONSOLIDATION_RULES = [
    ("module_count <= 1 AND component_count <= 2 AND class NOT IN ('DataInfrastructure', 'InterfaceCapabilityCandidate')", "'keep_as_component_or_submodule_candidate'"),
    ("weak_modules > 0 OR risk_count > 0 OR efferent > 5", "'review_before_consolidating'"),
]
RISK_FLAGS = [("high_coupling", "high"), ("architecture_violation", "violates"), ("unknown_module", "module = 'Unknown'"), ("unknown_classification", "component_type = 'Unknown' OR layer = 'Unknown'")]

# --- flows: marker, page_flow, type, steps, external, data_access, application, semantic ---
FLOW_PARTIAL = "CASE WHEN marker OR page_flow THEN false WHEN type = 'FrontendRoute' THEN steps <= 1 AND NOT external WHEN type = 'CLI' THEN steps <= 1 ELSE steps <= 1 OR NOT (data_access OR external OR application) END"
FLOW_STATUS = [
    ("marker", "'framework_route_coverage_marker'"), ("page_flow", "'single_component_page_flow_mapped'"), (FLOW_PARTIAL, "'partial'"), ("type = 'FrontendRoute'", "'frontend_route_mapped'"), ("type = 'CLI'", "'bootstrap_flow_mapped'"),
]
FLOW_POINTS = [("marker", "70"), ("page_flow", "68"), ("type = 'FrontendRoute'", f"CASE WHEN {FLOW_PARTIAL} THEN 55 ELSE 66 END"), ("type = 'CLI'", f"CASE WHEN {FLOW_PARTIAL} THEN 55 ELSE 64 END"), ("data_access", "74"), (f"NOT ({FLOW_PARTIAL})", "66")]


def flow_confidence() -> str:
    """Confidence of a flow: by status, raised by compiler-bound steps up to a ceiling."""
    base = case_sql(FLOW_POINTS, "55")
    raised = f"CASE WHEN {FLOW_PARTIAL} THEN least(65, {base} + 4) ELSE least(88, {base} + 8) END"
    return f"cast(CASE WHEN semantic THEN {raised} ELSE {base} END as double) / 100"


# --- edges between layers (sl, tl: layers; st, tt: types) ---
VIOLATION_RULES = [
    ("sl = 'Domain' AND tl IN ('Infrastructure', 'DataAccess', 'Integration', 'API', 'Presentation/UI')", "'domain_depends_on_outer_layer'"), ("st = 'Controller' AND tt = 'Repository'", "'controller_direct_repository_dependency'"),
    ("sl = 'Application' AND tl = 'Presentation/UI'", "'application_depends_on_ui'"), ("sl = 'Presentation/UI' AND tl = 'DataAccess'", "'ui_depends_on_data_access'"),
]
#: Relevance of an edge for a call flow: by kind, by the method that makes the call, by the target.
EDGE_SCORE = (
    "CASE kind WHEN 'component_call' THEN 40 WHEN 'roslyn_component_call' THEN 55 WHEN 'mediatr_handler_candidate' THEN 38 WHEN 'mediatr_send' THEN 34 WHEN 'method_parameter' THEN 30 WHEN 'di_resolution_candidate' THEN 24 "
    "WHEN 'constructor' THEN 12 WHEN 'property_injection' THEN 12 WHEN 'razor_inject' THEN 12 ELSE 0 END"
    " + CASE WHEN source_method = route_action THEN 35 WHEN source_method IS NOT NULL AND route_action IN ('unknown', 'AddRoute') THEN 12 ELSE 0 END"
    " + CASE WHEN target_type = 'Repository' OR target_layer = 'DataAccess' THEN 45 WHEN target_type IN ('Service', 'Handler') OR target_layer = 'Application' THEN 32"
    " WHEN target_type IN ('ExternalClient', 'Gateway') OR target_layer = 'Integration' THEN 30 WHEN target_type IN ('DTO', 'Entity', 'Configuration') THEN -8 ELSE 0 END"
    " + CASE WHEN relationship = 'injects' THEN -4 ELSE 0 END"
)
#: Design role of a module from counts of its types and layers; roles are named by a code.
DESIGN_ROLES = [
    ("(controllers > 0 OR interfaces > 0) AND (entities > 0 OR repositories > 0 OR services > 0)", "'business_capability'"), ("frontends > 0 OR lower(module) = 'admin'", "'user_interface'"), ("controllers > 0 OR interfaces > 0", "'invocation_api'"),
    ("entities > 0 AND repositories > 0", "'domain_and_persistence'"), ("entities > 0", "'domain_model'"), ("repositories > 0 OR data_layer > 0", "'data_access_adapter'"), ("cross_layer > 0", "'cross_cutting_support'"),
]
#: Patterns: (name, confidence, condition over one row of counts).
PATTERNS = [
    ("Layered Monolith / Layered Application", 0.78, "layers >= 3"),
    ("Clean Architecture influence", 0.72, "core_projects > 0"),
    ("Repository Pattern", 0.86, "repositories > 0"),
    ("Specification Pattern", 0.84, "specifications > 0 OR specification_packages > 0"),
    ("Endpoint / Handler-style API", 0.86, "endpoints > 0 OR endpoint_packages > 0"),
    ("MVC / Razor Pages Web UI", 0.78, "page_controllers > 0"),
    ("Blazor frontend component/service style", 0.82, "frontends > 0"),
    ("Dependency Injection and Constructor Injection", 0.9, "injected > 0"),
    ("EF Core Data Access / ORM Configuration", 0.86, "contexts > 0 OR orm_packages > 0"),
    ("Configuration / Options / Cross-cutting constants", 0.77, "configurations > 0"),
    ("MediatR / CQRS-style handlers", 0.68, "handlers > 0 OR mediator_packages > 0"),
    ("Health Check / Operational Endpoint style", 0.8, "health > 0"),
]


def is_business_method(name: Column) -> Column:
    return F.coalesce(F.lower(name).rlike("|".join(fixed.BUSINESS_KEYWORDS)), F.lit(False))


def business_category(names: DataFrame) -> DataFrame:
    """Adds ``category`` for the method in ``name``; the first category with a contained word wins."""
    return names.withColumn("category", column(CATEGORY_RULES, "'general'"))


def language_share(files: DataFrame) -> DataFrame:
    """``language, n, percent, is_primary, use_extractor`` from a column ``suffix``; ties of the primary go to the first file."""
    suffixes = files.groupBy(F.lower("suffix").alias("suffix")).agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    named = F.create_map(*(F.lit(x) for pair in fixed.LANGUAGE_BY_EXTENSION.items() for x in pair))
    known = suffixes.withColumn("language", F.try_element_at(named, F.col("suffix"))).where("language IS NOT NULL")
    counts = known.groupBy("language").agg(F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"))
    whole = Window.partitionBy()
    share = F.round(F.col("n").cast("double") / F.sum("n").over(whole) * 100, 1)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "first_seq"))
    out = counts.select("language", "n", share.alias("percent"), (rank == 1).alias("is_primary"))
    some = F.max((F.col("percent") >= fixed.LANGUAGE_THRESHOLD).cast("int")).over(whole)
    return out.withColumn("use_extractor", F.when(some == 1, F.col("percent") >= fixed.LANGUAGE_THRESHOLD).otherwise(F.col("is_primary")))
