"""Queries of text functions, sources and extractors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions import fixed
from lodestrata.functions import text as T
from lodestrata.functions.rules import case_sql, quote
from lodestrata.operators import classify as C
from lodestrata.operators import extract as X
from lodestrata.operators.code import Code
from lodestrata.operators.joins import pick
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import register

CS, PROGRAM, COMP, FILE = B.duck(B.CS), B.duck(B.PROGRAM), B.duck(B.COMPONENTS), B.duck(B.FILES)
NL = "chr(10)"


def q(pattern: str) -> str:
    return quote(pattern)


# --- text functions ---
@register("normalize_text", "SELECT doc_id, md5(regexp_replace(replace(concat(text, ' ', chr(13), chr(10), 'x', chr(9), chr(13)), chr(13) || chr(10), chr(10)), '[ \t]+(\n|\r|$)', '\\1', 'g')) AS digest FROM documents WHERE false UNION ALL SELECT doc_id, md5(regexp_replace(replace(replace(concat(text, ' ', chr(13), chr(10), 'x', chr(9), chr(13)), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+(\n|$)', '\\1', 'g')) FROM documents")
def normalize_text(spark, sf_dir):
    rows = B.source(spark, sf_dir, "SELECT doc_id, concat(text, ' ', chr(13), chr(10), 'x', chr(9), chr(13)) AS text FROM <<documents>>")
    return rows.select("doc_id", F.md5(T.normalize_newlines(F.col("text"))).alias("digest"))


@register("line_number", "SELECT doc_id, n_chars // 2 AS at_char, cast(length(substring(text, 1, cast(n_chars // 2 AS BIGINT))) - length(replace(substring(text, 1, cast(n_chars // 2 AS BIGINT)), chr(10), '')) + 1 AS BIGINT) AS line FROM documents")
def line_number(spark, sf_dir):
    rows = B.source(spark, sf_dir, "SELECT doc_id, text, n_chars div 2 AS at_char FROM <<documents>>")
    return rows.select("doc_id", "at_char", T.line_number(F.col("text"), F.col("at_char").cast("int")).alias("line"))


@register("line_count", "SELECT doc_id, cast(CASE WHEN length(text) = 0 THEN 0 ELSE len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END END AS BIGINT) AS lines FROM documents")
def line_count(spark, sf_dir):
    return B.source(spark, sf_dir, "SELECT doc_id, text FROM <<documents>>").select("doc_id", T.line_count(F.col("text")).alias("lines"))


@register("binary_ratio", "SELECT doc_id, length(regexp_replace(text, '[\\x20-\\x7E\\n\\r\\t]', '', 'g')) > 0 AS has_odd FROM documents")
def binary_ratio(spark, sf_dir):
    rows = B.source(spark, sf_dir, "SELECT doc_id, cast(text as binary) AS content FROM <<documents>>")
    return rows.select("doc_id", F.length(F.regexp_replace(F.decode("content", "ISO-8859-1"), r"[\x20-\x7E\n\r\t]", "")).alias("odd")).select("doc_id", (F.col("odd") > 0).alias("has_odd"))


NAMES = "SELECT seq, name, concat('App.', project, '.', name, 'HTTPClient2') AS qualified FROM ({}) c"


@register("identifier_tokens", rf"SELECT seq, array_to_string(list_filter(string_split_regex(lower(trim(regexp_replace(regexp_replace(qualified, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '[^A-Za-z0-9]+', ' ', 'g'))), ' +'), lambda w: w <> ''), '|') AS tokens FROM ({NAMES.format(COMP)}) t")
def identifier_tokens(spark, sf_dir):
    return B.source(spark, sf_dir, NAMES.format(B.COMPONENTS)).select("seq", F.array_join(T.identifier_tokens(F.col("qualified")), "|").alias("tokens"))


@register("capability_tokens", rf"SELECT seq, array_to_string(list_transform(list_filter(regexp_extract_all(regexp_replace(regexp_replace(qualified, '[_\-/.]+', ' ', 'g'), '([A-Z]+)([A-Z][a-z])', '\1 \2', 'g'), '([A-Z]?[a-z]+|[A-Z]+|\d+)', 1), lambda w: length(w) >= 3 AND lower(w) NOT IN ({', '.join(quote(t) for t in fixed.GENERIC_TOKENS)})), lambda w: upper(w[1]) || w[2:]), '|') AS tokens FROM ({NAMES.format(COMP)}) t")
def capability_tokens(spark, sf_dir):
    return B.source(spark, sf_dir, NAMES.format(B.COMPONENTS)).select("seq", F.array_join(T.capability_tokens(F.col("qualified")), "|").alias("tokens"))


TYPED = "SELECT seq, CASE seq % 4 WHEN 0 THEN concat('ref  System.', name, '<int>?') WHEN 1 THEN concat('global::App.', name) WHEN 2 THEN concat(name, '<List<', contract, '>>') ELSE name END AS type FROM ({}) c"


@register("simple_type", rf"SELECT seq, regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(trim(type), '\s+', ' ', 'g'), '^(in|out|ref|params) ', ''), '?', ''), 'global::', ''), '[<(].*$', ''), '^.*\.', '') AS simple FROM ({TYPED.format(COMP)}) t")
def simple_type(spark, sf_dir):
    return B.source(spark, sf_dir, TYPED.format(B.COMPONENTS)).select("seq", T.simple_type(F.col("type")).alias("simple"))


LITERALS = "SELECT seq, CASE seq % 3 WHEN 0 THEN concat('f($\"/a/', name, '\", x)') WHEN 1 THEN concat('g(@\"', name, '\")') ELSE name END AS code FROM ({}) c"


@register("string_literal", f"SELECT seq, nullif(regexp_extract(code, '[$@]*\"([^\"]+)\"', 1), '') AS literal FROM ({LITERALS.format(COMP)}) t")
def string_literal(spark, sf_dir):
    return B.source(spark, sf_dir, LITERALS.format(B.COMPONENTS)).select("seq", T.string_literal(F.col("code")).alias("literal"))


ROUTES = "SELECT seq, concat(name, 'Controller') AS controller, CASE WHEN seq % 3 = 0 THEN NULL ELSE 'api/[controller]/' END AS base, CASE seq % 4 WHEN 0 THEN '/items/{id:int}' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE '[action]' END AS method, CASE WHEN seq % 5 = 0 THEN 'Shop' END AS area FROM ({}) c"


@register("route_combine", rf"""WITH r AS ({ROUTES.replace("({})", f"({COMP})")}), j AS (SELECT seq, regexp_replace(controller, 'Controller$', '') AS bare, area, concat_ws('/', nullif(trim(area, '/'), ''), nullif(trim(base, '/'), ''), nullif(trim(method, '/'), '')) AS p FROM r)
  SELECT seq, concat('/', trim(regexp_replace(regexp_replace(replace(replace(replace(CASE WHEN p = '' THEN concat(bare, '/Run') ELSE p END, '[controller]', bare), '[action]', 'Run'), '[area]', coalesce(area, '')), '\{{([A-Za-z_][A-Za-z0-9_]*):[^}}]+\}}', '{{\1}}', 'g'), '/+', '/', 'g'), '/')) AS route FROM j""")
def route_combine(spark, sf_dir):
    r = B.source(spark, sf_dir, ROUTES.replace("({})", f"({B.COMPONENTS})"))
    return r.select("seq", T.combine_route(F.col("area"), F.col("base"), F.col("method"), F.col("controller"), F.lit("Run")).alias("route"))


@register("folder_depth", f"SELECT seq, array_to_string(string_split(path, '/')[1:3], '/') AS folder, CASE WHEN string_split(path, '/')[1] IN ('src', 'tests') THEN string_split(path, '/')[2] END AS project_root FROM ({FILE}) t")
def folder_depth(spark, sf_dir):
    parts = F.split("path", "/")
    return B.source(spark, sf_dir, B.FILES).select("seq", T.folder(F.col("path"), 3).alias("folder"), F.when(F.get(parts, F.lit(0)).isin("src", "tests"), F.get(parts, F.lit(1))).alias("project_root"))


@register("relative_path", f"SELECT seq, CASE WHEN path LIKE 'src/%' THEN substring(path, 5) ELSE path END AS relative FROM ({FILE}) t")
def relative_path(spark, sf_dir):
    return B.source(spark, sf_dir, B.FILES).select("seq", F.when(F.col("path").startswith("src/"), F.substr("path", F.lit(5))).otherwise(F.col("path")).alias("relative"))


@register("hashes", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def hashes(spark, sf_dir):
    return B.source(spark, sf_dir, "SELECT doc_id, text FROM <<documents>>").select("doc_id", F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"))


CONNECTIONS = """SELECT p_partkey AS seq, CASE p_partkey % 6 WHEN 0 THEN concat('Server=db', cast(p_size as varchar(20)), ';Database=Shop;User Id=u') WHEN 1 THEN concat('postgres://u:p@host', cast(p_size as varchar(20)), ':5433/app')
  WHEN 2 THEN concat('Data Source=app', cast(p_size as varchar(20)), '.db') WHEN 3 THEN 'mysql+x://m.example/docs' WHEN 4 THEN concat('Host=h', cast(p_size as varchar(20)), ';Port=1;Username=q;Database=d') ELSE concat('Server=s;Uid=u;Database=', p_type) END AS value FROM <<part>>"""


@register("connection_string", rf"""SELECT seq, CASE seq % 6 WHEN 0 THEN 'sqlserver' WHEN 1 THEN 'postgresql' WHEN 2 THEN 'sqlite' WHEN 3 THEN 'mysql' WHEN 4 THEN 'postgresql' ELSE 'mysql' END AS vendor,
  CASE seq % 6 WHEN 0 THEN regexp_extract(value, 'Server=([^;]+)', 1) WHEN 1 THEN regexp_extract(value, '@([^:/]+)', 1) WHEN 3 THEN 'm.example' WHEN 4 THEN regexp_extract(value, 'Host=([^;]+)', 1) WHEN 5 THEN 's' END AS host,
  CASE seq % 6 WHEN 0 THEN '1433' WHEN 1 THEN '5433' WHEN 3 THEN '3306' WHEN 4 THEN '1' WHEN 5 THEN '3306' END AS port, CASE seq % 6 WHEN 0 THEN 'Shop' WHEN 1 THEN 'app' WHEN 2 THEN regexp_extract(value, '=(.*)$', 1) WHEN 3 THEN 'docs' WHEN 4 THEN 'd' ELSE regexp_extract(value, 'Database=(.*)$', 1) END AS database FROM ({{B.duck(CONNECTIONS)}}) t""".replace("{B.duck(CONNECTIONS)}", B.duck(CONNECTIONS)))
def connection_string(spark, sf_dir):
    return B.source(spark, sf_dir, CONNECTIONS).select("seq", T.connection_string(F.col("value")).alias("c")).select("seq", "c.*")


@register("chunk_hints", rf"SELECT seq, array_to_string(list_distinct(regexp_extract_all(text, '(?:class|interface|enum)\s+(\w+)', 1))[1:0], ',') AS none_kept, len(list_distinct(regexp_extract_all(text, '(?:class|interface|enum)\s+(\w+)', 1))) AS symbols FROM ({CS}) t")
def chunk_hints(spark, sf_dir):
    hints = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?:class|interface|enum)\s+(\w+)"), 1))
    return B.texts(spark, sf_dir, B.CS).select("seq", F.array_join(F.slice(hints, 1, 0), ",").alias("none_kept"), F.size(F.slice(hints, 1, 20)).cast("long").alias("symbols"))


@register("table_escape", r"SELECT doc_id, md5(replace(replace(concat(text, '|a'), '|', '\|'), chr(10), ' ')) AS digest FROM documents")
def table_escape(spark, sf_dir):
    return B.source(spark, sf_dir, "SELECT doc_id, concat(text, '|a') AS text FROM <<documents>>").select("doc_id", F.md5(T.table_escape(F.col("text"))).alias("digest"))


@register("source_ref", f"SELECT seq, concat(name, ' (', component_type, ') [', file, CASE WHEN seq % 4 = 0 THEN '' ELSE concat(':', cast(points AS VARCHAR)) END, ']') AS ref FROM ({COMP}) t")
def source_ref(spark, sf_dir):
    line = F.when(F.col("seq") % 4 != 0, F.concat(F.lit(":"), F.col("points").cast("string")))
    return B.source(spark, sf_dir, B.COMPONENTS).select("seq", F.concat("name", F.lit(" ("), "component_type", F.lit(") ["), "file", F.coalesce(line, F.lit("")), F.lit("]")).alias("ref"))


@register("safe_name", f"SELECT seq, substring(regexp_replace(path, '[^A-Za-z0-9_-]', '_', 'g'), 1, 20) AS safe FROM ({FILE}) t")
def safe_name(spark, sf_dir):
    return B.source(spark, sf_dir, B.FILES).select("seq", T.safe_name(F.col("path")).alias("safe"))


LISTED = f"SELECT module, list_sort(array_agg(DISTINCT name)) AS names FROM ({COMP}) t GROUP BY module"


@register("short_list", f"SELECT module, CASE WHEN len(names) > 8 THEN concat(array_to_string(names[1:8], ', '), ', and ', cast(len(names) - 8 AS VARCHAR), ' more') ELSE array_to_string(names, ', ') END AS shown FROM ({LISTED}) t")
def short_list(spark, sf_dir):
    return B.source(spark, sf_dir, B.COMPONENTS).groupBy("module").agg(F.array_sort(F.collect_set("name")).alias("names")).select("module", T.short_list(F.col("names")).alias("shown"))


@register("mermaid_edges", f"SELECT src, concat(regexp_replace(src, '[^A-Za-z0-9_]', '_', 'g'), ' --> ', string_agg(DISTINCT regexp_replace(dst, '[^A-Za-z0-9_]', '_', 'g'), ' & ' ORDER BY regexp_replace(dst, '[^A-Za-z0-9_]', '_', 'g'))) AS line FROM ({B.duck(B.EDGES)}) t GROUP BY src")
def mermaid_edges(spark, sf_dir):
    e = B.source(spark, sf_dir, B.EDGES).select("src", T.node_id(F.col("dst")).alias("to"))
    return e.groupBy("src").agg(F.array_join(F.array_sort(F.collect_set("to")), " & ").alias("to")).select("src", F.concat(T.node_id(F.col("src")), F.lit(" --> "), "to").alias("line"))


@register("marked_file_demux", rf"WITH m AS (SELECT seq, regexp_extract_all(text, {q(X.MARKER)}, 1) AS names, regexp_extract_all(text, {q(X.MARKER)}, 2) AS bodies FROM ({B.duck(B.MARKED)}) t) SELECT seq, replace(trim(unnest(names)), '../', '') AS name, trim(unnest(bodies), chr(10)) AS content FROM m")
def marked_file_demux(spark, sf_dir):
    """Relative paths without ``..``; contents without white space at their ends."""
    found = X.matches(B.texts(spark, sf_dir, B.MARKED), X.MARKER, [1, 2], "seq")
    parts = F.filter(F.split(F.replace(F.trim("g1"), F.lit("\\"), F.lit("/")), "/"), lambda p: ~p.isin("", "..", "."))
    return found.select("seq", F.array_join(parts, "/").alias("name"), F.regexp_replace("g2", r"^\s+|\s+$", "").alias("content"))


@register("fenced_json", f"SELECT seq, CASE WHEN seq IS NOT NULL AND text LIKE '%a\"%' THEN regexp_extract(text, '(\\{{[^}}]*\\}})', 1) END AS json FROM ({B.duck(B.FENCED)}) t")
def fenced_json(spark, sf_dir):
    return B.texts(spark, sf_dir, B.FENCED).select("seq", T.fenced_json(F.col("text")).alias("json"))


@register("json_props", "SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return B.source(spark, sf_dir, "SELECT event_id, props FROM <<events>>").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@register("json_flatten", "SELECT event_id, 'props.k' AS key, json_extract_string(props, '$.k') AS value FROM events UNION ALL SELECT event_id, 'type', event_type FROM events")
def json_flatten(spark, sf_dir):
    from lodestrata.functions.flatten import flatten_json

    rows = B.source(spark, sf_dir, "SELECT event_id, concat('{\"props\":', props, ',\"type\":\"', event_type, '\"}') AS doc FROM <<events>>")
    return flatten_json(rows, "doc", "event_id")


@register("config_kv_lines", rf"WITH l AS (SELECT seq, unnest(string_split(text, chr(10))) AS line FROM ({B.duck(B.CONF)}) t) SELECT seq, trim(regexp_extract(line, '^([^=]*)=', 1)) AS key, trim(substring(line, instr(line, '=') + 1)) AS value FROM l WHERE trim(line) <> '' AND trim(line) NOT LIKE '#%' AND line LIKE '%=%'")
def config_kv_lines(spark, sf_dir):
    found = X.lines(B.texts(spark, sf_dir, B.CONF), "seq").where("trim(line) <> '' AND trim(line) NOT LIKE '#%' AND line LIKE '%=%'")
    return found.select("seq", F.trim(F.substring_index("line", "=", 1)).alias("key"), F.trim(F.substr("line", F.instr("line", "=") + 1)).alias("value"))


@register("compose_services", rf"WITH l AS (SELECT path, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM ({B.duck(B.COMPOSE)}) t), s AS (SELECT *, max(CASE WHEN trim(line) = 'services:' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY n) AS on_ FROM l) SELECT path, regexp_extract(line, '^  ([A-Za-z0-9_.-]+):\s*$', 1) AS service FROM s WHERE on_ = 1 AND regexp_matches(line, '^  ([A-Za-z0-9_.-]+):\s*$')")
def compose_services(spark, sf_dir):
    within = Window.partitionBy("path").orderBy("line_number")
    found = X.lines(B.texts(spark, sf_dir, B.COMPOSE), "path").withColumn("on", F.max((F.trim("line") == "services:").cast("int")).over(within))
    pattern = r"^  ([A-Za-z0-9_.-]+):\s*$"
    return found.where((F.col("on") == 1) & F.col("line").rlike(pattern)).select("path", F.regexp_extract("line", pattern, 1).alias("service"))


# --- extractors over whole texts: (key, statement, pattern, groups with names) ---
WHOLE = [
    ("cs_interfaces", B.CS, X.CS_INTERFACE, ["name"]), ("cs_properties_all", B.CS, X.CS_PROPERTY, ["type", "name"]), ("java_symbols", B.JAVA, X.JAVA_TYPE, ["kind", "name"]),
    ("injection_deps", B.CS, X.INJECT_PROPERTY, ["type", "name"]), ("field_types", B.CS, X.FIELD, ["type", "name"]), ("mediator_sends", B.CS, X.SEND, ["target", "request"]),
    ("attribute_routes_raw", B.CS, X.HTTP_ATTRIBUTE, ["verb", "arguments"]), ("di_registrations", B.PROGRAM, X.DI_GENERIC, ["lifetime", "service", "implementation"]), ("di_typeof", B.PROGRAM, X.DI_TYPEOF, ["lifetime", "service", "implementation"]),
    ("constructor_guards_raw", B.CS, X.CS_GUARD, ["guard"]), ("js_classes", B.JS, X.JS_PATTERNS[3][1], ["name"]),
]
for _key, _statement, _pattern, _names in WHOLE:
    _columns = ", ".join(f"unnest(list_transform(regexp_extract_all(text, {q(_pattern)}, {g}), lambda x: coalesce(x, ''))) AS {n}" for g, n in enumerate(_names, 1))

    @register(_key, f"SELECT seq, {_columns} FROM ({B.duck(_statement)}) t")
    def _whole(spark, sf_dir, statement=_statement, pattern=_pattern, names=tuple(_names)):
        found = X.matches(B.texts(spark, sf_dir, statement), pattern, list(range(1, len(names) + 1)), "seq")
        return found.select("seq", *(F.col(f"g{k}").alias(n) for k, n in enumerate(names, 1)))


@register("cs_classes", f"WITH c AS (SELECT seq, unnest(regexp_extract_all(text, {q(X.CS_CLASS)}, 1)) AS kind, unnest(regexp_extract_all(text, {q(X.CS_CLASS)}, 2)) AS name FROM ({CS}) t) SELECT seq, kind, name, regexp_matches(name, {q(X.SERVICE_SUFFIX)}) AS is_service FROM c")
def cs_classes(spark, sf_dir):
    found = X.matches(B.texts(spark, sf_dir, B.CS), X.CS_CLASS, [1, 2], "seq")
    return found.select("seq", F.col("g1").alias("kind"), F.col("g2").alias("name"), F.col("g2").rlike(X.SERVICE_SUFFIX).alias("is_service"))


LINES_SQL = "SELECT seq, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_number FROM ({}) t"


@register("cs_enums", rf"WITH e AS (SELECT seq, unnest(regexp_extract_all(text, {q(X.CS_ENUM)}, 1)) AS name, unnest(regexp_extract_all(text, {q(X.CS_ENUM)}, 2)) AS body FROM ({CS}) t) SELECT seq, name, array_to_string(list_filter(list_transform(string_split(body, ','), lambda v: trim(string_split(v, '=')[1])), lambda v: regexp_full_match(v, '\w+')), ',') AS members FROM e")
def cs_enums(spark, sf_dir):
    found = X.matches(B.texts(spark, sf_dir, B.CS), X.CS_ENUM, [1, 2], "seq")
    members = F.filter(F.transform(F.split("g2", ","), lambda v: F.trim(F.substring_index(v, "=", 1))), lambda v: v.rlike(r"^\w+$"))
    return found.select("seq", F.col("g1").alias("name"), F.array_join(members, ",").alias("members"))


METHOD_NAME = f"regexp_extract(line, {q(X.CS_METHOD)}, 2)"


@register("cs_methods", f"WITH l AS ({LINES_SQL.format(CS)}), m AS (SELECT seq, line_number, regexp_extract(line, {q(X.CS_METHOD)}, 1) AS return_type, {METHOD_NAME} AS name FROM l WHERE regexp_matches(line, {q(X.CS_METHOD)})) SELECT seq, line_number, return_type, name, {C.BUSINESS_METHOD} AS is_business, {case_sql(C.CATEGORY_RULES, quote('general'))} AS category FROM m WHERE name NOT IN ({', '.join(quote(s) for s in X.SKIP_METHODS)})")
def cs_methods(spark, sf_dir):
    found = X.line_facts(B.texts(spark, sf_dir, B.CS), X.CS_METHOD, [1, 2], "seq").select("seq", "line_number", F.col("g1").alias("return_type"), F.col("g2").alias("name"))
    return C.business_category(found.where(~F.col("name").isin(X.SKIP_METHODS)).withColumn("is_business", C.is_business_method(F.col("name"))))


@register("cs_properties", f"WITH p AS (SELECT seq, unnest(regexp_extract_all(text, {q(X.CS_PROPERTY)}, 1)) AS type, unnest(regexp_extract_all(text, {q(X.CS_PROPERTY)}, 2)) AS name FROM ({CS}) t) SELECT seq, type, name FROM p WHERE regexp_matches(lower(name), {q('|'.join(X.PROPERTY_WORDS))})")
def cs_properties(spark, sf_dir):
    found = X.matches(B.texts(spark, sf_dir, B.CS), X.CS_PROPERTY, [1, 2], "seq")
    return found.where(F.lower("g2").rlike("|".join(X.PROPERTY_WORDS))).select("seq", F.col("g1").alias("type"), F.col("g2").alias("name"))


@register("authorize_rules", rf"""WITH l AS ({LINES_SQL.format(CS)}), w AS (SELECT *, {', '.join(f"lead(line, {k}) OVER (PARTITION BY seq ORDER BY line_number) AS n{k}" for k in range(1, 5))} FROM l), a AS (SELECT seq, line_number, regexp_extract(line, {q(X.CS_AUTHORIZE)}, 1) AS args,
  list_filter([n1, n2, n3, n4], lambda x: x IS NOT NULL AND trim(x) <> '' AND trim(x) NOT LIKE '[%' AND trim(x) NOT LIKE '//%')[1] AS target FROM w WHERE regexp_matches(line, {q(X.CS_AUTHORIZE)}))
  SELECT seq, line_number, args, coalesce(nullif(regexp_extract(target, {q(X.CS_TARGET)}, 1), ''), 'Unknown') AS target, CASE WHEN regexp_matches(args, 'Roles\s*=') THEN 'role' WHEN args <> '' THEN 'policy' ELSE 'authenticated' END AS rule FROM a""")
def authorize_rules(spark, sf_dir):
    by = Window.partitionBy("seq").orderBy("line_number")
    found = X.lines(B.texts(spark, sf_dir, B.CS), "seq").withColumn("next", F.array(*(F.lead("line", k).over(by) for k in range(1, 5)))).where(F.col("line").rlike(X.CS_AUTHORIZE))
    live = F.filter("next", lambda x: x.isNotNull() & (F.trim(x) != "") & ~F.trim(x).startswith("[") & ~F.trim(x).startswith("//"))
    args = F.regexp_extract("line", X.CS_AUTHORIZE, 1)
    rule = F.when(args.rlike(r"Roles\s*="), "role").when(args != "", "policy").otherwise("authenticated")
    return found.select("seq", "line_number", args.alias("args"), F.coalesce(F.nullif(F.regexp_extract(F.get(live, F.lit(0)), X.CS_TARGET, 1), F.lit("")), F.lit("Unknown")).alias("target"), rule.alias("rule"))


@register("method_body", rf"""WITH l AS ({LINES_SQL.format(CS)}), s AS (SELECT seq, line_number AS start FROM l WHERE regexp_matches(line, {q(X.CS_METHOD)})), c AS (SELECT s.seq, s.start, l.line_number AS n, l.line, sum(length(l.line) - length(replace(l.line, '{{', '')) - length(l.line) + length(replace(l.line, '}}', ''))) OVER w AS depth, max(CASE WHEN contains(l.line, '{{') THEN 1 ELSE 0 END) OVER w AS opened FROM s JOIN l ON l.seq = s.seq AND l.line_number BETWEEN s.start AND s.start + 59 WINDOW w AS (PARTITION BY s.seq, s.start ORDER BY l.line_number)),
  e AS (SELECT seq, start, coalesce(min(n) FILTER (WHERE opened = 1 AND depth <= 0), max(n)) AS stop FROM c GROUP BY seq, start) SELECT c.seq, c.start, md5(string_agg(c.line, chr(10) ORDER BY c.n)) AS body_md5 FROM c JOIN e ON e.seq = c.seq AND e.start = c.start AND c.n <= e.stop GROUP BY c.seq, c.start""")
def method_body(spark, sf_dir):
    rows = B.texts(spark, sf_dir, B.CS).withColumn("all", F.split("text", "\n"))
    starts = F.filter(F.transform("all", lambda line, k: F.when(line.rlike(X.CS_METHOD), k + 1)), lambda k: k.isNotNull())
    return rows.select("seq", "all", F.explode(starts).alias("start")).select("seq", F.col("start").cast("long").alias("start"), F.md5(X.body(F.col("all"), F.col("start"))).alias("body_md5"))


@register("ctor_guards", rf"WITH l AS ({LINES_SQL.format(CS)}) SELECT t.seq, regexp_extract(l.line, {q(X.CS_CONSTRUCTOR)}, 1) AS class_name, array_to_string(regexp_extract_all(t.text, {q(X.CS_GUARD)}, 1), ',') AS guards FROM ({CS}) t JOIN l ON l.seq = t.seq AND regexp_matches(l.line, {q(X.CS_CONSTRUCTOR)})")
def ctor_guards(spark, sf_dir):
    rows = B.texts(spark, sf_dir, B.CS).withColumn("all", F.split("text", "\n"))
    starts = F.filter(F.transform("all", lambda line, k: F.when(line.rlike(X.CS_CONSTRUCTOR), k + 1)), lambda k: k.isNotNull())
    found = rows.select("seq", "all", F.explode(starts).alias("start")).select("seq", F.regexp_extract(F.get("all", F.col("start") - 1), X.CS_CONSTRUCTOR, 1).alias("class_name"), F.regexp_extract_all(X.body(F.col("all"), F.col("start")), F.lit(X.CS_GUARD), 1).alias("guards"))
    return found.where(F.size("guards") > 0).select("seq", "class_name", F.array_join("guards", ",").alias("guards"))


@register("js_symbols", "WITH s AS (" + " UNION ALL ".join(f"SELECT seq, {k} AS place, {q(kind)} AS kind, unnest(regexp_extract_all(text, {q(p)}, 1)) AS name FROM ({B.duck(B.JS)}) t" for k, (kind, p) in enumerate(X.JS_PATTERNS)) + ") SELECT seq, kind, name FROM (SELECT *, row_number() OVER (PARTITION BY seq, name ORDER BY place) AS k FROM s) t WHERE k = 1")
def js_symbols(spark, sf_dir):
    rows, found = B.texts(spark, sf_dir, B.JS), None
    for place, (kind, pattern) in enumerate(X.JS_PATTERNS):
        one = X.matches(rows, pattern, [1], "seq").select("seq", F.lit(place).alias("place"), F.lit(kind).alias("kind"), "pos", F.col("g1").alias("name"))
        found = one if found is None else found.unionByName(one)
    return pick(found.where(~F.col("name").isin(X.SKIP_JS)), ["seq", "name"], F.col("place"), F.col("pos")).select("seq", "kind", "name")


@register("java_methods", f"WITH l AS ({LINES_SQL.format(B.duck(B.JAVA))}), m AS (SELECT seq, line_number, regexp_extract(line, {q(X.JAVA_METHOD)}, 2) AS name FROM l WHERE regexp_matches(line, {q(X.JAVA_METHOD)})) SELECT seq, line_number, name, {C.BUSINESS_METHOD} AS is_business FROM m")
def java_methods(spark, sf_dir):
    found = X.line_facts(B.texts(spark, sf_dir, B.JAVA), X.JAVA_METHOD, [2], "seq").where(~F.col("g1").isin(X.SKIP_JAVA))
    return found.select("seq", "line_number", F.col("g1").alias("name"), C.is_business_method(F.col("g1")).alias("is_business"))


@register("ddl_tables", rf"WITH t AS (SELECT seq, regexp_extract(text, {q(X.DDL_TABLE)}, 2) AS table_name, regexp_extract(text, {q(X.DDL_TABLE)}, 3) AS block FROM ({B.duck(B.DDL)}) t), l AS (SELECT seq, table_name, unnest(string_split(block, chr(10))) AS line FROM t) SELECT seq, table_name, regexp_extract(line, {q(X.DDL_COLUMN)}, 1) AS column_name, regexp_extract(line, {q(X.DDL_COLUMN)}, 2) AS column_type, NOT contains(upper(regexp_extract(line, {q(X.DDL_COLUMN)}, 3)), 'NOT') AS nullable, regexp_extract(line, {q(X.DDL_COLUMN)}, 4) <> '' AS is_primary_key FROM l WHERE trim(line) <> '' AND NOT regexp_matches(line, {q(X.DDL_SKIP)}) AND regexp_matches(line, {q(X.DDL_COLUMN)})")
def ddl_tables(spark, sf_dir):
    tables = X.matches(B.texts(spark, sf_dir, B.DDL), X.DDL_TABLE, [2, 3], "seq").select("seq", F.col("g1").alias("table_name"), F.explode(F.split("g2", "\n")).alias("line"))
    part = lambda g: F.regexp_extract("line", X.DDL_COLUMN, g)
    found = tables.where((F.trim("line") != "") & ~F.col("line").rlike(X.DDL_SKIP) & F.col("line").rlike(X.DDL_COLUMN))
    return found.select("seq", "table_name", part(1).alias("column_name"), part(2).alias("column_type"), (~F.contains(F.upper(part(3)), F.lit("NOT"))).alias("nullable"), (part(4) != "").alias("is_primary_key"))


def _union(key, statement, patterns, label):
    """One row a match of each labelled pattern."""

    @register(key, " UNION ALL ".join(f"SELECT seq, {q(kind)} AS {label}, unnest(regexp_extract_all(text, {q(p)}, 1)) AS name FROM ({B.duck(statement)}) t" for kind, p in patterns))
    def plan(spark, sf_dir):
        rows = B.texts(spark, sf_dir, statement)
        labelled = lambda kind: lambda name: F.struct(F.lit(kind).alias(label), name.alias("name"))
        every = F.flatten(F.array(*(F.transform(F.regexp_extract_all("text", F.lit(p), 1), labelled(kind)) for kind, p in patterns)))
        return rows.select("seq", F.inline(every))

    return plan


_union("ddl_objects", B.DDL, X.DDL_OBJECTS, "kind")
_union("ef_entities", B.EF, X.EF_PATTERNS, "kind")
_union("program_routes", B.PROGRAM, [(reason, p) for p, _, reason in X.PROGRAM], "action")
_union("razor_facts", B.RAZOR, [(k, "(?m)" + p) for k, p in X.RAZOR[1:]], "directive")


@register("razor_directives", f"WITH l AS ({LINES_SQL.format(B.duck(B.RAZOR))}) " + " UNION ALL ".join(f"SELECT seq, line_number, {q(k)} AS directive, trim(regexp_extract(line, {q(p)}, 1)) AS value FROM l WHERE regexp_matches(line, {q(p)})" for k, p in X.RAZOR))
def razor_directives(spark, sf_dir):
    found = X.lines(B.texts(spark, sf_dir, B.RAZOR), "seq")
    every = F.array_compact(F.array(*(F.when(F.col("line").rlike(p), F.struct(F.lit(k).alias("directive"), F.trim(F.regexp_extract("line", p, 1)).alias("value"))) for k, p in X.RAZOR)))
    return found.select("seq", "line_number", F.inline(every))


@register("razor_routes", rf"WITH r AS (SELECT seq, path, regexp_extract(text, '^@page(?:\s+\"([^\"]*)\")?', 1) AS route FROM ({B.duck(B.RAZOR)}) t) SELECT seq, CASE WHEN route <> '' THEN CASE WHEN route LIKE '/%' THEN route ELSE concat('/', route) END ELSE concat('/', regexp_replace(regexp_replace(path, '^.*?/Pages/', ''), '(/?Index)?\.razor$', '')) END AS route FROM r")
def razor_routes(spark, sf_dir):
    route = F.regexp_extract("text", r'^@page(?:\s+"([^"]*)")?', 1)
    from_file = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace("path", "^.*?/Pages/", ""), r"(/?Index)?\.razor$", ""))
    return B.texts(spark, sf_dir, B.RAZOR).select("seq", F.when(route == "", from_file).when(route.startswith("/"), route).otherwise(F.concat(F.lit("/"), route)).alias("route"))


@register("attribute_routes", rf"WITH a AS (SELECT seq, regexp_extract(text, 'class\s+(\w+)', 1) AS name, regexp_extract(text, {q(X.ROUTE_ATTRIBUTE)}, 1) AS base, upper(regexp_extract(text, {q(X.HTTP_ATTRIBUTE)}, 1)) AS method, regexp_extract(text, '\[HttpGet\(\"([^\"]*)\"', 1) AS part FROM ({CS}) t) SELECT seq, method, concat('/', replace(base, '[controller]', regexp_replace(name, 'Controller$', '')), '/', regexp_replace(part, '\{{(\w+):[^}}]+\}}', '{{\1}}', 'g')) AS route FROM a")
def attribute_routes(spark, sf_dir):
    part = T.string_literal(F.regexp_extract("text", X.HTTP_ATTRIBUTE, 2))
    name = F.regexp_extract("text", r"class\s+(\w+)", 1)
    return B.texts(spark, sf_dir, B.CS).select("seq", F.upper(F.regexp_extract("text", X.HTTP_ATTRIBUTE, 1)).alias("method"), T.combine_route(F.lit(None).cast("string"), F.regexp_extract("text", X.ROUTE_ATTRIBUTE, 1), part, name, F.lit("Run")).alias("route"))


@register("minimal_routes", rf"""WITH RECURSIVE g AS (SELECT seq, unnest(regexp_extract_all(text, {q(X.GROUP)}, 1)) AS name, unnest(regexp_extract_all(text, {q(X.GROUP)}, 2)) AS parent, unnest(regexp_extract_all(text, {q(X.GROUP)}, 3)) AS part FROM ({PROGRAM}) t),
  p AS (SELECT DISTINCT seq, 'app' AS name, '' AS prefix FROM ({PROGRAM}) t UNION SELECT g.seq, g.name, concat(p.prefix, '/', trim(g.part, '/')) FROM g JOIN p ON p.seq = g.seq AND p.name = g.parent),
  m AS (SELECT seq, unnest(regexp_extract_all(text, {q(X.MAPPED)}, 1)) AS target, upper(unnest(regexp_extract_all(text, {q(X.MAPPED)}, 2))) AS method, unnest(regexp_extract_all(text, {q(X.MAPPED)}, 3)) AS part FROM ({PROGRAM}) t)
  SELECT m.seq, m.method, concat(coalesce(p.prefix, ''), '/', trim(m.part, '/')) AS route FROM m LEFT JOIN p ON p.seq = m.seq AND p.name = m.target""")
def minimal_routes(spark, sf_dir):
    """A group's prefix is its parent's and its own path, whatever the depth: groups are gone through in the order of the text, where parents stand above. No shuffle."""
    trimmed = lambda c: F.regexp_replace(c, "^/+|/+$", "")
    none = F.create_map(F.lit("app"), F.lit(""))

    def step(known, g):
        prefix = F.concat(F.coalesce(known[g["g2"]], F.lit("")), F.lit("/"), trimmed(g["g3"]))
        return F.map_concat(F.map_filter(known, lambda k, _: k != g["g1"]), F.create_map(g["g1"], prefix))

    prefixes = F.aggregate(X.every(F.col("text"), X.GROUP, [1, 2, 3]), none, step)
    rows = B.texts(spark, sf_dir, B.PROGRAM).select("seq", prefixes.alias("known"), F.explode(X.every(F.col("text"), X.MAPPED, [1, 2, 3])).alias("m"))
    return rows.select("seq", F.upper("m.g2").alias("method"), F.concat(F.coalesce(F.col("known")[F.col("m.g1")], F.lit("")), F.lit("/"), trimmed(F.col("m.g3"))).alias("route"))


#: Files with calls of services and clients, by literals and expressions, some twice in a line; those of one folder are a frontend project's.
CALLING_WEB = f"""SELECT seq, path, replace(text, 'return client.', concat('_http.HttpGet<Item>(', CASE seq % 3 WHEN 0 THEN '$"items/x"' WHEN 1 THEN '@"list"' ELSE ' url ' END, '); http.HttpGet(url); other.HttpDelete( key', cast(seq as varchar(20)), ', 1); web.PatchAsync(uri); client.GetAsync(uri); net.GetAsync(uri); return client.')) AS text FROM ({B.CS}) c"""
FRONTEND_FOLDER = "src/PROMO/"
SERVICE_CALL, CLIENT_CALL = (rf"\b([A-Za-z_]\w*)\.{verb}\s*\(\s*([^,)]+)" for verb in (r"Http(Get|Post|Put|Delete)(?:<[^>]+>)?", "(Get|Post|Put|Delete|Patch)Async"))
_web = lambda form, kind, pattern, sure, unsure: f"SELECT seq, path, line_number, {form} AS form, '{kind}' AS kind, {sure}::DOUBLE AS sure, {unsure}::DOUBLE AS unsure, generate_subscripts(regexp_extract_all(line, {q(pattern)}), 1) AS i, " + ", ".join(f"unnest(regexp_extract_all(line, {q(pattern)}, {g})) AS {n}" for g, n in enumerate(("target", "verb", "argument"), 1)) + " FROM l"


@register("api_calls", f"""WITH l AS (SELECT * FROM ({LINES_SQL.replace("seq,", "seq, path,").format(B.duck(CALLING_WEB))}) a WHERE line LIKE '%Http%(%' OR line LIKE '%Async(%'), c AS ({_web(0, "api_call", SERVICE_CALL, 0.78, 0.55)} UNION ALL {_web(1, "http_client_call", CLIENT_CALL, 0.75, 0.5)}),
  s AS (SELECT *, nullif(regexp_extract(argument, '"([^"]+)"', 1), '') AS said FROM c)
  SELECT seq, CASE WHEN path LIKE '{FRONTEND_FOLDER}%' THEN 'frontend_api_call' ELSE s.kind END AS kind, target, upper(verb) AS method, coalesce(said, trim(argument)) AS path, line_number AS line, CASE WHEN said IS NULL THEN unsure ELSE sure END AS confidence
  FROM s QUALIFY row_number() OVER (PARTITION BY seq, CASE WHEN s.path LIKE '{FRONTEND_FOLDER}%' THEN '' ELSE s.kind END, verb, coalesce(said, trim(argument)), line_number ORDER BY form, i) = 1""")
def api_calls(spark, sf_dir):
    """Calls of services and of clients: a literal is surer than an expression, and what a frontend project calls is of a kind of its own."""
    found = Code(B.texts(spark, sf_dir, CALLING_WEB)).http_calls(F.col("path").startswith(FRONTEND_FOLDER))
    return found.select("seq", "kind", "target", "method", F.col("address").alias("path"), "line", "confidence")


#: Files whose methods call what a field, a parameter or a local holds, statics and primitives; every fifth has no public method.
CALLING = f"""SELECT seq, path, replace(CASE WHEN seq % 5 = 0 THEN replace(text, 'public async', 'private async') ELSE text END, '        return client', concat('        var cart = new Cart', cast(seq % 7 as varchar(20)), '(); cart.Fill(a);', chr(10), '        Task.Run(a); Helper.Check(a); a.Round(); Response.Write(a);', chr(10), '        return client')) AS text FROM ({B.CS}) c"""
_names = lambda names: ", ".join(map(quote, names))
_all = lambda text, pattern, *names: ", ".join(f"unnest(regexp_extract_all({text}, {q(pattern)}, {g})) AS {n}" for g, n in enumerate(names, 1))


@register("component_calls", rf"""WITH t AS (SELECT seq, text, regexp_extract(text, 'class (\w+)', 1) AS owner FROM ({B.duck(CALLING)}) c), l AS ({LINES_SQL.format("SELECT seq, text FROM t")}),
  c AS (SELECT seq, line_number AS line, {_all("line", r"\b([A-Za-z_]\w*)\.(\w+)\s*\(", "target", "method")} FROM l WHERE line LIKE '%.%(%'),
  m AS (SELECT seq, text, {_all("text", r"(?s)\n    public (?:async )?[\w<>]+ (\w+)\(([^)]*)\)\n    \{\n(.*?)\n    \}", "member", "given", "body")} FROM t),
  b AS (SELECT seq, member, length(head) - length(replace(head, chr(10), '')) AS above, len(string_split(body, chr(10))) AS lines FROM (SELECT *, text[1:strpos(text, body)] AS head FROM m) h),
  v AS (SELECT seq, NULL AS member, {_all("text", X.FIELD, "type", "target")}, 0 AS near FROM t UNION ALL SELECT seq, member, g[1], g[2], 1 FROM (SELECT seq, member, string_split(trim(unnest(string_split(given, ','))), ' ') AS g FROM m) g
    UNION ALL SELECT seq, member, type, target, 2 FROM (SELECT seq, member, {_all("body", r"(\w+) = new (\w+)", "target", "type")} FROM m) n),
  k AS (SELECT c.*, b.member FROM c LEFT JOIN b ON b.seq = c.seq AND c.line > b.above AND c.line <= b.above + b.lines),
  r AS (SELECT k.seq, k.member, k.line, k.target, k.method, coalesce(arg_max(v.type, v.near), CASE WHEN k.target[1] BETWEEN 'A' AND 'Z' THEN k.target END) AS type FROM k LEFT JOIN v ON v.seq = k.seq AND v.target = k.target AND (v.member IS NULL OR v.member = k.member) GROUP BY k.seq, k.member, k.line, k.target, k.method),
  i AS (SELECT *, member IS NOT NULL AND target NOT IN ({_names([*fixed.IGNORED_STATIC_TARGETS, *fixed.IGNORED_INSTANCE_TARGETS])}) AND type NOT IN ({_names(fixed.PRIMITIVE_TYPES)}) AND NOT regexp_matches(type, '({"|".join(fixed.DTO_SUFFIXES)})$') AS counts FROM r WHERE type IS NOT NULL),
  s AS (SELECT *, bool_or(counts) OVER (PARTITION BY seq) AS scoped FROM i)
  SELECT DISTINCT seq, owner, CASE WHEN counts THEN member END AS source_method, target, type, method, line FROM s JOIN (SELECT seq, owner FROM t) o USING (seq) WHERE counts OR (NOT scoped AND target NOT IN ({_names(fixed.IGNORED_BODY_TARGETS)}) AND (target LIKE '\_%' ESCAPE '\' OR target[1] BETWEEN 'A' AND 'Z'))""")
def component_calls(spark, sf_dir):
    """Calls in each method, by what its locals, parameters and fields hold; those anywhere in the type where no method has one that counts."""
    return Code(B.texts(spark, sf_dir, CALLING)).calls().select("seq", "owner", "source_method", "target", "type", "method", "line")


@register("public_methods", f"WITH l AS ({LINES_SQL.format(CS)}) SELECT seq, regexp_extract(line, {q(X.CS_METHOD)}, 2) AS name FROM l WHERE regexp_matches(line, {q(X.CS_METHOD)}) AND trim(line) LIKE 'public%' UNION SELECT seq, regexp_extract(line, '^\\s+int (\\w+)\\(', 1) FROM l WHERE regexp_matches(line, '^\\s+int (\\w+)\\([^)]*\\);')")
def public_methods(spark, sf_dir):
    """Public methods and what interfaces declare, each name of a file once; one pass over the lines."""
    member = r"^\s+int (\w+)\([^)]*\);"
    line = F.col("line")
    public = F.when(line.rlike(X.CS_METHOD) & F.trim(line).startswith("public"), F.regexp_extract(line, X.CS_METHOD, 2))
    declared = F.when(line.rlike(member), F.regexp_extract(line, member, 1))
    rows = X.lines(B.texts(spark, sf_dir, B.CS), "seq")
    return rows.select("seq", F.explode(F.array_compact(F.array(public, declared))).alias("name")).distinct()


@register("page_links", r"SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href=\"([^\"]+)\"', 1)) AS href FROM pages")
def page_links(spark, sf_dir):
    return X.matches(B.source(spark, sf_dir, "SELECT page_id, html AS text FROM <<pages>>"), '<a [^>]*href="([^"]+)"', [1], "page_id").select("page_id", F.col("g1").alias("href"))


@register("open_questions", "WITH l AS (SELECT doc_id, unnest(string_split(concat('- ask ', lang, chr(10), text), chr(10))) AS line FROM documents) SELECT doc_id, substring(line, 3) AS question FROM l WHERE line LIKE '- %'")
def open_questions(spark, sf_dir):
    rows = B.source(spark, sf_dir, "SELECT doc_id, concat('- ask ', lang, chr(10), text) AS text FROM <<documents>>")
    return X.lines(rows, "doc_id").where(F.col("line").startswith("- ")).select("doc_id", F.substr("line", F.lit(3)).alias("question"))


# --- modules by tokens and by fallback ---
#: Components whose names say something of a domain, by their number.
GUESSED = "SELECT seq, concat(CASE seq % 13 WHEN 0 THEN 'Products' WHEN 1 THEN 'Checkout' WHEN 2 THEN 'BuyerAggregate' WHEN 3 THEN 'LoginPage' WHEN 4 THEN 'BlazorAdmin' WHEN 5 THEN 'SharedPart' WHEN 6 THEN 'OrderBasket' WHEN 7 THEN 'Ordering' ELSE '' END, name) AS name, file, concat('App.', project) AS namespace, component_type FROM ({}) c"
_any = lambda words: f"arrays_overlap(tokens, array({', '.join(map(quote, words))}))"
GUESS_RULES = [
    ("file LIKE 'tests/%'", ("Verification", 0.9)), *((_any(words), (module, 0.88)) for module, words in fixed.SEMANTIC_MODULES.items()), (f"contains(lower(file), 'infrastructure') AND {_any(fixed.DATA_ACCESS_WORDS)}", ("DataAccess", 0.84)), ("contains(lower(file), 'infrastructure')", ("Infrastructure", 0.78)),
    ("component_type IN ('Configuration', 'Middleware')", ("CrossCutting", 0.72)), ("root = 'Web'", ("Web", 0.68)), ("root = 'PublicApi'", ("PublicApi", 0.68)), ("root = 'ApplicationCore'", ("ApplicationCore", 0.68)), ("root = 'BlazorShared'", ("SharedContracts", 0.76)), ("root = 'BlazorAdmin'", ("Admin", 0.76)),
]


def guess_module(rows: DataFrame) -> DataFrame:
    """``rows`` (name, namespace, file, component_type) with module and confidence; null where nothing tells."""
    parts = F.split("file", "/")
    rows = rows.withColumn("tokens", T.identifier_tokens(F.concat_ws(" ", "name", "namespace", "file"))).withColumn("root", F.when(parts[0].isin("src", "tests"), F.get(parts, F.lit(1))))
    module, sure = (case_sql([(rule, quote(said[0]) if k == 0 else f"cast({said[1]} as double)") for rule, said in GUESS_RULES]) for k in (0, 1))
    return rows.withColumns({"module": F.expr(module), "confidence": F.expr(sure)}).drop("tokens", "root")


@register("module_guess", f"""SELECT seq, CASE WHEN starts_with(file, 'tests/') THEN 'Verification' WHEN seq % 13 = 0 OR file LIKE '%/CatalogEndpoints/%' THEN 'Catalog' WHEN seq % 13 IN (1, 6) THEN 'Basket' WHEN seq % 13 = 2 THEN 'Order' WHEN seq % 13 = 3 THEN 'Identity' WHEN seq % 13 = 4 THEN 'Admin' WHEN seq % 13 = 5 THEN 'SharedContracts'
  WHEN file LIKE 'src/Infrastructure/Data/%' THEN 'DataAccess' WHEN component_type = 'Configuration' THEN 'CrossCutting' WHEN file LIKE 'src/Web/%' THEN 'Web' WHEN file LIKE 'src/ApplicationCore/%' THEN 'ApplicationCore' END AS module,
  CASE WHEN starts_with(file, 'tests/') THEN 0.9 WHEN seq % 13 <= 6 OR file LIKE '%/CatalogEndpoints/%' THEN 0.88 WHEN file LIKE 'src/Infrastructure/Data/%' THEN 0.84 WHEN component_type = 'Configuration' THEN 0.72 WHEN file LIKE 'src/Web/%' OR file LIKE 'src/ApplicationCore/%' THEN 0.68 END::DOUBLE AS confidence FROM ({COMP}) t""")
def module_guess(spark, sf_dir):
    return guess_module(B.source(spark, sf_dir, GUESSED.format(B.COMPONENTS))).select("seq", "module", "confidence")


def _clean_sql(value: str) -> str:
    inner = f"trim(regexp_replace(trim(regexp_replace({value}, {q(fixed.GENERIC_SUFFIX)}, ''), '_-. '), {q(fixed.GENERIC_VERB)}, '\\3'), '_-. ')"
    return f"CASE WHEN length({inner}) >= 3 AND lower({inner}) NOT IN ({', '.join(quote(f) for f in fixed.GENERIC_FOLDERS)}) THEN concat(upper(substring({inner}, 1, 1)), substring({inner}, 2)) END"


def clean_module(value):
    """A module name from a component or folder name, or null if nothing of its own is left."""
    strip = lambda c: F.regexp_replace(c, "^[_\\-. ]+|[_\\-. ]+$", "")
    bare = strip(F.regexp_replace(strip(F.regexp_replace(value, fixed.GENERIC_SUFFIX, "")), fixed.GENERIC_VERB, "$3"))
    return F.when((F.length(bare) >= 3) & ~F.lower(bare).isin(fixed.GENERIC_FOLDERS), F.concat(F.upper(F.substr(bare, F.lit(1), F.lit(1))), F.substr(bare, F.lit(2))))


FALLBACK = "SELECT seq, CASE WHEN seq % 3 = 0 THEN component_type ELSE name END AS name, file FROM ({}) c"


@register("module_fallback", f"WITH r AS ({FALLBACK.format(COMP)}), p AS (SELECT seq, name, list_reverse(string_split(file, '/')[:-2]) AS parts FROM r) SELECT seq, coalesce({_clean_sql('name')}, list_filter(list_transform(parts, lambda x: {_clean_sql('x')}), lambda x: x IS NOT NULL)[1], 'Unknown') AS module, cast(CASE WHEN {_clean_sql('name')} IS NOT NULL THEN 0.72 WHEN len(list_filter(list_transform(parts, lambda x: {_clean_sql('x')}), lambda x: x IS NOT NULL)) > 0 THEN 0.7 ELSE 0.3 END AS DOUBLE) AS confidence FROM p")
def module_fallback(spark, sf_dir):
    rows = B.source(spark, sf_dir, FALLBACK.format(B.COMPONENTS))
    parts = F.split("file", "/")
    folders = F.reverse(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))
    from_folder = F.get(F.filter(F.transform(folders, clean_module), lambda x: x.isNotNull()), F.lit(0))
    found = rows.select("seq", clean_module(F.col("name")).alias("own"), from_folder.alias("near"))
    return found.select("seq", F.coalesce("own", "near", F.lit("Unknown")).alias("module"), F.when(F.col("own").isNotNull(), 0.72).when(F.col("near").isNotNull(), 0.7).otherwise(0.3).alias("confidence"))
