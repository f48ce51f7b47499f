"""Facts from source text, by regular expressions over whole texts or single lines.

Patterns use numbered groups and no look-around, so they read alike in Java and RE2. A null or
empty text gives no fact. All extraction stays in built-in functions: no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of declarations and calls.
MODIFIERS = "public|private|protected|internal|static|virtual|override|abstract|async|sealed|new|extern|readonly|partial"
CS_CLASS = r"\b(class|struct)\s+(\w+)"
CS_INTERFACE = r"\binterface\s+(\w+)"
CS_ENUM = r"\benum\s+(\w+)\s*\{([^}]+)\}"
CS_METHOD = rf"^\s*(?:(?:{MODIFIERS})\s+)+([\w<>\[\]?,\.]+)\s+(\w+)\s*(?:<[^>]*>)?\s*\("
CS_PROPERTY = r"(?:public|private|protected|internal|static|virtual|override)\s+(?:readonly\s+)?([\w<>\[\]?,\.]+)\s+(\w+)\s*\{[^}]*(?:get|set)"
CS_AUTHORIZE = r"\[Authorize(?:\(([^)]*)\))?\]"
CS_TARGET = r"\b([A-Z]\w+)\s*(?:<[^>]*>)?\s*[\(:{]"
CS_GUARD = r"Guard\.Against\.(\w+)\("
CS_CONSTRUCTOR = r"^\s*(?:public|protected|internal)\s+(\w+)\s*\("
PROPERTY_WORDS = "status state type amount price discount total quantity count limit threshold rate flag enabled active approved rejected pending balance credit tax fee".split()
SKIP_METHODS = "if else while for foreach switch catch using lock try finally return new throw await yield var void int string bool get set".split()
SKIP_JAVA = "if while for switch catch try finally return new throw".split()
SKIP_JS = "if while for switch catch then map filter reduce forEach find".split()
SERVICE_SUFFIX = "(Service|Manager|Handler|Controller|Processor|Repository|Factory|Builder|Validator|Calculator|Orchestrator)$"
JAVA_TYPE = r"\b(class|interface|enum)\s+(\w+)"
JAVA_METHOD = r"^\s*(?:public|private|protected)\s+(?:static\s+|final\s+)*([\w<>\[\]]+)\s+(\w+)\s*\("
JS_PATTERNS = [("function", r"function\s+(\w+)\s*\([^)]*\)\s*\{"), ("function", r"(?:const|let|var)\s+(\w+)\s*=\s*(?:async\s+)?(?:function\s*\([^)]*\)|\([^)]*\)\s*=>)"), ("function", r"(\w+)\s*:\s*(?:async\s+)?function\s*\([^)]*\)\s*\{"), ("class", r"class\s+(\w+)")]
INJECT_PROPERTY = r"\[Inject\]\s*public\s+([A-Za-z_][A-Za-z0-9_<>,\.\?]*)\s+([A-Za-z_][A-Za-z0-9_]*)\s*\{"
FIELD = r"private\s+(?:readonly\s+)?([A-Za-z_][A-Za-z0-9_<>,\.\?]*)\s+(_[A-Za-z_][A-Za-z0-9_]*)\s*;"
SEND = r"\b([A-Za-z_][A-Za-z0-9_]*)\.Send\s*\(\s*(?:new\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*\("
HTTP_ATTRIBUTE = r"\[Http(Get|Post|Put|Patch|Delete)(?:\(([^)]*)\))?\]"
ROUTE_ATTRIBUTE = r"\[Route\(\"([^\"]*)\"\)\]"
GROUP = r"\b([A-Za-z_]\w*)\s*=\s*([A-Za-z_]\w*)\.MapGroup\s*\(\s*\$?@?\"([^\"]+)\""
MAPPED = r"\b([A-Za-z_]\w*)\.Map(Get|Post|Put|Patch|Delete)\s*\(\s*\$?@?\"([^\"]+)\""
DI_GENERIC = r"\.Add(Scoped|Transient|Singleton|DbContext|HostedService)<([A-Za-z0-9_]+)(?:\s*,\s*([A-Za-z0-9_]+))?>"
DI_TYPEOF = r"\bservices\.Add(Scoped|Transient|Singleton)\s*\(\s*typeof\(([^)]+)\)\s*,\s*typeof\(([^)]+)\)"
PROGRAM = [
    (r"\bapp\.MapControllerRoute\s*\(\s*\"[^\"]+\"\s*,\s*\"([^\"]+)\"", "HTTP_API", "ASP.NET conventional MVC route"), (r"\bapp\.(MapRazorPages)\s*\(", "HTTP_API", "ASP.NET Razor Pages route registration"),
    (r"\bapp\.(MapControllers)\s*\(", "HTTP_API", "ASP.NET controller route registration"), (r"\bapp\.(MapEndpoints)\s*\(", "HTTP_API", "MinimalApi.Endpoint route registration"),
    (r"\bapp\.MapFallbackToFile\s*\(\s*\"([^\"]+)\"", "FrontendRoute", "SPA fallback route"), (r"\bapp\.MapHealthChecks\s*\(\s*\"([^\"]+)\"", "HTTP_API", "ASP.NET health check route"),
]
DDL_TABLE = r"(?is)CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(?:\[?(\w+)\]?\.)?\[?(\w+)\]?\s*\(([^;]+)\)\s*;"
DDL_OBJECTS = [("procedure", r"(?i)CREATE\s+(?:OR\s+(?:ALTER|REPLACE)\s+)?PROC(?:EDURE)?\s+(?:\[?\w+\]?\.)?\[?(\w+)\]?"), ("view", r"(?i)CREATE\s+(?:OR\s+(?:ALTER|REPLACE)\s+)?VIEW\s+(?:\[?\w+\]?\.)?\[?(\w+)\]?\s+AS"), ("trigger", r"(?i)CREATE\s+(?:OR\s+(?:ALTER|REPLACE)\s+)?TRIGGER\s+(?:\[?\w+\]?\.)?\[?(\w+)\]?\s+ON"), ("foreign_key", r"(?is)FOREIGN\s+KEY\s*\([^)]*\)\s*REFERENCES\s+\[?(\w+)\]?")]
DDL_COLUMN = r"(?i)^\s*\[?(\w+)\]?\s+(\w+(?:\(\d+(?:,\s*\d+)?\))?)(\s+NOT\s+NULL|\s+NULL)?(\s+PRIMARY\s+KEY|\s+IDENTITY)?"
DDL_SKIP = r"(?i)^\s*(CONSTRAINT|PRIMARY|FOREIGN|UNIQUE|CHECK|INDEX|KEY)"
EF_PATTERNS = [("db_set", r"DbSet<(\w+)>"), ("entity", r"modelBuilder\.Entity<(\w+)>"), ("table", r"\[Table\(\"(\w+)\"\)\]")]
RAZOR = [("page", r"^@page(?:\s+\"?([^\"]*)\"?)?"), ("inject", r"^@inject\s+([A-Za-z_][A-Za-z0-9_.<>]*)\s+[A-Za-z_]"), ("inherits", r"^@inherits\s+(.+)"), ("attribute", r"^@attribute\s+(.+)")]
MARKER = r"(?s)===[A-Z_]*(?:FILE|DOCUMENT)_START:([^=\n]+)===(.*?)===[A-Z_]*(?:FILE|DOCUMENT)_END==="
NAMESPACE = r"namespace\s+([\w\.]+)"


def every(text: Column, pattern: str, groups: list[int]) -> Column:
    """All matches as an array of structs g1, g2, ..., one field a group asked for."""
    parts = [F.regexp_extract_all(text, F.lit(pattern), g).alias(f"g{k}") for k, g in enumerate(groups, 1)]
    return F.arrays_zip(*parts)


def matches(rows: DataFrame, pattern: str, groups: list[int], *keys: str, text: str = "text") -> DataFrame:
    """One row a match: ``keys``, ``pos`` (from 0) and g1, g2, ..."""
    found = rows.select(*keys, F.posexplode(every(F.col(text), pattern, groups)).alias("pos", "m"))
    return found.select(*keys, "pos", *(F.col(f"m.g{k}").alias(f"g{k}") for k in range(1, len(groups) + 1)))


def lines(rows: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """One row a line: ``keys``, ``line_number`` (from 1), ``line``."""
    split = F.posexplode(F.split(text, "\n")).alias("at", "line")
    return rows.select(*keys, split).select(*keys, (F.col("at") + 1).cast("long").alias("line_number"), "line")


def line_facts(rows: DataFrame, pattern: str, groups: list[int], *keys: str) -> DataFrame:
    """One row a matching line, with its number and groups."""
    found = lines(rows, *keys).where(F.col("line").rlike(pattern))
    return found.select(*keys, "line_number", "line", *(F.regexp_extract("line", pattern, g).alias(f"g{k}") for k, g in enumerate(groups, 1)))


def body(all_lines: Column, start: Column, limit: int = 60) -> Column:
    """Lines from ``start`` (from 1) to the one that closes the first brace, at most ``limit``."""
    window = F.slice(all_lines, start, limit)
    count = lambda line, c: F.length(line) - F.length(F.replace(line, F.lit(c)))
    first = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("opened"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

    def step(acc, line):
        depth = acc["depth"] + count(line, "{") - count(line, "}")
        opened = acc["opened"] | F.contains(line, F.lit("{"))
        return F.when(acc["done"], acc).otherwise(F.struct(depth.alias("depth"), opened.alias("opened"), (opened & (depth <= 0)).alias("done"), F.concat(acc["kept"], F.array(line)).alias("kept")))

    return F.array_join(F.aggregate(window, first, step)["kept"], "\n")
