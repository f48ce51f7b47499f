"""Scalar text functions, as Columns over built-in functions.

A null text gives null unless stated; empty texts give what the definition gives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions import fixed


def normalize_newlines(text: Column) -> Column:
    """CRLF and CR become LF; white space at line ends goes."""
    return F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"(?m)[ \t]+$", "")


def line_number(text: Column, offset: Column) -> Column:
    """The line (from 1) of a character offset (from 0)."""
    before = F.substr(text, F.lit(1), offset)
    return (F.length(before) - F.length(F.replace(before, F.lit("\n"))) + 1).cast("long")


def line_count(text: Column) -> Column:
    """Lines as split at any newline; a newline at the end opens no line; none in an empty text."""
    parts = F.size(F.split(text, r"\r\n|\n|\r"))
    return F.when(F.length(text) == 0, 0).otherwise(parts - F.when(text.rlike(r"[\r\n]\z"), 1).otherwise(0)).cast("long")


def identifier_tokens(name: Column) -> Column:
    """Lower-case words of a camel-case or delimited identifier."""
    spaced = F.regexp_replace(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1 $2"), "[^A-Za-z0-9]+", " ")
    return F.filter(F.split(F.lower(F.trim(spaced)), " +"), lambda w: w != "")


def capability_tokens(name: Column) -> Column:
    """Words of at least 3 characters that say something of the domain, first letter raised."""
    spaced = F.regexp_replace(F.regexp_replace(name, r"[_\-/.]+", " "), "([A-Z]+)([A-Z][a-z])", "$1 $2")
    words = F.regexp_extract_all(spaced, F.lit(r"([A-Z]?[a-z]+|[A-Z]+|\d+)"), 1)
    kept = F.filter(words, lambda w: (F.length(w) >= 3) & ~F.lower(w).isin(fixed.GENERIC_TOKENS))
    return F.transform(kept, lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2))))


def simple_type(name: Column) -> Column:
    """A type name without modifiers, nullable marks, arguments, generics and namespace."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(name), r"\s+", " "), r"^(in|out|ref|params) ", "")
    plain = F.replace(F.replace(plain, F.lit("?")), F.lit("global::"))
    return F.substring_index(F.regexp_replace(plain, r"[<(].*$", ""), ".", -1)


def string_literal(text: Column) -> Column:
    """The first string literal, plain, verbatim or interpolated; null without one."""
    found = F.regexp_extract(text, '[$@]*"([^"]+)"', 1)
    return F.when(found != "", found)


def combine_route(area: Column, base: Column, method: Column, controller: Column, action: Column) -> Column:
    """A route from its parts, with tokens and parameter constraints resolved."""
    strip = lambda c: F.nullif(F.regexp_replace(c, "^/+|/+$", ""), F.lit(""))
    bare = F.regexp_replace(controller, "Controller$", "")
    joined = F.concat_ws("/", strip(area), strip(base), strip(method))
    joined = F.when(joined == "", F.concat(bare, F.lit("/"), action)).otherwise(joined)
    named = F.replace(F.replace(F.replace(joined, F.lit("[controller]"), bare), F.lit("[action]"), action), F.lit("[area]"), F.coalesce(area, F.lit("")))
    plain = F.regexp_replace(named, r"\{([A-Za-z_][A-Za-z0-9_]*):[^}]+\}", "{$1}")
    return F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(plain, "/+", "/"), "^/|/$", ""))


def folder(path: Column, depth: int) -> Column:
    return F.array_join(F.slice(F.split(path, "/"), 1, depth), "/")


def short_list(values: Column, limit: int = 8) -> Column:
    """The first values and how many more there are."""
    shown = F.array_join(F.slice(values, 1, limit), ", ")
    return F.when(F.size(values) == 0, "none detected").when(F.size(values) > limit, F.concat(shown, F.lit(", and "), (F.size(values) - limit).cast("string"), F.lit(" more"))).otherwise(shown)


def table_escape(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def safe_name(value: Column, length: int = 20) -> Column:
    return F.substring(F.regexp_replace(value, "[^A-Za-z0-9_-]", "_"), 1, length)


def node_id(value: Column) -> Column:
    """A diagram node's name: word characters, at most 80, not led by a digit."""
    plain = F.substring(F.regexp_replace(value, "[^A-Za-z0-9_]", "_"), 1, 80)
    return F.when(plain.rlike("^[0-9]") | (plain == ""), F.concat(F.lit("N_"), plain)).otherwise(plain)


def binary_share(content: Column) -> Column:
    """The share of bytes of the first 4096 that no plain text has."""
    sample = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    odd = F.regexp_replace(sample, r"[\x20-\x7E\n\r\t\f\x08]", "")
    return F.when(F.length(sample) == 0, 0.0).otherwise(F.length(odd).cast("double") / F.length(sample))


def looks_binary(content: Column) -> Column:
    """A NUL byte anywhere, or more than 30 % odd bytes in the sample."""
    return F.coalesce(F.instr(F.decode(content, "ISO-8859-1"), "\0") > 0, F.lit(False)) | (binary_share(content) > 0.30)


URL_FORM = r"(?i)^(postgresql|postgres|mysql|sqlite)(?:\+\w+)?://(?:[^:@/]*(?::[^@/]*)?@)?([^/:]+)(?::(\d+))?(?:/(\w+))?"


def connection_string(value: Column) -> Column:
    """struct(vendor, host, port, database) of a connection string in URL, file or key=value form; all null for anything else."""
    value = F.trim(value)
    named = lambda g: F.nullif(F.regexp_extract(value, URL_FORM, g), F.lit(""))
    scheme = F.lower(named(1))
    url_vendor = F.when(scheme.startswith("postgres"), "postgresql").otherwise(scheme)
    is_file = value.rlike(r"(?i)[.](db|sqlite|sqlite3)") | F.lower(value).contains("sqlite")
    pairs = F.map_filter(F.transform_values(F.transform_keys(F.str_to_map(value, F.lit(";"), F.lit("=")), lambda k, v: F.lower(F.trim(k))), lambda k, v: F.nullif(F.trim(v), F.lit(""))), lambda k, v: v.isNotNull())
    pick = lambda *names: F.coalesce(*(F.try_element_at(pairs, F.lit(n)) for n in names))
    has = lambda n: F.map_contains_key(pairs, n)
    vendor = F.when(has("initial catalog") | (has("server") & ~has("uid") & ~has("host")), "sqlserver").when(has("uid"), "mysql").when(has("host"), "postgresql").when(F.size(pairs) > 0, "sqlserver")
    default = F.create_map(*(F.lit(x) for x in ("postgresql", "5432", "mysql", "3306", "sqlserver", "1433")))
    by_pair = F.struct(vendor.alias("vendor"), F.when(vendor.isNotNull(), F.coalesce(pick("server", "data source", "host"), F.lit("localhost"))).alias("host"), F.coalesce(pick("port"), default[vendor]).alias("port"), pick("database", "initial catalog", "dbname").alias("database"))
    by_url = F.struct(url_vendor.alias("vendor"), named(2).alias("host"), F.coalesce(named(3), F.when(url_vendor == "postgresql", "5432").otherwise("3306")).alias("port"), named(4).alias("database"))
    none = F.lit(None).cast("string")
    by_file = F.struct(F.lit("sqlite").alias("vendor"), none.alias("host"), none.alias("port"), F.coalesce(pick("data source"), value).alias("database"))
    return F.when(scheme.isNotNull(), by_url).when(is_file, by_file).otherwise(by_pair)


def fenced_json(text: Column) -> Column:
    """The JSON of a ```json block, else of any ``` block, else of the whole text; null if none parses."""
    block = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    tried = [block(r"(?s)```json\s*\n(.*?)```"), block(r"(?s)```[a-z]*\s*\n(.*?)```"), text]
    valid = [F.when(F.try_parse_json(t).isNotNull(), F.trim(F.regexp_replace(t, r"\s+$", ""))) for t in tried]
    return F.coalesce(*valid)
