"""Sources: trees of files, structured files and logs as tables; sinks for fact tables.

Scans use Spark's ``binaryFile`` and ``text`` readers, so listing and reading are distributed
and any store that Spark reads will do. Formats that Spark cannot parse go through Arrow-batched
Python; a file that fails to parse gives no rows of facts and one row with its error.
"""

from __future__ import annotations

import json
import os
import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import fixed
from lodestrata.functions.text import line_count, looks_binary
from lodestrata.operators import classify
from lodestrata.sources import archives

REPOSITORY_URL = re.compile(r"^(?:https?://|git@|ssh://git@)[\w.@:/~-]+$")


def resolve_source(source: str) -> dict[str, str]:
    """``local_path, source_type, original_source`` of a directory or a zip; URLs are named, not fetched.

    A zip is not unpacked: its path is that of the archive, ``!/`` and the one folder at its root, if there is one. ``scan``
    reads both kinds. An archive with an unsafe path, and anything else, raises ValueError."""
    if os.path.isdir(source):
        return {"local_path": source, "source_type": "directory", "original_source": source}
    if source.lower().endswith(".zip") and ("://" in source or os.path.isfile(source)):
        return {"local_path": f"{source}!/{archives.single_root(source)}", "source_type": "zip", "original_source": source}
    if REPOSITORY_URL.match(source) and "/" in source:
        raise ValueError(f"{source} must be cloned first: this engine has no network")
    raise ValueError(f"no such source: {source}")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """``path, name, folder, suffix, lower_*, size_bytes, content`` of every file under ``root``, recursively.

    ``root`` is a folder, or a folder in an archive as ``resolve_source`` names it. Empty files are not listed; they hold no facts."""
    if "!/" in root or root.lower().endswith(".zip"):
        archive, _, inner = root.partition("!/")
        archives.register(spark)
        rows = spark.read.format("zip_entries").option("root", inner).load(archive).where("length > 0").select("path", F.col("length").alias("size_bytes"), "content")
        return with_names(rows.withColumn("name", F.substring_index("path", "/", -1)))
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/") + "/"
    path = F.regexp_replace(F.col("path"), "^file:/*", "/")
    relative = F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(path)
    rows = rows.select(relative.alias("path"), F.col("length").alias("size_bytes"), "content")
    name = F.substring_index("path", "/", -1)
    return with_names(rows.withColumn("name", name))


def with_names(rows: DataFrame) -> DataFrame:
    """Adds folder, suffix and lower-cased forms to ``path`` and ``name``."""
    folder = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
    suffix = F.regexp_extract("name", r"(\.[^.]*)$", 1)
    return rows.withColumns({"folder": folder, "suffix": suffix, "lower_path": F.lower("path"), "lower_name": F.lower("name"), "lower_folder": F.lower(folder)})


def source_files(files: DataFrame, include_tests: bool = False) -> DataFrame:
    """Files that the first layer keeps."""
    keep = classify.KEEP_FILE
    if include_tests:
        keep = keep.replace(" AND NOT " + classify.contains_any("lower_folder", fixed.TEST_FRAGMENTS), "")
    return files.where(keep)


def inventory(files: DataFrame) -> DataFrame:
    """Every file with language, candidate type, line count, hash and the reason why it is ignored, if so."""
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return files.select(
        "path", F.col("suffix").alias("extension"), F.expr(classify.INVENTORY_LANGUAGE).alias("language"), "size_bytes", F.when(~looks_binary(F.col("content")), line_count(text)).alias("line_count"),
        F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("hash"), classify.column(classify.CANDIDATE_RULES, "'unknown'").alias("candidate_type"), classify.column(classify.IGNORE_RULES).alias("ignore_reason"),
    ).withColumn("ignored", F.col("ignore_reason").isNotNull())


def text_of(content: Column, replace: bool = True) -> Column:
    """Bytes as text; bad UTF-8 becomes U+FFFD, or goes if not ``replace``."""
    text = F.make_valid_utf8(content.cast("string"))
    return text if replace else F.replace(text, F.lit("\ufffd"))


def key_values(files: DataFrame, quoted: bool = False) -> DataFrame:
    """(path, line_number, key, value) of .env and .properties files (path, text): split at the first ``=``."""
    rows = files.select("path", F.posexplode(F.split("text", "\r?\n")).alias("at", "line"))
    rows = rows.where((F.trim("line") != "") & ~F.trim("line").startswith("#") & F.contains("line", F.lit("=")))
    value = F.trim(F.substr("line", F.instr("line", "=") + 1))
    if quoted:
        value = F.regexp_replace(value, "^[\"']+|[\"']+$", "")
    return rows.select("path", (F.col("at") + 1).cast("long").alias("line_number"), F.trim(F.substring_index("line", "=", 1)).alias("key"), value.alias("value"))


def solution_projects(files: DataFrame) -> DataFrame:
    """(path, name, project) of .sln files (path, text); backslashes become slashes."""
    pattern = F.lit(r'Project\("[^"]*"\)\s*=\s*"([^"]+)",\s*"([^"]+)"')
    both = F.arrays_zip(F.regexp_extract_all("text", pattern, 1).alias("name"), F.regexp_extract_all("text", pattern, 2).alias("project"))
    return files.select("path", F.inline(both)).withColumn("project", F.replace("project", F.lit("\\"), F.lit("/")))


def packages(files: DataFrame) -> DataFrame:
    """(path, framework, packages, confidence) of package.json files (path, text); broken JSON gives confidence 0.2."""
    kind = "struct<name:string,dependencies:map<string,string>,devDependencies:map<string,string>>"
    none = F.create_map().cast("map<string,string>")
    rows = files.withColumn("j", F.from_json("text", kind)).withColumn("broken", F.try_parse_json("text").isNull())
    names = F.array_sort(F.array_union(F.map_keys(F.coalesce("j.dependencies", none)), F.map_keys(F.coalesce("j.devDependencies", none))))
    first = F.coalesce(*(F.when(F.array_contains("packages", p), label) for p, label in (("react", "React"), ("@angular/core", "Angular"), ("vue", "Vue"), ("vite", "Vite"))), F.lit("unknown"))
    rows = rows.withColumn("packages", names).withColumn("framework", first)
    return rows.select("path", "framework", "packages", F.when(F.col("broken"), 0.2).when(F.col("framework") == "unknown", 0.75).otherwise(0.9).alias("confidence"))


PARAMS = "path string, key string, value string, error string"


def _walk(value, prefix: str):
    if isinstance(value, dict):
        for k, v in value.items():
            yield from _walk(v, f"{prefix}.{k}" if prefix else str(k))
    elif isinstance(value, list):
        for k, v in enumerate(value):
            yield from _walk(v, f"{prefix}[{k}]")
    else:
        yield prefix, "" if value is None else str(value)


def _xml(text: str):
    """Every ``<add>`` with a key or name, once."""
    for node in ET.fromstring(text).iter():
        if node.tag.rpartition("}")[2] == "add":
            key = node.get("key") or node.get("name")
            if key:
                yield key, node.get("value") or node.get("connectionString") or ""


def _yaml(text: str):
    """``yaml.safe_load``, by libyaml's parser where that is built in; what libyaml refuses, the parser in Python decides."""
    import yaml

    fast = getattr(yaml, "CSafeLoader", None)
    if fast:
        try:
            return yaml.load(text, Loader=fast)  # a safe loader
        except yaml.YAMLError:
            pass
    return yaml.safe_load(text)


def _parse(kind: str, text: str):
    if kind == "json":
        yield from _walk(json.loads(text), "")
    elif kind == "xml":
        yield from _xml(text)
    elif kind == "yaml":
        loaded = _yaml(text)
        if isinstance(loaded, dict):
            yield from _walk(loaded, "")


def _redacted(key: str, value: str) -> str:
    plain = key.lower().replace("_", "").replace("-", "")
    return fixed.REDACTED if any(word in plain for word in fixed.SENSITIVE) else value


def parameters(files: DataFrame) -> DataFrame:
    """``path, key, value, error`` of configuration files (path, format, text): json, xml and yaml of any depth.

    Sensitive values are redacted before they leave the parser."""

    def run(batches):
        for frame in batches:
            rows = []
            for path, kind, text in zip(frame["path"], frame["format"], frame["text"], strict=True):
                try:
                    rows += [(path, k, _redacted(k, v), None) for k, v in _parse(kind, text or "")]
                except Exception as error:  # one broken file must not end the job; its row says why
                    rows.append((path, None, None, type(error).__name__))
            yield type(frame)(rows, columns=["path", "key", "value", "error"])

    return files.where("format IN ('json', 'xml', 'yaml')").select("path", "format", "text").mapInPandas(run, PARAMS)


PROJECT = "path string, sdk string, frameworks array<string>, packages array<string>, project_references array<string>, output_type string, error string"


def project_files(files: DataFrame) -> DataFrame:
    """What .csproj files (path, text) declare, whatever their XML namespace."""

    def run(batches):
        for frame in batches:
            rows = []
            for path, text in zip(frame["path"], frame["text"], strict=True):
                try:
                    root = ET.fromstring(text)
                    named = lambda tag, root=root: [n for n in root.iter() if n.tag.rpartition("}")[2] == tag]
                    frameworks = [f for tag in ("TargetFramework", "TargetFrameworks") for n in named(tag) for f in (n.text or "").split(";") if f]
                    include = lambda tag, named=named: sorted({n.get("Include", "").replace("\\", "/") for n in named(tag)} - {""})
                    kind = next((n.text for n in named("OutputType")), None)
                    rows.append((path, root.get("Sdk") or "", frameworks, include("PackageReference"), include("ProjectReference"), kind, None))
                except ET.ParseError as error:
                    rows.append((path, None, [], [], [], None, type(error).__name__))
            yield type(frame)(rows, columns=[c.split()[0] for c in PROJECT.split(", ")])

    return files.select("path", "text").mapInPandas(run, PROJECT)


@dataclass
class Contract:
    """What a table must hold: columns, rows, keys that are never null, columns whose texts are JSON."""

    name: str
    table: DataFrame
    required: list[str]
    keys: list[str] = field(default_factory=list)
    json: list[str] = field(default_factory=list)

    def missing(self) -> list[str]:
        return [c for c in self.required if c not in self.table.columns]

    def measures(self) -> list[Column]:
        """Rows, rows without each key, and rows of each column that are no JSON: what one pass over the table can count."""
        lost = [F.count_if(F.col(c).isNull()).alias(f"key_{k}") for k, c in enumerate(self.keys) if c in self.table.columns]
        bad = [F.count_if(F.col(c).isNotNull() & F.try_parse_json(F.col(c)).isNull()).alias(f"json_{k}") for k, c in enumerate(self.json) if c in self.table.columns]
        return [F.count(F.lit(1)).alias("rows"), *lost, *bad]

    def said(self, measured: dict[str, int]) -> list[str]:
        """The problems that these measures show, in words."""
        if self.missing():
            return [f"{self.name}: column {c} is missing" for c in self.missing()]
        if not measured["rows"]:
            return [f"{self.name}: no rows"]
        lost = [f"{self.name}: {n} rows without {c}" for k, c in enumerate(self.keys) if (n := measured.get(f"key_{k}"))]
        return lost + [f"{self.name}: {n} rows of {c} are no JSON" for k, c in enumerate(self.json) if (n := measured.get(f"json_{k}"))]

    def problems(self) -> Column:
        """``said`` as an array over the columns of ``measures``."""
        if self.missing():
            return F.array(*(F.lit(f"{self.name}: column {c} is missing") for c in self.missing()))
        counted = [(f"key_{k}", f" rows without {c}") for k, c in enumerate(self.keys) if c in self.table.columns] + [(f"json_{k}", f" rows of {c} are no JSON") for k, c in enumerate(self.json) if c in self.table.columns]
        none = F.lit(None).cast("string")
        shown = [F.when(F.col(m) > 0, F.concat(F.lit(f"{self.name}: "), F.col(m).cast("string"), F.lit(words))) for m, words in counted]
        return F.when(F.col("rows") == 0, F.array(F.lit(f"{self.name}: no rows"))).otherwise(F.array_compact(F.array(none, *shown)))


def contract_problems(contracts: list[Contract]) -> DataFrame:
    """(number, problem) of all contracts, numbered from 0: one pass a table, and nothing on the driver."""
    out = None
    for number, c in enumerate(contracts):
        rows = c.table.agg(*c.measures()).select(F.lit(number).alias("number"), F.explode(c.problems()).alias("problem"))
        out = rows if out is None else out.unionByName(rows)
    return out


def write_phase(tables: dict[str, DataFrame], folder: str, contracts: dict[str, Contract] | None = None) -> list[str]:
    """Each table as Parquet under ``folder``. The pass that writes a table also measures its contract (``DataFrame.observe``); what the contracts lack is returned."""
    problems = []
    for name, df in tables.items():
        contract, seen = (contracts or {}).get(name), None
        if contract:
            seen = Observation(f"contract-{name}")
            df = df.observe(seen, *contract.measures())
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
        if contract:
            problems += contract.said(seen.get)
    return problems


def check_contract(df: DataFrame, required: list[str], name: str) -> list[str]:
    """What a table lacks: missing columns, no rows. An empty list means that the contract holds."""
    return [r["problem"] for r in contract_problems([Contract(name, df, required)]).collect()]
