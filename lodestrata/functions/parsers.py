"""The parser of Python sources, and the table function that runs it.

``register`` makes it callable from SQL as ``python_symbols``. Inputs that are null or do not parse give no
rows. C# sources are read by ``lodestrata.operators.code``.
"""

from __future__ import annotations

import ast

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import fixed

def python_symbols(text: str):
    """(kind, name, line, arguments, docstring, is_async) of each class and function; none if the source does not parse."""
    try:
        tree = ast.parse(text or "")
    except (SyntaxError, ValueError):
        return
    for node in ast.walk(tree):
        if isinstance(node, ast.ClassDef):
            yield "class", node.name, node.lineno, [], "", False
        elif isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            yield "method", node.name, node.lineno, [a.arg for a in node.args.args], (ast.get_docstring(node) or "")[:300], isinstance(node, ast.AsyncFunctionDef)


_TABLES = {
    "python_symbols": (python_symbols, "kind string, name string, line long, arguments array<string>, docstring string, is_async boolean"),
}
#: Extractors by language, for callers that add their own.
EXTRACTORS = {"python": "python_symbols"}


def extract(rows: DataFrame, function: str, *keys: str, text: str = "text") -> DataFrame:
    """The facts of every row's text, with ``keys``; Arrow-batched, without a shuffle."""
    run, kind = _TABLES[function]
    names = [c.split()[0] for c in kind.split(", ")]
    schema = ", ".join([*(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys), kind])

    def mapped(batches):
        for frame in batches:
            made = [(*key, *fact) for *key, value in zip(*(frame[c] for c in (*keys, text)), strict=True) for fact in run(value)]
            yield type(frame)(made, columns=[*keys, *names])

    return rows.select(*keys, text).mapInPandas(mapped, schema)


def register(spark: SparkSession) -> None:
    """Make the parsers callable from SQL."""
    from pyspark.sql.functions import udtf

    for name, (run, kind) in _TABLES.items():

        def make(run=run, kind=kind):
            @udtf(returnType=kind)
            class Parsed:
                def eval(self, text: str):
                    yield from run(text)

            return Parsed

        spark.udtf.register(name, make())


def business_flags(symbols: DataFrame) -> DataFrame:
    """Adds ``is_business`` to rows with a ``name``."""
    return symbols.withColumn("is_business", F.lower("name").rlike("|".join(fixed.BUSINESS_KEYWORDS)))
