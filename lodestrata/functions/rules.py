"""Ordered rules as one CASE expression.

A rule's condition is SQL text over columns in scope, so one table of rules serves the
DataFrame plan (``column``) and any SQL statement (``case_sql``); the first true rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pattern(words) -> str:
    """Words as one alternation, without characters that SQL or a regular expression reads otherwise."""
    return "|".join("".join(f"[{c}]" if c in ".^$*+?{}()|" else c for c in w) for w in words)


def contains_any(expression: str, words) -> str:
    """True where the text contains one of ``words``; one regular expression keeps generated code small.

    ``regexp_like`` is Spark's name; the catalog writes DuckDB's into its statements."""
    return f"regexp_like({expression}, {quote(pattern(words))})"


def ends_any(expression: str, words) -> str:
    return f"regexp_like({expression}, {quote('(' + pattern(words) + ')$')})"


def is_any(expression: str, words) -> str:
    return f"{expression} IN ({', '.join(quote(w) for w in words)})"


def case_sql(rules, default: str = "NULL") -> str:
    """``rules``: (condition, result) pairs of SQL text, in order."""
    return "CASE " + " ".join(f"WHEN {condition} THEN {result}" for condition, result in rules) + f" ELSE {default} END"


def column(rules, default: str = "NULL") -> Column:
    return F.expr(case_sql(rules, default))


def lookup_sql(expression: str, table: dict[str, str], default: str = "NULL") -> str:
    return f"CASE {expression} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items()) + f" ELSE {default} END"
