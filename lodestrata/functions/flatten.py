"""Nested JSON as dotted keys.

JSON of any depth is flattened level by level over VARIANT: objects add ``.key``, arrays
``[i]``. Each round opens one level of all rows at once and stops when no object or array is
left, so the number of rounds is the depth, not the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_json(rows: DataFrame, column: str, *keys: str, depth: int = 8) -> DataFrame:
    """``keys, key, value``: one row a leaf; null leaves become ''. Texts that are no JSON give no row.

    Levels below ``depth`` stay JSON text in the value, so nothing is lost."""
    level = rows.select(*keys, F.lit("").alias("key"), F.try_parse_json(column).alias("node")).where("node IS NOT NULL")
    out = None
    for n in range(depth):
        shape = F.schema_of_variant("node")
        opened = level.withColumn("nested", shape.startswith("OBJECT") | shape.startswith("ARRAY") if n < depth - 1 else F.lit(False))
        leaves = opened.where(~F.col("nested")).select(*keys, "key", F.coalesce(F.col("node").cast("string"), F.lit("")).alias("value"))
        out = leaves if out is None else out.unionByName(leaves)
        if n == depth - 1:
            return out
        opened.createOrReplaceTempView("__flatten_level")
        listed = ", ".join(f"l.{k}" for k in keys) + (", " if keys else "")
        level = rows.sparkSession.sql(
            f"SELECT {listed}CASE WHEN e.key IS NULL THEN concat(l.key, '[', e.pos, ']') WHEN l.key = '' THEN e.key ELSE concat(l.key, '.', e.key) END AS key, e.value AS node "
            "FROM __flatten_level l, LATERAL variant_explode(l.node) e WHERE l.nested"
        )
    return out
