"""Strict reading of JSON lines: every line must hold one object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def strict_lines(lines: DataFrame) -> DataFrame:
    """line, ok and fields of (line, value): a blank line, or one that is no object, is not ok."""
    keys = F.json_object_keys(F.col("value"))
    return lines.select("line", keys.isNotNull().alias("ok"), F.coalesce(F.size(keys), F.lit(0)).alias("fields"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a JSON-lines file in the given schema; a line that is blank or no object of it fails the read."""
    text = spark.read.text(path)
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    checked = F.when(F.json_object_keys(F.col("value")).isNull(), F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 80)))).otherwise(F.lit(True))
    return text.where(checked.cast("boolean")).select(parsed.alias("r")).select("r.*")
