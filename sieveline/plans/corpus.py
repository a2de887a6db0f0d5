"""The test tables seen as an inventory of files, for Spark and, as a WITH clause, for the oracles.

A document is a file: lang is its root, source its group, pages are stretches of 1,500 characters. Conditions that the
documents don't have by themselves (failed hashes, files that don't open, empty pages, unmatched names) follow from
doc_id, in the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline.functions import text as T
from sieveline.operators.inventory import inventory_status, zero_page_status
from sieveline.sources.staging import Stages

PAGE = 1500
THRESHOLD = 50


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f):
            self.queries[f.__name__] = f
            if sql is not None:
                self.oracles[f.__name__] = dedent(sql).strip()
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, name: str):
    """A function that writes a frame once and reads it back, for plans that use it several times."""
    return Stages(spark, name).write


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def every(n: int):
    return F.col("doc_id") % n == 0


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    number = F.lpad(F.col("doc_id").cast("string"), 8, "0")
    month = F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0")
    name = F.when(every(101), F.lit(None)).when(every(5), F.concat(number, F.lit(".pdf"))).otherwise(F.concat(F.lit("【2024-"), month, F.lit("】Title "), F.col("doc_id").cast("string"), F.lit(".pdf")))
    named = docs.select("doc_id", "text", "n_chars", F.col("lang").alias("source_root_id"), F.col("source").alias("parent_group"), F.concat("source", F.lit("/"), number, F.lit(".pdf")).alias("relative_path"), name.alias("file_name"))
    pages = F.when(every(53), 0).otherwise(F.ceil(F.col("n_chars") / PAGE)).cast("int")
    probes = T.probe_pages(F.col("page_count"))
    counted = F.transform(T.pages_of(F.col("text"), probes, PAGE), lambda t: F.length(T.stripped(t)))
    counts = F.when(every(41), F.array().cast("array<int>")).when(every(17), F.transform(probes, lambda p: F.lit(0))).otherwise(counted)
    failures = F.when(every(41) | every(43), 1).otherwise(0)
    error = lambda stage, category: F.struct(F.lit(stage).alias("stage"), F.lit(category).alias("error_category"))
    errors = F.array_compact(F.array(
        F.when(every(89), error("hash", "OSError")), F.when(every(97), error("pdf_open", "FileDataError")),
        F.when(every(53), error("metadata", "zero_page_count")), F.when(every(41) | every(43), error("text_sample", "RuntimeError")),
    ))
    return (
        named.withColumn("page_count", pages)
        .withColumn("file_instance_id", T.file_instance_id(F.col("source_root_id"), F.col("relative_path")))
        .withColumn("size_bytes", F.octet_length("text").cast("long"))
        .withColumn("mtime_ns", F.lit(1_700_000_000_000_000_000) + F.col("doc_id") * 1000)
        .withColumn("hash_status", F.when(every(89), "failed").otherwise("success"))
        .withColumn("sha256", F.when(~every(89), F.sha2("text", 256)))
        .withColumn("pdf_open_status", F.when(every(97), "failed").otherwise("success"))
        .withColumn("pdf_status", zero_page_status(~every(97), F.col("page_count"), F.lit("inventory-v0.2")))
        .withColumn("text_layer_status", T.text_layer_status(counts, failures, THRESHOLD))
        .withColumn("filename_parse_status", T.filename_status(F.col("file_name")))
        .withColumn("errors", errors)
        .withColumn("inventory_status", inventory_status(F.col("errors"), ~every(211)))
    )


def uuid_sql(name: str) -> str:
    h = f"sha1(unhex('{T.URL_NAMESPACE}') || encode({name}))"
    digit = f"substr('89ab', ((strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1)::INTEGER, 1)"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {digit} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


_PROBE = "length(regexp_replace(substr(text, ({p}) * 1500 + 1, 1500), '^\\s+|\\s+$', '', 'g'))"
FILES = f"""
WITH named AS (
  SELECT doc_id, text, n_chars, lang AS source_root_id, source AS parent_group,
    source || '/' || lpad(doc_id::VARCHAR, 8, '0') || '.pdf' AS relative_path,
    CASE WHEN doc_id % 101 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN lpad(doc_id::VARCHAR, 8, '0') || '.pdf'
      ELSE '【2024-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || '】Title ' || doc_id::VARCHAR || '.pdf' END AS file_name,
    CASE WHEN doc_id % 53 = 0 THEN 0 ELSE (n_chars + 1499) // 1500 END AS page_count
  FROM documents),
probed AS (
  SELECT *, CASE WHEN doc_id % 17 = 0 THEN 0 ELSE {_PROBE.format(p="0")} END AS c0,
    CASE WHEN doc_id % 17 = 0 THEN 0 ELSE {_PROBE.format(p="page_count // 2")} END AS c1,
    CASE WHEN doc_id % 17 = 0 THEN 0 ELSE {_PROBE.format(p="greatest(page_count - 1, 0)")} END AS c2
  FROM named),
files AS (
  SELECT doc_id, text, n_chars, source_root_id, parent_group, relative_path, file_name, page_count,
    {uuid_sql("'corpus://file-instance/' || source_root_id || '/' || relative_path")} AS file_instance_id,
    octet_length(encode(text))::BIGINT AS size_bytes, 1700000000000000000 + doc_id * 1000 AS mtime_ns,
    CASE WHEN doc_id % 89 = 0 THEN 'failed' ELSE 'success' END AS hash_status,
    CASE WHEN doc_id % 89 = 0 THEN NULL ELSE sha256(text) END AS sha256,
    CASE WHEN doc_id % 97 = 0 THEN 'failed' ELSE 'success' END AS pdf_open_status,
    CASE WHEN doc_id % 97 = 0 OR page_count = 0 THEN 'corrupted_or_invalid' ELSE 'valid' END AS pdf_status,
    CASE WHEN doc_id % 41 = 0 THEN 'check_failed' WHEN doc_id % 43 = 0 AND page_count = 0 THEN 'check_failed'
      WHEN doc_id % 43 = 0 OR page_count = 0 THEN 'mixed_or_uncertain' WHEN greatest(c0, c1, c2) = 0 THEN 'text_absent'
      WHEN least(c0, c1, c2) >= 50 THEN 'text_present' ELSE 'mixed_or_uncertain' END AS text_layer_status,
    CASE WHEN file_name IS NULL THEN 'error' WHEN doc_id % 5 = 0 THEN 'unmatched' ELSE 'matched' END AS filename_parse_status,
    CASE WHEN doc_id % 89 <> 0 AND doc_id % 97 <> 0 AND doc_id % 53 <> 0 AND doc_id % 41 <> 0 AND doc_id % 43 <> 0 THEN 'success'
      WHEN doc_id % 211 <> 0 THEN 'partial' ELSE 'failed' END AS inventory_status
  FROM probed)
"""
#: members of groups of equal hashes
DUPLICATES = (
    FILES
    + """, duplicates AS (
  SELECT 'exact-' || sha256 AS duplicate_group_id, sha256, n AS group_size, file_instance_id, r = 1 AS is_representative
  FROM (SELECT *, count(*) OVER (PARTITION BY sha256) AS n, row_number() OVER (PARTITION BY sha256 ORDER BY source_root_id, relative_path) AS r
        FROM files WHERE hash_status = 'success') WHERE n > 1)
"""
)
