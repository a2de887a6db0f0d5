"""Explicit schemas of the artifacts. They are compared as a whole, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# fixed values: column names and types of the artifacts
_FILES = """inventory_schema_version file_instance_id source_root_id relative_path file_name parent_group extension size_bytes:long mtime_ns:long
source_changed_during_run:boolean sha256 hash_status pdf_open_status pdf_error_category pdf_status is_encrypted:boolean pdf_version page_count:long
metadata_title metadata_author metadata_subject metadata_keywords metadata_creator metadata_producer metadata_creation_date metadata_modification_date
sampled_page_count:long sampled_text_char_count:long text_layer_status filename_year filename_issue filename_title filename_parse_status inventory_status collected_at inventory_run_id"""
_DUPLICATES = "duplicate_group_id sha256 group_size:long file_instance_id is_representative:boolean"
_ERRORS = "inventory_run_id file_instance_id source_root_id relative_path stage error_category error_message timestamp"
_SAMPLE = """phase2_run_id calibration_sample_id calibration_item_id sample_role pool_name file_instance_id sha256 source_root_id relative_path parent_group file_name
size_bytes:long mtime_ns:long inventory_status pdf_open_status pdf_status page_count:long text_layer_status filename_parse_status exact_duplicate_group_id
exact_duplicate_representative:boolean group_population:long group_quota:long selection_rank_or_index:long sampling_method full_inventory_run_id inventory_schema_version"""
_SNAPSHOT = "source_root_id relative_path size_bytes:long mtime_ns:long"


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]()) for n, _, t in (c.partition(":") for c in text.split())])


_TYPES = {"": T.StringType, "long": T.LongType, "boolean": T.BooleanType}
FILES, DUPLICATES, ERRORS, SAMPLE, SNAPSHOT = map(_schema, (_FILES, _DUPLICATES, _ERRORS, _SAMPLE, _SNAPSHOT))


class SchemaError(ValueError):
    pass


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_exactly(spark: SparkSession, path: str, schema: T.StructType, rows: int | None = None) -> DataFrame:
    """A Parquet table whose own schema must equal the given one, and whose rows must be as many as announced."""
    df = spark.read.parquet(path)
    own = [(f.name, f.dataType) for f in df.schema]
    if own != [(f.name, f.dataType) for f in schema]:
        raise SchemaError(f"{path} has another schema: {df.schema.simpleString()}")
    if rows is not None and (n := df.count()) != rows:
        raise SchemaError(f"{path} has {n} rows instead of {rows}")
    return df
