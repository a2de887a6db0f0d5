"""Inventory operators: file records, duplicates, counts and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.functions import text as T
from sieveline.operators import ranking as R

KEY = ["source_root_id", "relative_path"]
TEXT_STATUSES = ("text_present", "text_absent", "mixed_or_uncertain", "check_failed")
NAME_STATUSES = ("matched", "unmatched", "error")


def inventory_status(errors: Column, stat_ok: Column) -> Column:
    """success without errors; with errors, partial if the file could be examined at all, else failed."""
    return F.when(F.size(errors) == 0, "success").when(stat_ok, "partial").otherwise("failed")


def zero_page_status(opened: Column, pages: Column, version: Column) -> Column:
    """valid or corrupted_or_invalid: an openable file without pages is invalid from the second schema version on."""
    zero = opened & (pages == 0) & (version == "inventory-v0.2")
    return F.when(~opened | zero, "corrupted_or_invalid").otherwise("valid")


def exact_duplicates(files: DataFrame) -> DataFrame:
    """A row for each member of a group of equal, successful hashes; the first member by (root, path) represents it.

    Groups are found by a partial aggregation first, so rows without a copy never reach the ranking.
    """
    known = files.where("hash_status = 'success' and sha256 <> ''")
    sizes = known.groupBy("sha256").agg(F.count("*").alias("group_size"), F.min(F.struct(*KEY, "file_instance_id")).alias("first")).where("group_size > 1")
    members = known.join(sizes, "sha256")
    return members.select(F.concat(F.lit("exact-"), "sha256").alias("duplicate_group_id"), "sha256", "group_size", "file_instance_id", (F.struct(*KEY, "file_instance_id") == F.col("first")).alias("is_representative"))


def duplicate_summary(files: DataFrame, duplicates: DataFrame) -> DataFrame:
    total = files.agg(F.count("*").alias("total"))
    sums = duplicates.agg(F.count_distinct("duplicate_group_id").alias("group_count"), F.count("*").alias("file_count"), F.coalesce(F.max("group_size"), F.lit(0)).alias("largest_group"))
    return sums.crossJoin(total).select("group_count", "file_count", "largest_group", T.safe_ratio(F.col("file_count"), F.col("total")).alias("duplicate_rate"))


def collapse_duplicates(files: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Rows that represent their group or have none."""
    others = duplicates.where("not is_representative").select("file_instance_id")
    return files.join(others, "file_instance_id", "left_anti")


def duplicate_violations(files: DataFrame, duplicates: DataFrame) -> DataFrame:
    """violation and n: what is wrong with a table of duplicates (no row if nothing is)."""
    own = files.select("file_instance_id", F.col("sha256").alias("own_sha256"))
    joined = duplicates.join(own, "file_instance_id", "left")
    unknown = joined.where("own_sha256 is null").select(F.lit("unknown_file").alias("violation"))
    differs = joined.where("own_sha256 <> sha256").select(F.lit("hash_differs").alias("violation"))
    groups = duplicates.groupBy("duplicate_group_id").agg(F.count("*").alias("n"), F.max("group_size").alias("size"), F.count_if("is_representative").alias("reps"))
    size = groups.where("n <> size").select(F.lit("size_differs").alias("violation"))
    reps = groups.where("reps <> 1").select(F.lit("representatives").alias("violation"))
    twice = duplicates.groupBy("file_instance_id").agg(F.count_distinct("duplicate_group_id").alias("n")).where("n > 1").select(F.lit("in_two_groups").alias("violation"))
    return unknown.union(differs).union(size).union(reps).union(twice).groupBy("violation").agg(F.count("*").alias("n"))


def status_pivot(files: DataFrame, status: str, names: tuple[str, ...], group: str = "parent_group") -> DataFrame:
    """Rows and rows of each status by group; equal group names of different roots are one group."""
    return files.groupBy(F.coalesce(group, F.lit("")).alias(group)).agg(F.count("*").alias("total_files"), *(F.count_if(F.col(status) == n).alias(n) for n in names))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("value")).agg(F.count("*").alias("n"))


def distribution(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """count, min, median, p90, p95, p99 and max with linear interpolation; nulls are left out."""
    place = lambda p: (F.col("total") - 1) * p
    names = {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    ends = [e for n, p in names.items() for e in (R.at_place(F.floor(place(p))).alias(f"{n}_low"), R.at_place(F.ceil(place(p))).alias(f"{n}_high"))]
    found = R.value_ranks(df, column).agg(F.coalesce(F.max("total"), F.lit(0)).alias("total"), F.min("v").alias("min"), F.max("v").alias("max"), *ends)
    between = lambda n, p: F.round(F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * (place(p) - F.floor(place(p))), digits)
    return found.select(F.col("total").alias("count"), "min", *(between(n, p).alias(n) for n, p in names.items()), "max")


def nearest_rank(df: DataFrame, column: str, group: list[str] | None = None) -> DataFrame:
    """min, p10, median, p90 and max as the values at place round((n - 1) p), halves to even."""
    at = lambda p: R.at_place(F.bround((F.col("total") - 1) * p).cast("long"))
    ends = R.value_ranks(df, column, group)
    return ends.groupBy(*(group or [])).agg(F.max("total").alias("count"), F.min("v").alias("min"), at(0.1).alias("p10"), at(0.5).alias("median"), at(0.9).alias("p90"), F.max("v").alias("max"))


def inventory_stats(files: DataFrame, wall_seconds: float) -> DataFrame:
    """One row of counts over all records, in a single aggregation."""
    is_ = lambda column, value: F.count_if(F.col(column) == value)
    known = F.count_if(F.col("filename_parse_status").isin(*NAME_STATUSES))
    seconds = F.lit(float(wall_seconds))
    size = F.sum(F.coalesce("size_bytes", F.lit(0)))
    return files.agg(
        F.count("*").alias("total_files"), F.count_distinct("file_instance_id").alias("unique_files"),
        is_("inventory_status", "success").alias("successful_files"), is_("inventory_status", "partial").alias("partial_files"),
        is_("inventory_status", "failed").alias("failed_files"), size.alias("total_bytes"), is_("pdf_open_status", "success").alias("open_success"),
        is_("pdf_open_status", "failed").alias("open_failure"), is_("pdf_status", "valid").alias("valid_count"),
        is_("pdf_status", "corrupted_or_invalid").alias("invalid_count"), is_("page_count", 0).alias("zero_page_count"),
        *(is_("text_layer_status", s).alias(s) for s in TEXT_STATUSES), is_("filename_parse_status", "matched").alias("filename_matched"),
        T.safe_ratio(is_("filename_parse_status", "matched"), known).alias("filename_match_rate"),
        T.safe_ratio(F.count("*"), seconds).alias("files_per_second"), T.safe_ratio(size / (1024 * 1024), seconds).alias("mib_per_second"),
    )


def snapshot_totals(files: DataFrame) -> DataFrame:
    """Files, bytes and groups by root and overall (source_root_id null); the overall groups are the sum over roots."""
    roots = files.groupBy("source_root_id").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"), F.count_distinct("parent_group").alias("groups"))
    overall = roots.agg(F.lit(None).cast("string").alias("source_root_id"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.sum("groups").alias("groups"))
    return roots.union(overall)


def fingerprint(files: DataFrame) -> DataFrame:
    """A hash of all entries in order, in two levels: entries by (root, group), then the groups' digests.

    No step gathers more than one group's digests; the order follows from the keys, not from the input.
    """
    entry = F.sha2(F.concat_ws("\x1f", *KEY, F.col("size_bytes").cast("string"), F.col("mtime_ns").cast("string")), 256)
    # a group of any size is folded by parts of the hash first
    cell = F.substring(F.sha2("relative_path", 256), 1, 3)
    cells = files.select("source_root_id", "parent_group", cell.alias("cell"), entry.alias("h"))
    digests = cells.groupBy("source_root_id", "parent_group", "cell").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ","), 256).alias("h"))
    groups = digests.groupBy("source_root_id", "parent_group").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell", "h"))), lambda x: x.h), ","), 256).alias("h"))
    return groups.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_root_id", "parent_group", "h"))), lambda x: x.h), ","), 256).alias("fingerprint"), F.count("*").alias("groups"))


def error_rows(files: DataFrame) -> DataFrame:
    """One row for each error of each record."""
    return files.select("file_instance_id", *KEY, "parent_group", F.explode("errors").alias("e")).select("file_instance_id", *KEY, "parent_group", "e.stage", "e.error_category")


def error_counts_by_group(errors: DataFrame, files: DataFrame) -> DataFrame:
    """Errors by their file's group; errors without a known file or group count under <unknown>."""
    own = files.select("file_instance_id", F.col("parent_group").alias("own_group"))
    joined = errors.select("file_instance_id").join(own, "file_instance_id", "left")
    return joined.groupBy(F.coalesce(F.nullif("own_group", F.lit("")), F.lit("<unknown>")).alias("parent_group")).agg(F.count("*").alias("n"))


def error_breakdown(errors: DataFrame) -> DataFrame:
    """Counts by stage, by category and by group, in one pass."""
    one = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(c).alias("value")) for d, c in (("stage", "stage"), ("category", "error_category"), ("parent_group", "parent_group"))))
    return errors.select(F.explode(one).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def unmatched_examples(files: DataFrame, limit: int = 20) -> DataFrame:
    """The first names that don't match, by (root, path): a report of `limit` rows."""
    return files.where("filename_parse_status = 'unmatched'").orderBy(*KEY).select("source_root_id", "parent_group", "file_name", "relative_path").limit(limit)
