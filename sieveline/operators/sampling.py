"""Samples of an inventory: first per group, evenly spaced, quotas, and the cascade of disjoint pools."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.functions import text as T
from sieveline.operators.inventory import collapse_duplicates
from sieveline.operators.ranking import evenly_spaced, numbered, quota_sample, quotas, ranked

ROOT_GROUP = ["source_root_id", "parent_group"]
PATH = ["relative_path"]
# fixed values: pools in their order of priority
POOLS = ("main", "source_quality_exception", "text_absent", "mixed_text", "filename_unmatched")
AUDIT = {"text_absent": ("text_layer_status", "text_absent"), "mixed_text": ("text_layer_status", "mixed_or_uncertain"), "filename_unmatched": ("filename_parse_status", "unmatched")}


def first_per_group(files: DataFrame) -> DataFrame:
    """The first file by path of each (root, group): an aggregation, so no group is sorted."""
    return files.groupBy(*ROOT_GROUP).agg(F.min_by(F.struct("relative_path", "file_instance_id"), F.struct("relative_path", "file_instance_id")).alias("f")).select(*ROOT_GROUP, "f.*")


def without(files: DataFrame, excluded: DataFrame) -> DataFrame:
    return files.join(excluded.select("file_instance_id"), "file_instance_id", "left_anti")


def spread_sample(files: DataFrame, excluded: DataFrame, per_group: int = 10) -> DataFrame:
    """Evenly spaced files of each (root, group) that are not excluded; group_count counts groups before the exclusion."""
    groups = files.select(*ROOT_GROUP).distinct().agg(F.count("*").alias("group_count"))
    return evenly_spaced(without(files, excluded), ROOT_GROUP, PATH, per_group).crossJoin(F.broadcast(groups))


def proportional_sample(files: DataFrame, excluded: DataFrame, target: int = 1000, base: int = 5) -> DataFrame:
    """Minimum coverage and proportional quotas of each (root, group) after the exclusion, evenly spaced by path."""
    return quota_sample(without(files, excluded), ROOT_GROUP, PATH, target, base)


def quota_table(files: DataFrame, excluded: DataFrame, target: int = 1000, base: int = 5) -> DataFrame:
    counts = without(files, excluded).groupBy(*ROOT_GROUP).agg(F.count("*").alias("rows_of_group"))
    return quotas(counts, ROOT_GROUP, "rows_of_group", target, base)


def is_healthy() -> Column:
    return F.coalesce((F.col("inventory_status") == "success") & (F.col("pdf_open_status") == "success") & (F.col("page_count") > 0), F.lit(False))


def is_main_eligible() -> Column:
    return is_healthy() & F.coalesce(F.col("text_layer_status").isin("text_present", "mixed_or_uncertain"), F.lit(False))


def audit_candidates(files: DataFrame, pool: str) -> DataFrame:
    column, value = AUDIT[pool]
    return files.where(is_healthy() & (F.col(column) == value))


def grouped_pool(candidates: DataFrame, pool: str, target: int, base: int = 1) -> DataFrame:
    """Evenly spaced candidates by (path, id) of each group (over all roots), as many as the group's quota."""
    chosen = quota_sample(candidates, ["parent_group"], ["relative_path", "file_instance_id"], target, base)
    # the index is the place among the group's candidates
    return chosen.withColumn("pool_name", F.lit(pool)).withColumn("selection_index", F.col("idx")).withColumnRenamed("population", "group_population").withColumnRenamed("final_quota", "group_quota").drop("idx", "n")


def exception_pool(candidates: DataFrame, target: int | None = None) -> DataFrame:
    """The first candidates by (group, path, id), all if there is no target; the index runs over all groups.

    The index is a count over groups plus a rank within a group, so no single task sorts all candidates.
    """
    own = ranked(candidates, ["parent_group"], ["relative_path", "file_instance_id"])
    sizes = candidates.groupBy("parent_group").agg(F.count("*").alias("rows_of_group"))
    before = F.sum("rows_of_group").over(Window.orderBy("parent_group")) - F.col("rows_of_group")
    starts = F.broadcast(sizes.select("parent_group", before.alias("start")))  # one row a group
    out = own.join(starts, "parent_group").withColumn("selection_index", (F.col("start") + F.col("idx")).cast("int"))
    if target is not None:
        out = out.where(F.col("selection_index") < target)
        out = out.withColumn("n", F.least(F.col("n"), F.lit(target) - F.col("start")))
    return out.withColumn("pool_name", F.lit("source_quality_exception")).withColumn("group_population", F.col("n").cast("long")).withColumn("group_quota", F.col("n").cast("long")).drop("idx", "n", "start")


def calibration_pools(files: DataFrame, duplicates: DataFrame, main_target: int, main_base: int, audit_targets: dict[str, int], exception_target: int | None = None, stage=lambda df, name: df) -> DataFrame:
    """All pools, each from what the pools before have not used.

    Duplicates collapse to their representatives in all pools but the exceptions. `stage` may write each pool and read
    it back, so that later pools don't compute it again.
    """
    names = ["file_instance_id", "parent_group", "relative_path", "pool_name", "group_population", "group_quota", "selection_index"]
    pools: list[DataFrame] = []

    def add(pool: DataFrame, name: str) -> None:
        pools.append(stage(pool.select(*names), name))

    def unused(df: DataFrame) -> DataFrame:
        return without(df, reduce(DataFrame.union, (p.select("file_instance_id") for p in pools)))

    add(grouped_pool(collapse_duplicates(files.where(is_main_eligible()), duplicates), "main", main_target, main_base), "main")
    add(exception_pool(unused(files.where("inventory_status = 'partial'")), exception_target), "source_quality_exception")
    for pool in POOLS[2:]:
        add(grouped_pool(collapse_duplicates(unused(audit_candidates(files, pool)), duplicates), pool, audit_targets[pool]), pool)
    return reduce(DataFrame.union, pools)


def pool_items(pools: DataFrame, files: DataFrame, duplicates: DataFrame, sample_id: str) -> DataFrame:
    """The calibration sample: pools with their records, identities and duplicate information."""
    info = duplicates.select("file_instance_id", "duplicate_group_id", "is_representative")
    rows = pools.join(files.drop("parent_group", "relative_path"), "file_instance_id").join(info, "file_instance_id", "left")
    return rows.select(
        T.calibration_item_id(F.lit(sample_id), F.col("file_instance_id")).alias("calibration_item_id"),
        F.when(F.col("pool_name") == "main", "main").otherwise("audit").alias("sample_role"), "pool_name",
        F.array_position(F.array(*map(F.lit, POOLS)), F.col("pool_name")).cast("int").alias("pool_priority"),
        "file_instance_id", "sha256", "source_root_id", "relative_path", "parent_group", "file_name", "size_bytes", "mtime_ns", "inventory_status",
        "pdf_open_status", "pdf_status", "page_count", "text_layer_status", "filename_parse_status",
        F.col("duplicate_group_id").alias("exact_duplicate_group_id"), F.coalesce("is_representative", F.lit(True)).alias("exact_duplicate_representative"),
        "group_population", "group_quota", "selection_index",
    )


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """batch_id of consecutive rows in the order, `size` each."""
    return numbered(df, order, "_place").withColumn("batch_id", F.expr(f"_place div {size}")).drop("_place")


def selection_hash(pools: DataFrame) -> DataFrame:
    """A hash of all items of a selection, whatever their order: their hashes are folded by six, three and no digits."""
    h = F.sha2(F.concat_ws("|", "pool_name", "parent_group", "relative_path", *(F.col(c).cast("string") for c in ("group_population", "group_quota", "selection_index"))), 256)
    fold = F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ","), 256).alias("h")
    six = pools.groupBy(F.substring(h, 1, 6).alias("six")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(h)), ","), 256).alias("h"), F.count("*").alias("items"))
    three = six.groupBy(F.substring("six", 1, 3).alias("three")).agg(fold, F.sum("items").alias("items"))
    return three.agg(fold.alias("selection_hash"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"))
