"""Snapshots, checkpoints and the checks that tables must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEY = ["source_root_id", "relative_path"]


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """change (added, missing, metadata_changed) of every entry that differs between two snapshots."""
    entry = F.struct("size_bytes", "mtime_ns")
    a = before.select(*KEY, entry.alias("a"))
    b = after.select(*KEY, entry.alias("b"))
    both = a.join(b, KEY, "full_outer")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "missing").when(~F.col("a").eqNullSafe(F.col("b")), "metadata_changed")
    return both.select(*KEY, change.alias("change")).where("change is not null")


def diff_summary(diff: DataFrame, examples: int = 20) -> DataFrame:
    """Counts of each change with its first examples; only the examples are gathered."""
    name = F.concat_ws(":", *KEY)
    counts = diff.groupBy("change").agg(F.count("*").alias("n"))
    firsts = [diff.where(F.col("change") == c).orderBy(*KEY).limit(examples).agg(F.lit(c).alias("change"), F.array_join(F.array_sort(F.collect_list(name)), "|").alias("examples")) for c in ("added", "missing", "metadata_changed")]
    shown = firsts[0].union(firsts[1]).union(firsts[2])
    return shown.join(counts, "change", "left").select("change", F.coalesce("n", F.lit(0)).alias("n"), "examples")


def reconcile(tasks: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """For every task: reuse (checkpointed with equal size and time), reprocess (changed since) or process (not there).

    An id that several batches hold counts by its last batch.
    """
    last = checkpoint.groupBy("file_instance_id").agg(F.max_by(F.struct("size_bytes", "mtime_ns"), "batch_id").alias("was"))
    joined = tasks.join(last, "file_instance_id", "left")
    same = F.col("was.size_bytes").eqNullSafe(F.col("size_bytes")) & F.col("was.mtime_ns").eqNullSafe(F.col("mtime_ns"))
    action = F.when(F.col("was").isNull(), "process").when(same, "reuse").otherwise("reprocess")
    return joined.select("file_instance_id", action.alias("action"), F.when(action == "reprocess", "source_changed_since_checkpoint").alias("error_category"))


def checkpoint_violations(parts: DataFrame, error_parts: DataFrame, tasks: DataFrame, run_id: str) -> DataFrame:
    """violation and n over checkpoint parts: unpaired parts, unknown or repeated ids, rows of another run."""
    own, other = (df.select("batch_id").distinct() for df in (parts, error_parts))
    unpaired = own.join(other, "batch_id", "left_anti").union(other.join(own, "batch_id", "left_anti")).select(F.lit("unpaired_part").alias("violation"))
    unknown = parts.join(tasks.select("file_instance_id"), "file_instance_id", "left_anti").select(F.lit("unknown_id").alias("violation"))
    repeated = parts.groupBy("file_instance_id").count().where("count > 1").select(F.lit("repeated_id").alias("violation"))
    foreign = parts.where(F.col("inventory_run_id") != run_id).select(F.lit("other_run").alias("violation"))
    return unpaired.union(unknown).union(repeated).union(foreign).groupBy("violation").agg(F.count("*").alias("n"))


def accounting(selected: DataFrame, processed: DataFrame) -> DataFrame:
    """Whether two sets of ids are equal, and what either lacks."""
    a, b = selected.select("file_instance_id").distinct(), processed.select("file_instance_id").distinct()
    both = a.withColumn("l", F.lit(1)).join(b.withColumn("r", F.lit(1)), "file_instance_id", "full_outer")
    return both.agg(F.count("l").alias("selected"), F.count("r").alias("processed"), F.count_if(F.col("r").isNull()).alias("not_processed"), F.count_if(F.col("l").isNull()).alias("not_selected")).withColumn("equal", (F.col("not_processed") == 0) & (F.col("not_selected") == 0))


def overlaps(sets: DataFrame, member: str, of: str) -> DataFrame:
    """Members of more than one set."""
    return sets.select(member, of).distinct().groupBy(member).agg(F.count("*").alias("sets")).where("sets > 1")


def count_gate(files: DataFrame, expected_files: int, expected_groups: int) -> DataFrame:
    """PASS, or HOLD if files or groups (summed over roots) differ from what was announced."""
    roots = files.groupBy("source_root_id").agg(F.count("*").alias("f"), F.count_distinct("parent_group").alias("g"))
    total = roots.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("files"), F.coalesce(F.sum("g"), F.lit(0)).alias("groups"))
    ok = (F.col("files") == expected_files) & (F.col("groups") == expected_groups)
    return total.withColumn("file_difference", F.col("files") - expected_files).withColumn("group_difference", F.col("groups") - expected_groups).withColumn("gate", F.when(ok, "PASS").otherwise("HOLD"))


def manifest_violations(items: DataFrame, announced: int) -> DataFrame:
    """violation and n over a manifest (items with recomputed_id): wrong count, wrong ids, repeated ids."""
    count = items.agg(F.count("*").alias("c")).where(F.col("c") != announced).select(F.lit("count_differs").alias("violation"))
    wrong = items.where("not (file_instance_id <=> recomputed_id)").select(F.lit("wrong_id").alias("violation"))
    repeated = items.groupBy("file_instance_id").count().where("count > 1").select(F.lit("repeated_id").alias("violation"))
    return count.union(wrong).union(repeated).groupBy("violation").agg(F.count("*").alias("n"))


def verdict(checks: list[tuple[Column, str]], failed: str = "HOLD") -> list[Column]:
    """verdict (PASS unless a check's condition holds) and reasons (of the conditions that hold, in order)."""
    reasons = F.filter(F.array(*(F.when(c, r) for c, r in checks)), lambda r: r.isNotNull())
    return [F.when(F.size(reasons) == 0, "PASS").otherwise(failed).alias("verdict"), F.array_join(reasons, "; ").alias("reasons")]


# ---------------------------------------------------------------- retries

# fixed values: what may be tried again
RETRYABLE_STAGES = ("stat_before", "hash", "pdf_open", "metadata", "worker")
RETRYABLE_CATEGORIES = ("OSError", "TimeoutError", "ConnectionError", "BlockingIOError", "InterruptedError", "FileNotFoundError", "PermissionError")
MAX_RETRIES = 2


def is_retryable(errors: Column, stages: tuple = RETRYABLE_STAGES, categories: tuple = RETRYABLE_CATEGORIES) -> Column:
    """Whether there are errors and every one is of a stage and a category that may be tried again."""
    return (F.size(errors) > 0) & F.forall(errors, lambda e: e["stage"].isin(*stages) & e["error_category"].isin(*categories))


def retry_accounting(attempts: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """From attempts (task, attempt from 0, has_errors, retryable): retries made, tasks recovered, tasks exhausted."""
    tasks = attempts.groupBy("task").agg(F.max("attempt").alias("last"), F.max_by("has_errors", "attempt").alias("failed"), F.max_by("retryable", "attempt").alias("again"))
    return tasks.agg(
        F.sum("last").alias("retry_attempts_total"), F.count_if((F.col("last") > 0) & ~F.col("failed")).alias("recovered_by_retry"),
        F.count_if((F.col("last") >= max_retries) & F.col("failed") & F.col("again")).alias("retry_exhausted"),
    )
