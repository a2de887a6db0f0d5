"""Whole runs: an inventory of source roots, and a calibration sample with its evidence."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline import schemas
from sieveline.config import Config
from sieveline.functions import text as T
from sieveline.operators import inventory as I, sampling, snapshots
from sieveline.sources import documents, labels, provenance, sinks
from sieveline.sources.discovery import discover
from sieveline.streaming import batches

VERSION = "inventory-v0.2"


class GateError(RuntimeError):
    pass


def tasks_of(found: DataFrame) -> DataFrame:
    return found.withColumn("file_instance_id", T.file_instance_id(F.col("source_root_id"), F.col("relative_path")))


def records_of(tasks: DataFrame, results: DataFrame, run_id: str) -> DataFrame:
    """The files artifact from tasks and what their examination showed, in its schema."""
    own = tasks.select("file_instance_id", "source_root_id", "relative_path", "file_name", "parent_group", "extension")
    name = F.col("file_name")
    joined = own.join(results, "file_instance_id", "left").withColumns(
        {f"filename_{n}": T.filename_part(name, k) for k, n in enumerate(("year", "issue", "title"), 1)}
        | {"filename_parse_status": T.filename_status(name), "inventory_schema_version": F.lit(VERSION), "inventory_run_id": F.lit(run_id), "collected_at": F.lit(now())}
        | {"inventory_status": F.coalesce("inventory_status", F.lit("failed")), "pdf_error_category": F.get(F.filter("errors", lambda e: e["stage"] == "pdf_open"), 0)["error_category"]}
    )
    return joined.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FILES))


def errors_of(tasks: DataFrame, results: DataFrame, run_id: str) -> DataFrame:
    """The errors artifact, ordered by root, path, stage and time."""
    each = results.select("file_instance_id", F.explode("errors").alias("e")).join(tasks.select("file_instance_id", "source_root_id", "relative_path"), "file_instance_id")
    rows = each.select(F.lit(run_id).alias("inventory_run_id"), "file_instance_id", "source_root_id", "relative_path", "e.stage", "e.error_category", "e.error_message", F.lit(now()).alias("timestamp"))
    return rows.orderBy("source_root_id", "relative_path", "stage", "timestamp")


def now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def inventory(spark: SparkSession, config: Config, run_id: str, opener: Callable = documents.open_with_pymupdf, expected: tuple[int, int] | None = None, stop_after: int | None = None, resume: bool = False, select: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Discovers, examines and describes the documents of all enabled roots; returns the run's state or statistics.

    Sources are snapshot before and after; batches that are done are not done again when a stopped run is resumed.
    `select` chooses the files to examine among all that are found.
    """
    began = time.monotonic()
    root = sinks.safe_output(config.enabled().values(), config.output_root)
    run = sinks.Run(root, run_id)
    folder = run.folder
    fixed = {"config": config.fingerprint(), "version": VERSION, "batch_size": config.batch_size}
    path = lambda name: f"file://{folder}/{name}"
    if resume:
        run.resume(**fixed)
    else:
        found = tasks_of(discover(spark, config.enabled()))
        if expected is not None and (gate := snapshots.count_gate(found, *expected).first())["gate"] != "PASS":
            raise GateError(f"found {gate['files']} files in {gate['groups']} groups instead of {expected}")
        run.start(**fixed)
        found.write.parquet(path("snapshot"))
        found = spark.read.parquet(path("snapshot"))
        batches.write_tasks(found if select is None else select(found), path("tasks"), ["source_root_id", "relative_path"], config.batch_size)
    before = spark.read.parquet(path("snapshot"))
    tasks = spark.read.parquet(path("tasks"))
    try:
        batches.process(spark, path("tasks"), lambda b: documents.examined(b, opener, config.threshold), path("checkpoint"), path("progress"), stop_after)
    except BaseException:
        run.finish("failed")
        raise
    results = batches.results(spark, path("checkpoint")).drop("batch_id")
    if results.select("file_instance_id").count() < tasks.count():
        run.finish("interrupted")
        return run.state()
    files = records_of(tasks, results, run_id)
    sinks.write_table(files.orderBy("source_root_id", "relative_path"), path("files.parquet"), schemas.FILES)
    files = schemas.read_exactly(spark, path("files.parquet"), schemas.FILES, tasks.count())
    sinks.write_table(I.exact_duplicates(files), path("duplicate_groups.parquet"), schemas.DUPLICATES)
    sinks.write_table(errors_of(tasks, results, run_id), path("errors.parquet"), schemas.ERRORS)
    after = tasks_of(discover(spark, config.enabled()))
    diff = snapshots.diff_summary(snapshots.snapshot_diff(before, after)).collect()  # three rows
    stats = I.inventory_stats(files, time.monotonic() - began).first().asDict() | {"source_changes": {r["change"]: r["n"] for r in diff}}
    totals = {r["source_root_id"] or "": [r["files"], r["bytes"], r["groups"]] for r in I.snapshot_totals(before).collect()}  # a row a root
    commit, dirty = provenance.git(Path(__file__).parent)
    earlier = labels.latest_snapshot(root, config.enabled())
    stats |= {"runtime": provenance.machine(root), "commit": commit, "uncommitted_changes": dirty, "earlier_snapshot": earlier and {"run_id": earlier[0], "same_totals": earlier[1] == totals}}
    sinks.write_json(folder / "source_snapshot.json", labels.snapshot_json(totals, config.enabled()))
    if select:
        items = [r.asDict() for r in tasks.select("source_root_id", "relative_path", "file_instance_id").orderBy("source_root_id", "relative_path").collect()]  # the sample
        sinks.write_json(folder / "sample_manifest.json", {"run_id": run_id, "count": len(items), "items": items})
    changed = any(r["n"] for r in diff)
    stats |= {"verdict": "HOLD" if changed else "PASS", "reasons": ["pre/post source snapshots differ"] * changed}
    sinks.write_json(folder / "statistics.json", stats)
    sinks.write_manifest(folder, {"run_id": run_id, "config_fingerprint": fixed["config"]}, ["files.parquet", "duplicate_groups.parquet", "errors.parquet", "source_snapshot.json", "statistics.json", *(["sample_manifest.json"] if select else [])])
    if problems := sinks.manifest_problems(folder):
        raise RuntimeError(f"artifacts differ from the manifest: {problems}")
    run.finish()
    return stats


#: files of a group in the second stage, and all files and the least of a group in the third
SPREAD, TARGET, BASE = 10, 1000, 5


def sample(spark: SparkSession, config: Config, stage: str, run_id: str, earlier: list[str] = (), target: int = TARGET, **more) -> dict:
    """An inventory of a sample: d1 takes the first file of each group, d2 evenly spaced files of each group without
    those of a d1 run, d3 a proportional sample without those of a d1 and a d2 run."""
    if stage not in ("d1", "d2", "d3") or len(earlier) < {"d1": 0, "d2": 1, "d3": 2}.get(stage, 0) or (stage == "d1" and earlier):
        raise GateError(f"{stage} with {len(earlier)} earlier runs")

    def select(found: DataFrame) -> DataFrame:
        recompute = lambda root, path: str(uuid.uuid5(uuid.NAMESPACE_URL, f"corpus://file-instance/{root}/{path}"))
        ids = [(i,) for run in earlier for i in labels.sample_ids(config.output_root, run, None if stage == "d2" else recompute)]
        excluded = spark.createDataFrame(ids, "file_instance_id string")
        if stage == "d1":
            chosen = sampling.first_per_group(found)
        elif stage == "d2":
            chosen = sampling.spread_sample(found, excluded, SPREAD)
        else:
            chosen = sampling.proportional_sample(found, excluded, target, BASE)
        return found.join(chosen.select("file_instance_id"), "file_instance_id", "left_semi")

    return inventory(spark, config, run_id, select=select, **more)


def write_signals(rows: DataFrame, path: str, canonical: str) -> None:
    """The quality signals of a calibration's evidence as a table; it may not lie in the canonical run."""
    sinks.safe_output([canonical], path.removeprefix("file://"))
    own = rows.select("calibration_item_id", "evidence_text_available", T.quality_signals(F.col("evidence_text")).alias("s"))
    out = own.select("calibration_item_id", "evidence_text_available", "s.*")
    sinks.write_table(out, path, out.schema)


def calibration(spark: SparkSession, config: Config, inventory_run: str, run_id: str, opener: Callable = documents.open_with_pymupdf) -> dict:
    """Selects the calibration pools of a finished inventory, extracts their evidence and writes both."""
    source = Path(config.output_root) / inventory_run
    if sinks.Run(config.output_root, inventory_run).state()["run_status"] != "completed" or sinks.manifest_problems(source):
        raise GateError(f"{inventory_run} is no complete inventory")
    read = lambda name, schema: schemas.read_exactly(spark, f"file://{source}/{name}", schema)
    files, duplicates = read("files.parquet", schemas.FILES), read("duplicate_groups.parquet", schemas.DUPLICATES)
    run = sinks.Run(sinks.safe_output(config.enabled().values(), config.output_root), run_id)
    run.start(config=config.fingerprint(), inventory=inventory_run)
    path = lambda name: f"file://{run.folder}/{name}"

    def stage(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(path(f"pools/{name}"))
        return spark.read.parquet(path(f"pools/{name}"))

    pools = sampling.calibration_pools(files, duplicates, config.main_target, config.main_base, config.audit_targets, stage=stage)
    items = sampling.pool_items(pools, files, duplicates, f"{inventory_run}/{config.fingerprint()}")
    named = items.withColumns({"phase2_run_id": F.lit(run_id), "calibration_sample_id": F.lit(config.fingerprint()), "selection_rank_or_index": F.col("selection_index"), "sampling_method": F.lit("evenly-spaced"), "full_inventory_run_id": F.lit(inventory_run), "inventory_schema_version": F.lit(VERSION)})
    sinks.write_table(named, path("calibration_sample.parquet"), schemas.SAMPLE)
    sample = schemas.read_exactly(spark, path("calibration_sample.parquet"), schemas.SAMPLE)
    roots = spark.createDataFrame(sorted(config.enabled().items()), "source_root_id string, root string")
    tasks = sample.join(F.broadcast(roots), "source_root_id").select("calibration_item_id", F.concat_ws("/", "root", "relative_path").alias("path"), "size_bytes", "mtime_ns", "page_count", (F.col("pool_name") == "source_quality_exception").alias("not_applicable"))
    rows = documents.evidence(tasks, opener, config.evidence_pages, config.evidence_cap)
    titles = files.select("file_instance_id", "filename_title", "metadata_title")
    joined = sample.select("calibration_item_id", "file_instance_id", "pool_name", "parent_group").join(titles, "file_instance_id").join(rows, "calibration_item_id")
    sinks.write_jsonl(joined, path("calibration_evidence.jsonl"), ["pool_name", "parent_group", "calibration_item_id"])
    written = spark.read.schema(joined.schema).json(path("calibration_evidence.jsonl"))
    counts = {r["evidence_status"]: r["count"] for r in written.groupBy("evidence_status").count().collect()}
    bad = {"failed": counts.get("failed", 0), "changed": written.where("source_changed_during_evidence").count(), "missing": sample.count() - sum(counts.values())}
    stats = {"evidence": counts, "verdict": "FAIL" if any(bad.values()) else "PASS", "reasons": [k for k, n in bad.items() if n]}
    sinks.write_json(run.folder / "statistics.json", stats)
    sinks.write_manifest(run.folder, {"run_id": run_id, "inventory_run": inventory_run}, ["calibration_sample.parquet", "calibration_evidence.jsonl", "statistics.json"])
    run.finish()
    return stats
