"""Small driver-side inputs: review labels, taxonomy snapshots, manifests of earlier samples, and earlier snapshots."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

# fixed values: what a review may say of an item's evidence, and the items of a review
SUFFICIENCY = ("sufficient", "borderline", "insufficient")
REVIEWED = 20


class InputError(ValueError):
    pass


def _json(path: Path) -> dict:
    try:
        value = json.loads(path.read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise InputError(f"cannot read {path}: {e}") from e
    if not isinstance(value, dict):
        raise InputError(f"{path} is no mapping")
    return value


def _yaml(path: str | Path) -> dict:
    try:
        value = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except (OSError, yaml.YAMLError) as e:
        raise InputError(f"cannot read {path}: {e}") from e
    if not isinstance(value, dict):
        raise InputError(f"{path} is no mapping")
    return value


def review_labels(spark: SparkSession, path: str | Path, count: int | None = REVIEWED) -> DataFrame:
    """relative_path (unique), sufficiency and quality_labels of a review's items."""
    rows = []
    for item in _yaml(path).get("reviewed_items") or ():
        own = item if isinstance(item, dict) else {}
        name, enough, marks = own.get("relative_path"), own.get("sufficiency"), own.get("quality_labels")
        if not (isinstance(name, str) and name and enough in SUFFICIENCY and isinstance(marks, list) and all(isinstance(m, str) for m in marks)):
            raise InputError(f"no valid reviewed item: {item!r}")
        rows.append((name, enough, marks))
    if len({r[0] for r in rows}) < len(rows):
        raise InputError("a reviewed path is repeated")
    if count is not None and len(rows) != count:
        raise InputError(f"{len(rows)} reviewed items instead of {count}")
    return spark.createDataFrame(rows, "relative_path string, sufficiency string, quality_labels array<string>")


def payload_hash(value: object) -> str:
    """SHA-256 of a value as compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def taxonomy(spark: SparkSession, path: str | Path, codes: tuple[str, ...]) -> DataFrame:
    """code, place and name of a taxonomy's domains; the file holds a hash of its content without that hash, and its
    domains are the given codes in their order."""
    value = _yaml(path)
    claimed = value.pop("payload_hash", None)
    if payload_hash(value) != claimed:
        raise InputError(f"{path} doesn't have the content that its hash says")
    domains = value.get("domains")
    if not isinstance(domains, list) or tuple(d.get("domain_id") for d in domains) != codes or not all(str(d.get("name") or "").strip() for d in domains):
        raise InputError(f"{path} must have the domains {codes[0]} to {codes[-1]} in order, each with a name")
    return spark.createDataFrame([(d["domain_id"], k, d["name"]) for k, d in enumerate(domains, 1)], "code string, place int, name string")


def sample_ids(runs: str | Path, run_id: str, recompute=None) -> list[str]:
    """The file ids of an earlier run's sample manifest. With `recompute` (of root and path), every id must follow from
    its path, the count must agree and no id may be repeated."""
    if not run_id or Path(run_id).name != run_id:
        raise InputError("a run id is one path component")
    value = _json(Path(runs) / run_id / "sample_manifest.json")
    items = value.get("items")
    if value.get("run_id") != run_id or not isinstance(items, list):
        raise InputError(f"the sample manifest of {run_id} is of another run or has no items")
    ids = [i.get("file_instance_id") if isinstance(i, dict) else None for i in items]
    if not ids or not all(isinstance(i, str) for i in ids):
        raise InputError(f"the sample manifest of {run_id} has items without an id")
    if recompute is not None:
        wrong = [i["file_instance_id"] for i in items if recompute(i.get("source_root_id"), i.get("relative_path")) != i["file_instance_id"]]
        if wrong or len(set(ids)) < len(ids) or value.get("count") != len(ids):
            raise InputError(f"the sample manifest of {run_id} doesn't agree with itself: {wrong[:3]}")
    return ids


def snapshot_json(totals: dict, roots: dict[str, str]) -> dict:
    """A source snapshot's summary: its roots, and what `snapshot_totals` says of them."""
    return {"source_roots": [{"source_root_id": k, "path": v} for k, v in sorted(roots.items())], "totals": totals}


def snapshot_from(value: dict) -> tuple[dict[str, str], dict]:
    try:
        return {r["source_root_id"]: r["path"] for r in value["source_roots"]}, dict(value["totals"])
    except (KeyError, TypeError) as e:
        raise InputError(f"no snapshot: {e}") from e


def latest_snapshot(runs: str | Path, roots: dict[str, str], prefix: str = "") -> tuple[str, dict] | None:
    """The newest run (by name) with a snapshot of the same root ids, and its totals; unreadable ones are passed over."""
    for folder in sorted(Path(runs).glob(f"{prefix}*/"), reverse=True):
        try:
            own, totals = snapshot_from(_json(folder / "source_snapshot.json"))
        except InputError:
            continue
        if sorted(own) == sorted(roots):
            return folder.name, totals
    return None
