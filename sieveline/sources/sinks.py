"""Writing results: tables with a fixed schema, small JSON documents, self-hashing manifests, and runs.

Tables go through Spark's own commit protocol and never overwrite. The small documents of a run are written by the
driver into a temporary file beside the target and renamed.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import uuid
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, functions as F, types as T

STATES = ("running", "interrupted", "completed", "failed")
ZEROES = "0" * 64


class UnsafePath(RuntimeError):
    pass


class ResumeError(RuntimeError):
    pass


def safe_output(sources: Iterable[str | Path], output: str | Path) -> Path:
    """The resolved output folder; it may not be, hold or lie in any source root."""
    out = Path(output).expanduser().resolve()
    for source in sources:
        root = Path(source).expanduser().resolve()
        if out == root or out in root.parents or root in out.parents:
            raise UnsafePath(f"{out} overlaps the source {root}")
    return out


def json_bytes(value: object) -> bytes:
    return (json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2) + "\n").encode()


def write_bytes(path: Path, data: bytes) -> None:
    """Whole or not at all: a temporary file in the same folder, flushed, then renamed."""
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise
    folder = os.open(path.parent, os.O_RDONLY)
    try:
        os.fsync(folder)
    finally:
        os.close(folder)


def write_json(path: Path, value: object) -> None:
    write_bytes(path, json_bytes(value))


def write_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    """As Parquet in exactly the given columns and types: written beside the target, then renamed, so that the target
    is whole or not there. An existing table is an error."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    target, beside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex[:8]}.tmp"))
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        raise FileExistsError(path)
    try:
        df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema)).write.parquet(beside.toString())
        if fs.exists(target) or not fs.rename(beside, target):
            raise FileExistsError(path)
    finally:
        fs.delete(beside, True)


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """As JSON lines with sorted keys, in a total order: range-partitioned, so the parts follow each other in name."""
    line = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.orderBy(*order).select(line.alias("value")).write.mode("errorifexists").text(path)


def descriptor(path: Path) -> dict:
    digest, size = hashlib.sha256(), 0
    parts = sorted(p for p in path.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))) if path.is_dir() else [path]
    for part in parts:
        with part.open("rb") as f:
            while chunk := f.read(1 << 22):
                digest.update(chunk)
                size += len(chunk)
    return {"path": path.name, "size_bytes": size, "sha256": digest.hexdigest()}


def write_manifest(folder: Path, manifest: Mapping, artifacts: Iterable[str]) -> dict:
    """manifest.json with descriptors of the artifacts and of itself; its own hash is taken with 64 zeroes in its place."""
    own = {"path": "manifest.json", "size_bytes": 0, "sha256": ZEROES, "checksum_basis": "this file with its own sha256 as 64 zeroes"}
    value = dict(manifest) | {"output_artifacts": [own, *(descriptor(folder / a) for a in artifacts)]}
    for _ in range(10):
        size = len(json_bytes(value))
        if own["size_bytes"] == size:
            break
        own["size_bytes"] = size
    else:
        raise ValueError("the size of the manifest does not settle")
    own["sha256"] = hashlib.sha256(json_bytes(value)).hexdigest()
    write_json(folder / "manifest.json", value)
    return value


def manifest_problems(folder: Path) -> list[str]:
    """Names of artifacts that don't match their descriptors."""
    value = json.loads((folder / "manifest.json").read_bytes())
    own, *others = value["output_artifacts"]
    out = [d["path"] for d in others if descriptor(folder / d["path"]) != d]
    claimed, own["sha256"] = own["sha256"], ZEROES
    if hashlib.sha256(json_bytes(value)).hexdigest() != claimed:
        out.append("manifest.json")
    return out


class Run:
    """A run's folder, made once; a run that was interrupted may be resumed if nothing that it depends on has changed."""

    def __init__(self, root: str | Path, run_id: str):
        if not run_id or "/" in run_id or run_id.startswith("."):
            raise ValueError("a run id is one path component")
        self.folder, self.run_id = Path(root) / run_id, run_id

    def start(self, **fixed: object) -> None:
        self.folder.mkdir(parents=True, exist_ok=False)
        self.write("running", fixed)

    def write(self, status: str, fixed: Mapping) -> None:
        if status not in STATES:
            raise ValueError(status)
        write_json(self.folder / "run_state.json", {"run_id": self.run_id, "run_status": status, "fixed": dict(fixed)})

    def state(self) -> dict:
        return json.loads((self.folder / "run_state.json").read_bytes())

    def resume(self, **fixed: object) -> None:
        state = self.state()
        if state["run_status"] == "completed":
            raise ResumeError("a completed run is immutable")
        if state["run_id"] != self.run_id or state["fixed"] != json.loads(json.dumps(fixed)):
            changed = [k for k in {*fixed, *state["fixed"]} if state["fixed"].get(k) != fixed.get(k)]
            raise ResumeError(f"changed since the run began: {sorted(changed) or 'run_id'}")
        if (self.folder / "manifest.json").exists():
            raise ResumeError("the run already has its final artifacts")
        self.write("running", fixed)

    def finish(self, status: str = "completed") -> None:
        self.write(status, self.state()["fixed"])
