"""Opening documents on the executors: inspection, evidence and OCR, behind callables for the libraries.

An opener takes a path and returns an object with page_count, needs_pass, metadata (a dict), pdf_version and
text(page) and close(). The default one needs the optional PyMuPDF; without it every document reports
missing_pdf_library. An OCR engine takes (path, page, dpi) and returns detections (box, text, score). Only what is
picklable crosses to the executors: the callables themselves. A failure of one document is a row with its errors.
"""

from __future__ import annotations

import hashlib
import os
import re
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 4 << 20
METADATA = {"title": "metadata_title", "author": "metadata_author", "subject": "metadata_subject", "keywords": "metadata_keywords", "creator": "metadata_creator", "producer": "metadata_producer", "creationDate": "metadata_creation_date", "modDate": "metadata_modification_date"}
_ERROR = "array<struct<stage:string,error_category:string,error_message:string>>"
RECORD = (
    "file_instance_id string, size_bytes long, mtime_ns long, sha256 string, hash_status string, pdf_open_status string, pdf_status string, is_encrypted boolean, pdf_version string, page_count long, "
    + ", ".join(f"{c} string" for c in METADATA.values())
    + f", sampled_page_count long, sampled_text_char_count long, text_layer_status string, source_changed_during_run boolean, inventory_status string, errors {_ERROR}"
)


class MissingLibrary(RuntimeError):
    pass


def open_with_pymupdf(path: str):
    try:
        import fitz
    except ImportError as e:
        raise MissingLibrary(str(e)) from e
    document = fitz.open(path)
    document.text = lambda page: document.load_page(page).get_text("text")
    return document


def sha256_of(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while chunk := f.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def _error(stage: str, category: str, e: object) -> dict:
    return {"stage": stage, "error_category": category, "error_message": str(e)[:500]}


def layer(counts: list[int], failures: int, threshold: int) -> str:
    """Like functions.text.text_layer_status, for one document."""
    if failures:
        return "mixed_or_uncertain" if counts else "check_failed"
    if counts and not any(counts):
        return "text_absent"
    return "text_present" if counts and min(counts) >= threshold else "mixed_or_uncertain"


def inspect(path: str, opener: Callable, threshold: int = 50, zero_is_invalid: bool = True) -> dict:
    """What opening one document shows; errors are collected, not raised."""
    out: dict = {"pdf_open_status": "failed", "pdf_status": "corrupted_or_invalid", "text_layer_status": "check_failed", "sampled_page_count": 0, "errors": []}
    try:
        document = opener(path)
    except MissingLibrary as e:
        return out | {"pdf_open_status": "not_attempted", "pdf_status": None, "errors": [_error("pdf_open", "missing_pdf_library", e)]}
    except Exception as e:
        return out | {"errors": [_error("pdf_open", type(e).__name__, e)]}
    try:
        out |= {"pdf_open_status": "success", "is_encrypted": bool(document.needs_pass)}
        if document.needs_pass:
            return out | {"pdf_status": "encrypted"}
        out |= {"pdf_status": "valid", "page_count": int(document.page_count)}
        version = getattr(document, "pdf_version", None)
        version = version() if callable(version) else version
        out["pdf_version"] = None if version is None else str(version)
        if isinstance(document.metadata or {}, dict):
            out |= {column: (document.metadata or {}).get(k) for k, column in METADATA.items()}
        else:
            out["errors"].append(_error("metadata", "metadata_parse", "metadata is no mapping"))
        n = out["page_count"]
        if n == 0:
            return out | {"pdf_status": "corrupted_or_invalid" if zero_is_invalid else "valid", "errors": [*out["errors"], _error("text_sample", "zero_page_count", "no readable pages")]}
        counts, failures = [], 0
        for page in dict.fromkeys((0, n // 2, n - 1)):
            out["sampled_page_count"] += 1
            try:
                counts.append(len(document.text(page).strip()))
            except Exception as e:
                failures += 1
                out["errors"].append(_error("text_sample", type(e).__name__, e))
        return out | {"sampled_text_char_count": sum(counts), "text_layer_status": layer(counts, failures, threshold)}
    except Exception as e:
        out["errors"].append(_error("metadata", type(e).__name__, e))
        return out
    finally:
        document.close()


def examine(path: str, opener: Callable, threshold: int = 50, retries: int = 2, backoff: tuple = (0.5, 2.0), retryable: Callable | None = None) -> dict:
    """Stat, hash, inspection and stat again of one file; tried again while all its errors may pass."""
    for attempt in range(retries + 1):
        row = _examined(path, opener, threshold)
        if not (row["errors"] and retryable and all(map(retryable, row["errors"]))) or attempt == retries:
            return row
        time.sleep(backoff[min(attempt, len(backoff) - 1)])
    return row


def _examined(path: str, opener: Callable, threshold: int) -> dict:
    row: dict = {"hash_status": "not_attempted", "source_changed_during_run": False, "text_layer_status": "check_failed", "errors": []}
    try:
        before = os.stat(path)
    except OSError as e:
        return row | {"inventory_status": "failed", "errors": [_error("stat_before", type(e).__name__, e)]}
    row |= {"size_bytes": before.st_size, "mtime_ns": before.st_mtime_ns}
    errors = []
    try:
        row |= {"sha256": sha256_of(path), "hash_status": "success"}
    except OSError as e:
        row["hash_status"] = "failed"
        errors.append(_error("hash", type(e).__name__, e))
    seen = inspect(path, opener, threshold)
    errors += seen.pop("errors")
    row |= seen
    try:
        after = os.stat(path)
        if (before.st_size, before.st_mtime_ns) != (after.st_size, after.st_mtime_ns):
            row["source_changed_during_run"] = True
            errors.append(_error("source_consistency", "source_changed_during_run", "size or time changed"))
    except OSError as e:
        errors.append(_error("source_consistency", type(e).__name__, e))
    return row | {"errors": errors, "inventory_status": "partial" if errors else "success"}


def _mapped(df: DataFrame, one: Callable[[dict], dict], schema: str) -> DataFrame:
    """One row for each row, by a function of the row as a dict."""
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def work(batches):
        for batch in batches:
            rows = [one(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([{k: r.get(k) for k in arrow.names} for r in rows], schema=arrow)

    return df.mapInArrow(work, target)


def examined(tasks: DataFrame, opener: Callable = open_with_pymupdf, threshold: int = 50) -> DataFrame:
    """Records of tasks (file_instance_id, path)."""
    from sieveline.operators.snapshots import RETRYABLE_CATEGORIES, RETRYABLE_STAGES

    def may_pass(e: dict) -> bool:
        return e["stage"] in RETRYABLE_STAGES and e["error_category"] in RETRYABLE_CATEGORIES

    return _mapped(tasks.select("file_instance_id", "path"), lambda r: examine(r["path"], opener, threshold, retryable=may_pass) | {"file_instance_id": r["file_instance_id"]}, RECORD)


EVIDENCE = "calibration_item_id string, evidence_status string, evidence_text string, evidence_page_indices array<int>, evidence_char_count long, raw_text_char_count long, evidence_truncated boolean, source_size_before long, source_mtime_ns_before long, source_size_after long, source_mtime_ns_after long, source_changed_during_evidence boolean, evidence_error_stage string, evidence_error_category string"


def evidence_of(task: dict, opener: Callable, pages: tuple = (0, 1, 2), cap: int = 12000) -> dict:
    """Evidence of one task (calibration_item_id, path, size_bytes, mtime_ns, page_count, not_applicable)."""
    row: dict = {"calibration_item_id": task["calibration_item_id"], "evidence_status": "failed", "source_changed_during_evidence": False}
    fail = lambda stage, category: row.setdefault("evidence_error_stage", stage) and row.setdefault("evidence_error_category", category)
    path = task["path"]
    try:
        before = os.stat(path)
    except OSError as e:
        fail("stat_before", type(e).__name__)
        return row
    row |= {"source_size_before": before.st_size, "source_mtime_ns_before": before.st_mtime_ns}
    if task.get("size_bytes") is not None and (before.st_size, before.st_mtime_ns) != (task["size_bytes"], task["mtime_ns"]):
        row["source_changed_during_evidence"] = True
        fail("source_consistency", "source_changed")
    elif task.get("not_applicable"):
        row["evidence_status"] = "not_applicable"
    else:
        document = None
        try:
            document = opener(path)
            n = int(document.page_count)
            if task.get("page_count") not in (None, n):
                fail("page_count_validation", "page_count_changed")
            else:
                texts, failures = [], []
                for k in (k for k in pages if k < n):
                    try:
                        texts.append((k, document.text(k).replace("\r\n", "\n").replace("\r", "\n")))
                    except Exception as e:
                        failures.append(e)
                whole = "\n".join(f"<<<PAGE:{k}>>>\n{t}" for k, t in texts)
                row |= {"evidence_text": whole[:cap], "evidence_page_indices": [k for k, _ in texts], "evidence_char_count": len(whole[:cap]), "raw_text_char_count": sum(len(t) for _, t in texts), "evidence_truncated": len(whole) > cap}
                row["evidence_status"] = "success" if not failures else "partial" if texts else "failed"
                if failures:
                    fail("page_text", type(failures[0]).__name__)
        except Exception as e:
            fail("evidence_extraction", type(e).__name__)
        finally:
            if document is not None:
                document.close()
    try:
        after = os.stat(path)
        row |= {"source_size_after": after.st_size, "source_mtime_ns_after": after.st_mtime_ns}
        if (before.st_size, before.st_mtime_ns) != (after.st_size, after.st_mtime_ns):
            row["source_changed_during_evidence"] = True
            fail("source_consistency", "source_changed")
    except OSError as e:
        row["source_changed_during_evidence"] = True
        fail("source_consistency", type(e).__name__)
    return row


def evidence(tasks: DataFrame, opener: Callable = open_with_pymupdf, pages: tuple = (0, 1, 2), cap: int = 12000) -> DataFrame:
    return _mapped(tasks, lambda r: evidence_of(r, opener, pages, cap), EVIDENCE)


OCR = "path string, page int, render_dpi int, detections array<struct<box:array<struct<x:double,y:double>>,text:string,score:double>>, seconds double, error string"


def recognised(tasks: DataFrame, engine: Callable, dpi: int = 200) -> DataFrame:
    """Detections of tasks (path, page); `reading_order` puts them in order."""

    def one(r: dict) -> dict:
        began, out = time.monotonic(), {"path": r["path"], "page": r["page"], "render_dpi": dpi, "detections": []}
        try:
            found = engine(r["path"], r["page"], dpi)
            out["detections"] = [{"box": [{"x": float(x), "y": float(y)} for x, y in box or ()], "text": text, "score": score} for box, text, score in found]
        except Exception as e:
            out["error"] = re.sub(r"\s+", " ", str(e))[:240]
        return out | {"seconds": time.monotonic() - began}

    return _mapped(tasks.select("path", "page"), one, OCR)
