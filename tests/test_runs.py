"""Discovery, sinks and whole runs over a small tree of fake documents."""

import json
import os
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sieveline import config, schemas
from sieveline.operators.annotation import DOMAINS
from sieveline.plans import runs
from sieveline.sources import labels, providers, provenance, sinks
from sieveline.sources.discovery import discover
from sieveline.sources.documents import MissingLibrary, inspect, recognised
from sieveline.sources.jsonl import read_jsonl, strict_lines
from sieveline.streaming import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't import the tests


class Fake:
    """A document whose pages are the parts of a text file between form feeds; 'broken' doesn't open."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            body = f.read()
        if body == "broken":
            raise ValueError("no document")
        self.pages = body.split("\f") if body else []
        self.page_count, self.needs_pass, self.metadata = len(self.pages), body == "locked", {"title": "T"}

    def text(self, page):
        return self.pages[page]

    def close(self):
        pass


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "source"
    for g in ("a", "b"):
        (root / g).mkdir(parents=True)
        for i in range(6):
            (root / g / f"【2024-0{i + 1}】{g}{i}.pdf").write_text("word " * 30 + ("\f" + "more " * 30) * (i % 3) + (g if i else ""))
    (root / "a" / ".hidden.PDF").write_text("broken")
    (root / "a" / "empty.pdf").write_text("")
    (root / "top\nline.pdf").write_text("x" * 60)
    (root / "a" / "note.txt").write_text("no")
    os.symlink(root / "top\nline.pdf", root / "b" / "link.pdf")
    return root


def settings(tmp_path, tree, **more):
    return config.Config((config.Root("r", str(tree)),), str(tmp_path / "out"), batch_size=4, main_target=6, main_base=1, **more)


def test_discovery(spark, tree):
    rows = {r["relative_path"]: r for r in discover(spark, {"r": str(tree)}).collect()}
    assert len(rows) == 15 and "a/.hidden.PDF" in rows and "b/link.pdf" not in rows
    assert rows["top\nline.pdf"]["parent_group"] == "" and rows["a/empty.pdf"]["size_bytes"] == 0
    assert rows["a/.hidden.PDF"]["extension"] == ".PDF"
    with pytest.raises(ValueError, match="no source root"):
        discover(spark, {})


def test_stopped_run_resumes_and_calibrates(spark, tmp_path, tree):
    own = settings(tmp_path, tree)
    state = runs.inventory(spark, own, "run-1", Fake, expected=(15, 3), stop_after=1)
    assert state["run_status"] == "interrupted"
    with pytest.raises(sinks.ResumeError):
        sinks.Run(own.output_root, "run-1").resume(config="other")
    stats = runs.inventory(spark, own, "run-1", Fake, resume=True)
    assert (stats["total_files"], stats["partial_files"], stats["zero_page_count"], stats["verdict"]) == (15, 2, 1, "PASS")
    folder = tmp_path / "out" / "run-1"
    assert sinks.manifest_problems(folder) == []
    files = schemas.read_exactly(spark, f"file://{folder}/files.parquet", schemas.FILES, 15)
    assert files.where("filename_parse_status = 'matched'").count() == 12
    assert spark.read.parquet(f"file://{folder}/duplicate_groups.parquet").count() == 10
    with pytest.raises(sinks.ResumeError, match="immutable"):
        runs.inventory(spark, own, "run-1", Fake, resume=True)
    out = runs.calibration(spark, own, "run-1", "cal-1", Fake)
    assert out["verdict"] == "PASS" and out["evidence"]["not_applicable"] == 2
    lines = [json.loads(x) for p in sorted((tmp_path / "out" / "cal-1" / "calibration_evidence.jsonl").glob("part-*")) for x in p.read_text().splitlines()]
    assert all(x["evidence_text"].startswith("<<<PAGE:0>>>\n") for x in lines if x["evidence_status"] == "success")
    with pytest.raises(schemas.SchemaError):
        schemas.read_exactly(spark, f"file://{folder}/files.parquet", schemas.ERRORS)


def test_gate_stops_before_any_output(spark, tmp_path, tree):
    with pytest.raises(runs.GateError):
        runs.inventory(spark, settings(tmp_path, tree), "run-2", Fake, expected=(14, 3))
    assert not (tmp_path / "out").exists()


def test_outputs_stay_out_of_sources(tmp_path):
    for out in (tmp_path, tmp_path / "s", tmp_path / "s" / "x"):
        with pytest.raises(sinks.UnsafePath):
            sinks.safe_output([tmp_path / "s"], out)
    assert sinks.safe_output([tmp_path / "s"], tmp_path / "o") == (tmp_path / "o").resolve()


def test_manifest_hashes_itself(tmp_path):
    (tmp_path / "a.json").write_text("{}")
    sinks.write_manifest(tmp_path, {"x": 1}, ["a.json"])
    assert sinks.manifest_problems(tmp_path) == []
    (tmp_path / "a.json").write_text("{ }")
    assert sinks.manifest_problems(tmp_path) == ["a.json"]


def test_empty_artifacts_keep_their_schema(spark, tmp_path):
    for name, schema in (("f", schemas.FILES), ("d", schemas.DUPLICATES), ("e", schemas.ERRORS)):
        sinks.write_table(schemas.empty(spark, schema), f"file://{tmp_path}/{name}", schema)
        assert schemas.read_exactly(spark, f"file://{tmp_path}/{name}", schema, 0).columns == schema.names
    assert (len(schemas.FILES), len(schemas.SAMPLE)) == (36, 27)


def test_missing_library_is_a_row(tmp_path):
    def none(path):
        raise MissingLibrary("no library")

    out = inspect("x", none)
    assert (out["pdf_open_status"], out["errors"][0]["error_category"]) == ("not_attempted", "missing_pdf_library")


def test_ocr_failures_are_rows(spark):
    def engine(path, page, dpi):
        if page:
            raise RuntimeError("no  engine")
        return [([(0, 1)], "t", 0.5)]

    rows = recognised(spark.createDataFrame([("p", 0), ("p", 1)], "path string, page int"), engine).orderBy("page").collect()
    assert rows[0]["detections"][0]["text"] == "t" and rows[1]["error"] == "no engine"


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("source_roots: [{source_root_id: r, path: /data}]\noutput_root: /out\nthreshold: 40\n")
    assert config.load(path).threshold == 40
    for bad in ("source_roots: []\noutput_root: /o\n", "source_roots: [{source_root_id: r, path: rel}]\noutput_root: /o\n", "source_roots: [{source_root_id: r, path: /d}]\noutput_root: /o\nmy_api_key: x\n", "[]"):
        path.write_text(bad)
        with pytest.raises(config.ConfigError):
            config.load(path)


def test_json_lines(spark, tmp_path):
    lines = spark.createDataFrame([(1, '{"a":1}'), (2, ""), (3, "[1]"), (4, None)], "line long, value string")
    assert [r["ok"] for r in strict_lines(lines).orderBy("line").collect()] == [True, False, False, False]
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\n{"a": 2}\n')
    schema = spark.createDataFrame([], "a int").schema
    with pytest.raises(Exception, match="not a JSON object"):
        read_jsonl(spark, f"file://{path}", schema).collect()
    path.write_text('{"a": 1}\n{"a": 2}\n')
    assert [r["a"] for r in read_jsonl(spark, f"file://{path}", schema).collect()] == [1, 2]


def test_last_batch_counts(spark, tmp_path):
    for b, v in ((1, "old"), (2, "new")):
        spark.createDataFrame([("x", v)], "file_instance_id string, v string").write.parquet(f"file://{tmp_path}/batch_id={b}")
    rows = batches.results(spark, f"file://{tmp_path}").select("v", F.col("batch_id")).collect()
    assert [(r["v"], r["batch_id"]) for r in rows] == [("new", 2)]


def test_sample_stages_leave_out_earlier_ones(spark, tmp_path, tree):
    own = settings(tmp_path, tree)
    one = runs.sample(spark, own, "d1", "d1-1", opener=Fake)
    assert one["total_files"] == 3 and one["verdict"] == "PASS" and one["files_per_second"] > 0
    with pytest.raises(runs.GateError):
        runs.sample(spark, own, "d2", "d2-0", opener=Fake)
    two = runs.sample(spark, own, "d2", "d2-1", ["d1-1"], opener=Fake)
    assert two["total_files"] == 12 and two["earlier_snapshot"] == {"run_id": "d1-1", "same_totals": True}
    first, second = (set(labels.sample_ids(own.output_root, r, lambda a, b: str(uuid.uuid5(uuid.NAMESPACE_URL, f"corpus://file-instance/{a}/{b}")))) for r in ("d1-1", "d2-1"))
    assert len(first) == 3 and not first & second
    (tree / "b" / "【2024-07】new.pdf").write_text("word " * 40)
    three = runs.sample(spark, own, "d3", "d3-1", ["d1-1", "d2-1"], target=5, opener=Fake)
    assert three["total_files"] == 1 and three["earlier_snapshot"] == {"run_id": "d2-1", "same_totals": False}
    assert sinks.manifest_problems(tmp_path / "out" / "d3-1") == []


def test_sample_manifests_are_checked(tmp_path):
    (tmp_path / "r").mkdir()
    for value in ({"run_id": "x", "items": []}, {"run_id": "r", "items": []}, {"run_id": "r", "items": [{}]}, {"run_id": "r", "count": 2, "items": [{"file_instance_id": "i"}]}):
        (tmp_path / "r" / "sample_manifest.json").write_text(json.dumps(value))
        with pytest.raises(labels.InputError):
            labels.sample_ids(tmp_path, "r", lambda root, path: "i")
    assert labels.sample_ids(tmp_path, "r") == ["i"]
    for bad in ("", "../r", "missing"):
        with pytest.raises(labels.InputError):
            labels.sample_ids(tmp_path, bad)


def test_latest_snapshot_is_of_the_same_roots(tmp_path):
    for name, roots in (("full-1", {"a": "/x"}), ("full-2", {"a": "/y"}), ("full-3", {"b": "/x"}), ("other-9", {"a": "/x"})):
        (tmp_path / name).mkdir()
        value = labels.snapshot_json({"": [1, 2, 3]}, roots)
        assert labels.snapshot_from(value) == (roots, {"": [1, 2, 3]})
        (tmp_path / name / "source_snapshot.json").write_text(json.dumps(value))
    (tmp_path / "full-4").mkdir()
    (tmp_path / "full-4" / "source_snapshot.json").write_text("broken")
    assert labels.latest_snapshot(tmp_path, {"a": "/z"}, "full-")[0] == "full-2"
    assert labels.latest_snapshot(tmp_path, {"c": "/z"}) is None


def test_review_labels_and_taxonomy(spark, tmp_path):
    path = tmp_path / "l.yaml"
    item = "- {relative_path: p%d, sufficiency: %s, quality_labels: [x]}\n"
    path.write_text("reviewed_items:\n" + "".join(item % (i, "borderline") for i in range(20)))
    assert labels.review_labels(spark, path).count() == 20
    for bad in ("reviewed_items:\n" + item % (1, "good"), "reviewed_items:\n" + (item % (1, "sufficient")) * 2, "reviewed_items:\n" + item % (1, "sufficient"), "[]"):
        path.write_text(bad)
        with pytest.raises(labels.InputError):
            labels.review_labels(spark, path)
    value = {"taxonomy_revision": "t1", "domains": [{"domain_id": c, "name": c.lower()} for c in DOMAINS]}
    path.write_text(json.dumps(value | {"payload_hash": labels.payload_hash(value)}))
    assert [r["code"] for r in labels.taxonomy(spark, path, DOMAINS).orderBy("place").collect()] == list(DOMAINS)
    for broken in (value | {"payload_hash": "0"}, {"domains": value["domains"][::-1], "payload_hash": labels.payload_hash({"domains": value["domains"][::-1]})}):
        path.write_text(json.dumps(broken))
        with pytest.raises(labels.InputError):
            labels.taxonomy(spark, path, DOMAINS)


def test_provenance_never_fails(tmp_path):
    assert provenance.git(tmp_path / "none") == ("unknown", True)
    machine = provenance.machine(tmp_path / "none" / "deeper")
    assert machine["disk_total_bytes"] > 0 and machine["tool_versions"]["pyspark"] != "not_installed"
    assert provenance.memory("MemAvailable: 5 kB\nSwapTotal: 0 kB\n")["swap_status"] == "disabled" and provenance.memory("")["swap_status"] == "unavailable"
    assert provenance.memory("SwapTotal: 3 kB\nSwapFree: 1 kB")["swap_free_bytes"] == 1024


def test_tables_are_whole_or_absent(spark, tmp_path):
    schema = schemas.DUPLICATES
    broken = schemas.empty(spark, schema).union(spark.range(1).select(F.lit("g"), F.lit("s"), F.raise_error(F.lit("stop")).cast("long"), F.lit("f"), F.lit(True)))
    with pytest.raises(Exception, match="stop"):
        sinks.write_table(broken, f"file://{tmp_path}/t", schema)
    assert list(tmp_path.iterdir()) == []
    sinks.write_table(schemas.empty(spark, schema), f"file://{tmp_path}/t", schema)
    with pytest.raises(FileExistsError):
        sinks.write_table(schemas.empty(spark, schema), f"file://{tmp_path}/t", schema)


def test_signals_stay_out_of_the_canonical_run(spark, tmp_path):
    rows = spark.createDataFrame([("i", True, "text 1"), ("j", False, None)], "calibration_item_id string, evidence_text_available boolean, evidence_text string")
    with pytest.raises(sinks.UnsafePath):
        runs.write_signals(rows, f"file://{tmp_path}/run/signals", str(tmp_path / "run"))
    runs.write_signals(rows, f"file://{tmp_path}/signals", str(tmp_path / "run"))
    assert {r["total_chars"] for r in spark.read.parquet(f"file://{tmp_path}/signals").collect()} == {6, None}


def test_rule_text_reads_back():
    from sieveline.operators.routing import rule_text

    assert rule_text("printable_char_ratio", "<=", 0.9258285113098369) == "printable_char_ratio <= 0.9258285113098369"
    assert float(rule_text("control_char_rate", ">=", 0.1).split()[-1]) == 0.1


def test_staged_tables_need_a_shared_folder():
    from types import SimpleNamespace

    from sieveline.sources import staging

    cluster = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="other", master="spark://host:7077"), conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError, match="shared folder"):
        staging.shared_folder(cluster)


def test_providers_are_probed_apart():
    a, b = providers.Provider("one", "alpha-2", "http://a/v1", "KEY_A"), providers.Provider("two", "beta-1", "http://b/v1", "KEY_B")
    seen = []

    def requester(method, url, headers, payload):
        seen.append((url, headers["Authorization"]))
        if method == "GET":
            return providers.Reply(200, {"data": [{"id": "alpha-1"}, "alpha-2", {"id": "gamma"}, 3]})
        if payload.get("response_format", {}).get("type") == "json_schema" and "b/" in url:
            return providers.Reply(400, {"error": "response_format is not supported"})
        return providers.Reply(200, {"model": payload["model"], "choices": []})

    valid = lambda text: "choices" in text
    for variables, error in (({"KEY_A": "x"}, "credentials_missing"), ({"KEY_A": "x", "KEY_B": "x"}, "credential_isolation_failed")):
        assert providers.dual_preflight(a, b, variables, requester, "p", valid)["error"] == error and not seen
    keys = {"KEY_A": "x", "KEY_B": "y"}
    out = providers.dual_preflight(a, b, keys, requester, "p", valid)
    assert out["passed"] and [[r["mode"] for r in rows] for rows in out["attempts"]] == [["json_schema"], ["json_schema", "json_object"]]
    assert {key for url, key in seen if "a/" in url} == {"Bearer x"} and "x" not in json.dumps(out["keys_present"].popitem()[0])
    found = providers.discover(a, keys, requester)
    assert found["accessible"] and found["relevant_models"] == ["alpha-1", "alpha-2"]
    assert providers.discover(b, keys, None, verified=["other"])["error"] == "model_missing"

    def failing(*request):
        raise OSError("no route")

    assert providers.identity(a, keys, failing)["failure"] == "transport_error"
    wrong = providers.identity(a, keys, lambda *r: providers.Reply(200, {"model": "alpha-1"}))
    assert wrong["failure"] == "resolved_model_mismatch" and not wrong["passed"]
    assert providers.identity(a, keys, lambda *r: providers.Reply(401))["failure"] == "auth_error"
    assert providers.model_excerpt(["m"] * 3 + ["alpha-9"] * 30, "alpha-2") == ["alpha-9"] * 20
