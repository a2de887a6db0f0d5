"""Queries over evaluation items, datasets, provider records and retries."""

from __future__ import annotations

import copy
import json

from pyspark.sql import functions as F

from sieveline.operators import annotation as A, items as I
from sieveline.plans.annotation_queries import PAIRS, annotations, choose, choose_sql
from sieveline.plans.corpus import Registry, documents, every, table

registry = query = Registry()

_EVIDENCE = {"evidence_id": "e1", "document_id": 1, "bbox": [0, 0, 1, 1], "coordinate_system": "pdf", "origin": "top", "page_index": 0, "page_width": 1, "page_height": 1}
_VALID = {
    "item_revision": 2, "item_status": "accepted", "track": "T1", "capability": "K1", "secondary_capabilities": ["K2"], "assets": [], "answer_type": "single_choice", "options": [{"option_id": "a", "content": "x"}, {"option_id": "b", "content": "y"}],
    "correct_option_ids": ["a"], "provenance_type": "source_grounded", "evidence": [_EVIDENCE], "primary_evidence_id": "e1", "pilot_validated": False, "content_hash": "h", "released_hash": "h", "released_revision": 2, "revisions": [1, 2],
    "membership_revisions": [1], "quality_summary": "passed", "verified_revision": 2, "calculation_agrees": True, "verification_passed": True,
}
_NUMERIC = {"answer_type": "numeric", "unit_policy": "explicit_unit_required", "truth": {"value": 1.5, "unit": "N*m", "dimensionless": False, "rounding_rule": "none", "accepted_unit_conversions": []}}
_T3 = {"track": "T3", "capability": "M11", "assets": [{"asset_id": "x", "source_evidence_id": "e1"}], "has_multimodal": True, "visual_dependency": True}
#: valid items, and changes of a valid one that break one rule each
VALID = ({}, _NUMERIC, _T3)
BROKEN = {
    "t1_capability": {"capability": "C1"}, "t2_capability": {"track": "T2", "capability": "K1"}, "t3_capability_or_asset": _T3 | {"assets": []}, "t3_visual_dependency": _T3 | {"visual_dependency": False},
    "options": {"options": []}, "single_choice": {"correct_option_ids": ["a", "b"]}, "multiple_choice": {"answer_type": "multiple_choice", "correct_option_ids": ["c"]}, "numeric_truth": _NUMERIC | {"truth": {"value": 1.5, "unit": "N*m", "dimensionless": False}},
    "grounded_without_evidence": {"evidence": [], "primary_evidence_id": None}, "evidence_document": {"evidence": [_EVIDENCE | {"document_id": -1}]}, "bbox_context": {"evidence": [_EVIDENCE | {"origin": None}]},
    "rejection_reason": {"item_status": "rejected", "membership_revisions": []}, "difficulty_before_pilot": {"empirical_difficulty": 0.5}, "secondary_capability_repeats": {"secondary_capabilities": ["K1"]}, "released_revision": {"content_hash": "i"},
    "unit_xor_dimensionless": _NUMERIC | {"truth": _NUMERIC["truth"] | {"dimensionless": True}}, "primary_evidence": {"primary_evidence_id": "e9"}, "asset_evidence": {"assets": [{"asset_id": "x", "source_evidence_id": "e9"}]},
    "membership_revision": {"membership_revisions": [3]}, "membership_without_acceptance": {"item_status": "needs_review"}, "quality_without_verification": {"verified_revision": 1}, "calculation_conflict": {"calculation_agrees": False},
    "unit_policy": _NUMERIC | {"unit_policy": "dimensionless"},
}
_SHAPES = [json.dumps(copy.deepcopy(_VALID) | x, sort_keys=True) for x in (*VALID, *BROKEN.values())]


@query(f"SELECT doc_id AS item_id, {choose_sql(['', '', '', *BROKEN], 'doc_id')} AS violations FROM documents")
def item_violations(spark, sf_dir):
    """Every document is an item of one of the shapes."""
    d = documents(spark, sf_dir)
    shape = F.from_json(choose(_SHAPES, F.col("doc_id")), I.ITEM)
    rows = d.select("doc_id", shape.alias("x")).select("x.*", "doc_id").withColumn("item_id", F.col("doc_id")).drop("doc_id")
    known = d.select(F.col("doc_id").alias("document_id"))
    known = known.union(spark.range(1, 2).toDF("document_id"))
    return I.item_violations(rows, known).select("item_id", F.array_join("violations", ",").alias("violations"))


@query("""WITH a AS (SELECT doc_id, n_chars AS v, doc_id % 6 AS u, doc_id % 3 AS p FROM documents),
s AS (SELECT *, CASE WHEN p = 0 THEN CASE WHEN u IN (0, 5) THEN 'scored' ELSE 'ambiguous' END WHEN u IN (0, 5) THEN CASE WHEN p = 1 THEN 'scored' ELSE 'ambiguous' END WHEN u = 4 THEN 'ambiguous' WHEN u = 3 THEN 'incompatible' ELSE 'scored' END AS status,
  CASE WHEN u = 2 THEN v * 1000.0 ELSE v END AS x FROM a)
SELECT doc_id AS item_id, status, CASE status WHEN 'scored' THEN CASE WHEN abs(x - 1000) <= 200 THEN 1.0 ELSE 0.0 END WHEN 'incompatible' THEN 0.0 END AS score FROM s""")
def unit_scores(spark, sf_dir):
    units = spark.createDataFrame([("N*m", "torque", 1.0), ("kN*m", "torque", 1000.0), ("mm", "length", 0.001)], "unit string, dimension string, factor double")
    unit = F.element_at(F.array(*(F.lit(u).cast("string") for u in (None, "N*m", "kN*m", "mm", "furlong", None))), (F.col("doc_id") % 6 + 1).cast("int"))
    policy = choose(("dimensionless", "unit_specified_in_question", "explicit_unit_required"), F.col("doc_id"))
    answers = documents(spark, sf_dir).select(F.col("doc_id").alias("item_id"), F.col("n_chars").cast("double").alias("value"), unit.alias("unit"), F.lit(1000.0).alias("key"), F.lit("N*m").alias("key_unit"), policy.alias("policy"), F.lit(50.0).alias("absolute"), F.lit(0.2).alias("relative"))
    return I.unit_scores(answers, units)


_GRAMS = "list_filter(regexp_split_to_array(lower(text), '[^a-z0-9À-ɏ]+'), lambda x: x <> '')"


@query(f"""WITH d AS (SELECT doc_id, {_GRAMS} AS w FROM documents), b AS (SELECT item_id, {_GRAMS} AS w FROM benchmark),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 12], ' ') AS g FROM d, unnest(range(1, len(w) - 11)) AS r(i)), bg AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS g FROM b, unnest(range(1, len(w) - 11)) AS r(i))
SELECT doc_id AS document_id, item_id, count(*) AS shared FROM dg JOIN bg USING (g) GROUP BY 1, 2""")
def training_exclusions(spark, sf_dir):
    return I.training_exclusions(documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


_REVISIONS = "WITH r AS (SELECT doc_id AS item_id, v AS item_revision, CASE WHEN (doc_id + v) % 4 = 0 THEN 'needs_review' ELSE 'accepted' END AS item_status, sha256(text || v) AS content_hash FROM documents, (VALUES (1), (2), (3)) t(v) WHERE v <= 1 + doc_id % 3)"


def revisions(spark, sf_dir):
    v = F.explode(F.sequence(F.lit(1), (F.col("doc_id") % 3 + 1).cast("int")))
    rows = documents(spark, sf_dir).select("doc_id", "text", v.alias("item_revision"))
    status = F.when((F.col("doc_id") + F.col("item_revision")) % 4 == 0, "needs_review").otherwise("accepted")
    return rows.select(F.col("doc_id").alias("item_id"), "item_revision", status.alias("item_status"), F.sha2(F.concat("text", F.col("item_revision").cast("string")), 256).alias("content_hash"))


@query(_REVISIONS + " SELECT 'v1' AS dataset_version, item_id, item_revision, content_hash FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY item_revision DESC) AS k FROM r) WHERE k = 1 AND item_status = 'accepted'")
def dataset_membership(spark, sf_dir):
    return I.assembled(revisions(spark, sf_dir), "v1")


@query(_REVISIONS + """, m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY item_revision DESC) AS k FROM r) WHERE k = 1 AND item_status = 'accepted')
SELECT CASE WHEN item_id % 7 = 0 THEN 'revision_gone' ELSE 'content_changed' END AS violation, count(*) AS n FROM m WHERE item_id % 7 = 0 OR item_id % 5 = 0 GROUP BY 1""")
def dataset_freeze(spark, sf_dir):
    """Frozen memberships against items of which some are gone and some have changed."""
    r = revisions(spark, sf_dir)
    d = F.col("item_id")
    later = r.withColumn("item_revision", F.when(d % 7 == 0, F.col("item_revision") + 10).otherwise(F.col("item_revision"))).withColumn("content_hash", F.when(d % 5 == 0, "other").otherwise(F.col("content_hash")))
    return I.freeze_violations(I.assembled(r, "v1"), later)


@query("""WITH i AS (SELECT lang AS domain, source AS track, n_chars // 1000 AS capability, source, n_chars % 10 AS family FROM documents), t AS (SELECT domain, string_agg(track || ':' || n, ',' ORDER BY track) AS track_distribution FROM (SELECT domain, track, count(*) AS n FROM i GROUP BY 1, 2) GROUP BY 1)
SELECT d.domain, count(i.domain) AS item_count, count(DISTINCT capability) AS capability_count, count(DISTINCT source) AS source_count, count(DISTINCT family) AS document_family_count, coalesce(any_value(t.track_distribution), '') AS track_distribution, CASE WHEN count(i.domain) = 0 THEN 'insufficient_source' END AS reason
FROM (VALUES ('de'), ('en'), ('es'), ('fr'), ('xx')) d(domain) LEFT JOIN i ON i.domain = d.domain LEFT JOIN t ON t.domain = d.domain GROUP BY d.domain""")
def domain_coverage(spark, sf_dir):
    rows = documents(spark, sf_dir).select(F.col("lang").alias("domain"), F.col("source").alias("track"), F.floor(F.col("n_chars") / 1000).alias("capability"), "source", (F.col("n_chars") % 10).alias("family"))
    return I.domain_coverage(rows, spark.createDataFrame([(d, "insufficient_source") for d in ("de", "en", "es", "fr", "xx")], "domain string, reason string"))


@query(PAIRS + """, q AS (SELECT r.*, l.quality = 0 AS problem FROM r LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON r.doc_id = l.doc_id), t AS (SELECT ua OR fa AS a, ub OR fb AS b, coalesce(problem, false) AS problem FROM q)
SELECT count(*) FILTER (WHERE a) AS retry_triggered_by_a, count(*) FILTER (WHERE b) AS retry_triggered_by_b, count(*) FILTER (WHERE a OR b) AS retry_triggered_by_either, count(*) FILTER (WHERE (a OR b) AND NOT problem) AS false_retry_count, round(count(*) FILTER (WHERE (a OR b) AND NOT problem) / count(*) FILTER (WHERE NOT problem), 6) AS false_retry_rate,
  round((SELECT count(*) FILTER (WHERE event_id % 5 <> 0) / count(*) FROM events), 6) AS valid_structured_output_rate, (SELECT count(*) FILTER (WHERE event_id % 11 = 0) FROM events) AS format_retry_count FROM t""")
def dry_run_metrics(spark, sf_dir):
    problems = table(spark, sf_dir, "labels").where("quality = 0").select(F.col("doc_id").alias("item_id"))
    attempts = table(spark, sf_dir, "events").select((F.col("event_id") % 5 != 0).alias("schema_valid"), (F.col("event_id") % 11 == 0).alias("format_retry"))
    out = I.dry_run_metrics(A.pairs(annotations(spark, sf_dir)), problems, attempts)
    return out.withColumns({c: F.round(c, 6) for c in ("false_retry_rate", "valid_structured_output_rate")})


@query(PAIRS + """, x AS (SELECT doc_id, ua OR fa OR ub OR fb AS again FROM r)
SELECT doc_id AS item_id, side, CASE WHEN again THEN 2 ELSE 1 END AS annotation_pass FROM x, (VALUES ('a'), ('b')) v(side) WHERE NOT again OR doc_id % 7 <> 0""")
def final_view(spark, sf_dir):
    """The second pass has both sides of most items, and one side of the others."""
    first = annotations(spark, sf_dir)
    second = first.where(~((F.col("item_id") % 7 == 0) & (F.col("side") == "b")))
    return I.final_view(first, second, A.pairs(first)).select("item_id", "side", "annotation_pass")


@query("SELECT doc_id, 'run:' || doc_id || ':' || (doc_id % 3) AS annotation_record_id, concat_ws(',', CASE WHEN doc_id % 5 = 0 THEN 'superseded_reason' END, CASE WHEN doc_id % 7 = 0 THEN 'negative_output_tokens' END, CASE WHEN doc_id % 11 = 0 THEN 'response' END, CASE WHEN doc_id % 13 = 0 THEN 'missing_annotator_id' END) AS violations FROM documents")
def attempt_records(spark, sf_dir):
    d = F.col("doc_id")
    rows = documents(spark, sf_dir).select(
        "doc_id", F.lit("run").alias("run_id"), F.lit("sample").alias("sample_id"), d.cast("string").alias("item_id"), F.when(every(13), " ").otherwise("a").alias("annotator_id"), F.lit(1).alias("annotation_pass"), (d % 3).cast("string").alias("attempt_id"),
        every(2).alias("superseded"), F.when(every(2) != every(5), "replaced").alias("superseded_reason"), F.lit(1).alias("input_tokens"), F.when(every(7), -1).otherwise(1).alias("output_tokens"), F.lit(None).cast("int").alias("reasoning_tokens"), F.lit(5).alias("latency_ms"), F.lit(0).alias("retry_count"),
        every(3).alias("schema_valid"), F.when(every(3) != every(11), "{}").alias("response"),
    )
    return A.attempt_rows(rows).select("doc_id", "annotation_record_id", F.array_join(A.record_violations(), ",").alias("violations"))


@query("""WITH p AS (SELECT doc_id, '{"model":"m","messages":[{"role":"user","content":"item ' || doc_id || '"}],"max_tokens":64' AS head, doc_id % 4 AS m FROM documents)
SELECT doc_id, CASE m WHEN 0 THEN head || ',"response_format":{"type":"json_schema","json_schema":{"name":"taxonomy_annotation","strict":true,"schema":{}}}}' WHEN 1 THEN head || ',"response_format":{"type":"json_object"}}' WHEN 2 THEN head || '}' END AS payload FROM p""")
def request_payload(spark, sf_dir):
    mode = choose((*A.MODES, "other"), F.col("doc_id"))
    prompt = F.concat(F.lit("item "), F.col("doc_id").cast("string"))
    return documents(spark, sf_dir).select("doc_id", A.payload(F.lit("m"), prompt, mode, 64).alias("payload"))


@query(PAIRS + "SELECT doc_id AS item_id, concat_ws('; ', CASE WHEN ua THEN 'a.evidence_usability=' || usability_a END, CASE WHEN fa THEN 'a.taxonomy_fit=insufficient_evidence' END, CASE WHEN ub THEN 'b.evidence_usability=' || usability_b END, CASE WHEN fb THEN 'b.taxonomy_fit=insufficient_evidence' END) AS retry_reason, 'e1' AS source_evidence_revision, 'e2' AS final_evidence_revision, 200 AS render_dpi FROM r WHERE ua OR fa OR ub OR fb")
def evidence_retries(spark, sf_dir):
    rows = A.evidence_retry_rows(A.retry_decisions(A.pairs(annotations(spark, sf_dir))), "e1", "e2", "none", 200)
    return rows.select("item_id", "retry_reason", "source_evidence_revision", "final_evidence_revision", "render_dpi")


@query("""SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","none":null}') AS payload_hash FROM documents""")
def payload_hash(spark, sf_dir):
    value = F.struct("doc_id", "lang", F.lit(None).cast("string").alias("none"))
    return documents(spark, sf_dir).select("doc_id", I.canonical_hash(value).alias("payload_hash"))
