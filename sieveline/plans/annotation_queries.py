"""Queries over paired annotations and provider attempts, which follow from doc_id and the conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import annotation as A
from sieveline.plans.corpus import Registry, documents, every, files
from sieveline.plans.inventory_queries import EVIDENCE, EVIDENCE_CHARS, evidence_of

registry = query = Registry()


def choose(values, by):
    """One of the values, by a number."""
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


def choose_sql(values, by) -> str:
    return "CASE " + " ".join(f"WHEN ({by}) % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


SIDES = {"a": 1, "b": 2}


def annotations(spark, sf_dir):
    """Two annotations of every document."""
    d, out = F.col("doc_id"), None
    for side, k in SIDES.items():
        one = documents(spark, sf_dir).select(
            d.alias("item_id"), F.lit(side).alias("side"), choose(A.DOMAINS, d if k == 1 else d + F.when(every(13), 1).otherwise(0)).alias("primary_domain"),
            choose(A.TAXONOMY_FITS, F.floor(d / 6) + F.when(every(17) & F.lit(k == 2), 1).otherwise(0)).alias("taxonomy_fit"),
            choose(A.CONFIDENCES, F.floor(d / 5) + k).alias("confidence"), choose(("usable", "usable", "usable", "partially_usable", "unreadable", "insufficient", "usable"), F.floor(d / 3) + k).alias("evidence_usability"),
            F.array(choose(A.DOMAINS, d + 3), choose(A.DOMAINS, d + 3 + F.when(every(5) & F.lit(k == 2), 1).otherwise(0))).alias("secondary_domains"),
            *(F.when(every(29 + i) & F.lit(k == 2), "r2").otherwise("r1").alias(r) for i, r in enumerate(A.REVISIONS)), every(37).alias("peer_annotation_visible"), every(41).alias("superseded"), (d % 2).alias("retry_count"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def _side_sql(side: str) -> str:
    k = SIDES[side]
    extra = lambda n: f"CASE WHEN doc_id % {n} = 0 THEN 1 ELSE 0 END" if k == 2 else "0"
    revisions = ", ".join(f"CASE WHEN doc_id % {29 + i} = 0 AND {k} = 2 THEN 'r2' ELSE 'r1' END AS {r}_{side}" for i, r in enumerate(A.REVISIONS))
    return f"""{choose_sql(A.DOMAINS, f"doc_id + {extra(13)}")} AS domain_{side}, {choose_sql(A.TAXONOMY_FITS, f"doc_id // 6 + {extra(17)}")} AS fit_{side}, {choose_sql(A.CONFIDENCES, f"doc_id // 5 + {k}")} AS confidence_{side},
  {choose_sql(("usable", "usable", "usable", "partially_usable", "unreadable", "insufficient", "usable"), f"doc_id // 3 + {k}")} AS usability_{side}, (doc_id + 3) % 12 AS second_{side}, (doc_id + 3 + {extra(5)}) % 12 AS third_{side}, {revisions}"""


PAIRS = f"""WITH p AS (SELECT doc_id, {_side_sql("a")}, {_side_sql("b")} FROM documents),
r AS (SELECT *, usability_a IN ('unreadable', 'insufficient') AS ua, fit_a = 'insufficient_evidence' AS fa, usability_b IN ('unreadable', 'insufficient') AS ub, fit_b = 'insufficient_evidence' AS fb FROM p)
"""
_SAME = " AND ".join(f"{r}_a = {r}_b" for r in A.REVISIONS)


_REASONS = PAIRS + f""", s AS (SELECT doc_id, CASE WHEN doc_id % 41 = 0 THEN 'superseded' WHEN ua OR fa OR ub OR fb THEN 'evidence_retry_required' WHEN NOT ({_SAME}) OR doc_id % 37 = 0 THEN 'evidence_contract_differs' WHEN domain_a <> domain_b THEN 'primary_domain' WHEN fit_a <> fit_b THEN 'taxonomy_fit'
  WHEN fit_a = 'cross_domain' AND (least(second_a, third_a) <> least(second_b, third_b) OR greatest(second_a, third_a) <> greatest(second_b, third_b)) THEN 'secondary_domains' WHEN fit_a IN ('ambiguous', 'taxonomy_gap', 'out_of_scope', 'insufficient_evidence') THEN 'review_' || fit_a
  WHEN confidence_a = 'low' OR confidence_b = 'low' THEN 'low_confidence' ELSE 'agreed' END AS reason FROM r)
"""


@query(_REASONS + "SELECT doc_id AS item_id, CASE WHEN reason = 'agreed' THEN 'provisionally_agreed' ELSE 'conflict' END AS status, reason FROM s")
def agreement(spark, sf_dir):
    return A.agreement(A.pairs(annotations(spark, sf_dir)))


@query(_REASONS + """, x AS (SELECT s.reason, d.source AS parent_group, r.fit_a, r.fit_b FROM s JOIN r USING (doc_id) JOIN documents d USING (doc_id))
SELECT parent_group, count(*) AS items, """ + ", ".join(f"round((count(*) FILTER (WHERE fit_a = '{f}') + count(*) FILTER (WHERE fit_b = '{f}')) / (2 * count(*)), 6) AS {f}_rate" for f in A.TAXONOMY_FITS) + """,
  round(count(*) FILTER (WHERE reason = 'agreed') / count(*), 6) AS agreement_rate, round(count(*) FILTER (WHERE reason <> 'agreed') / count(*), 6) AS conflict_rate FROM x GROUP BY GROUPING SETS ((), (parent_group))""")
def calibration_metrics(spark, sf_dir):
    groups = documents(spark, sf_dir).select(F.col("doc_id").alias("item_id"), F.col("source").alias("parent_group"))
    out = A.calibration_metrics(A.pairs(annotations(spark, sf_dir)), groups)
    return out.select(*(F.round(c, 6).alias(c) if c.endswith("_rate") else c for c in out.columns))


@query(PAIRS + """SELECT doc_id AS item_id, ua OR fa OR ub OR fb AS required, ua OR fa AS triggered_by_a, ub OR fb AS triggered_by_b,
  concat_ws('; ', CASE WHEN ua THEN 'a.evidence_usability=' || usability_a END, CASE WHEN fa THEN 'a.taxonomy_fit=insufficient_evidence' END, CASE WHEN ub THEN 'b.evidence_usability=' || usability_b END, CASE WHEN fb THEN 'b.taxonomy_fit=insufficient_evidence' END) AS reasons,
  (ua OR fa OR ub OR fb) AND doc_id % 2 < 1 AS may_retry FROM r""")
def retry_decision(spark, sf_dir):
    return A.retry_decisions(A.pairs(annotations(spark, sf_dir)))


@query(PAIRS + "SELECT doc_id AS item_id, side FROM r, (VALUES ('a'), ('b')) v(side) WHERE ua OR fa OR ub OR fb")
def superseded(spark, sf_dir):
    return A.superseded(A.pairs(annotations(spark, sf_dir)))


@query("""WITH x AS (SELECT doc_id, doc_id % 11 = 0 AS bad_domain, doc_id % 13 = 0 AS many, doc_id % 7 = 0 AS own, doc_id % 17 = 0 AS words, doc_id % 19 = 0 AS blank, doc_id % 5 = 0 AS long, doc_id % 23 = 0 AS extra, doc_id % 29 = 0 AS lacks, doc_id % 31 = 0 AS broken FROM documents)
SELECT doc_id, CASE WHEN broken THEN 'not_an_object' ELSE concat_ws(',', CASE WHEN extra THEN 'unknown_field' END, CASE WHEN lacks THEN 'missing_field' END, CASE WHEN bad_domain THEN 'primary_domain' END, CASE WHEN many THEN 'secondary_domains_size' END, CASE WHEN many THEN 'secondary_domains_repeated' END,
  CASE WHEN own AND NOT bad_domain THEN 'secondary_domains_primary' END, CASE WHEN words THEN 'evidence_keywords_repeated' END, CASE WHEN blank THEN 'evidence_rationale' END, CASE WHEN long AND NOT blank THEN 'evidence_rationale_sentences' END) END AS violations FROM x""")
def annotation_validate(spark, sf_dir):
    second = F.when(every(13), F.array(*map(F.lit, ("D02", "D03", "D04", "D02")))).otherwise(F.array(F.lit("D02"), F.lit("D03")))
    second = F.when(every(7), F.concat(F.slice(second, 2, 9), F.array(F.lit("D01")))).otherwise(second)
    second = F.when(every(13) & every(7), F.array(*map(F.lit, ("D02", "D02", "D03", "D01")))).otherwise(second)
    fields = F.struct(
        F.when(every(11), "D99").otherwise("D01").alias("primary_domain"), second.alias("secondary_domains"), F.lit("clear_fit").alias("taxonomy_fit"), F.lit("high").alias("confidence"),
        F.when(~every(29), "usable").alias("evidence_usability"), F.when(every(17), F.array(F.lit("x"), F.lit("x"))).otherwise(F.array(F.lit("x"))).alias("evidence_keywords"),
        F.when(every(19), " ").when(every(5), "One. Two. Three. Four.").otherwise("One.").alias("evidence_rationale"), F.lit("note").alias("review_note"), F.when(every(23), 1).alias("other"),
    )
    text = F.when(every(31), "[1]").otherwise(F.to_json(fields))
    codes = A.violations(F.col("j"))
    # a missing field is one violation, whatever its value would have been
    return documents(spark, sf_dir).select("doc_id", text.alias("j")).select("doc_id", F.array_join(F.when(F.array_contains(codes, "missing_field"), F.array_remove(codes, "evidence_usability")).otherwise(codes), ",").alias("violations"))


@query("""SELECT conv_id, turn, CASE turn % 4 WHEN 3 THEN NULL ELSE '{"primary_domain":"D01","secondary_domains":["D02"],"n":' || turn || '}' END AS output, CASE WHEN turn % 3 = 0 THEN conv_id END AS input_tokens, CASE WHEN turn % 3 = 1 THEN conv_id + 1 END AS output_tokens FROM conversations""")
def json_extract(spark, sf_dir):
    turn = F.col("turn")
    inner = F.concat(F.lit('{"primary_domain":"D01","secondary_domains":["D02"],"n":'), turn.cast("string"), F.lit("}"))
    usage = F.when(turn % 3 == 0, F.concat(F.lit('"usage":{"prompt_tokens":null,"input_tokens":'), F.col("conv_id").cast("string"), F.lit("}"))).when(turn % 3 == 1, F.concat(F.lit('"usage":{"completion_tokens":'), (F.col("conv_id") + 1).cast("string"), F.lit("}"))).otherwise(F.lit('"usage":{"prompt_tokens":-1}'))
    quoted = F.to_json(F.struct(inner.alias("x")))
    text = F.regexp_extract(quoted, r'^\{"x":(.*)\}$', 1)
    body = F.when(turn % 4 == 0, F.concat(F.lit('"output_text":'), text)).when(turn % 4 == 1, F.concat(F.lit('"choices":[{"message":{"content":'), text, F.lit("}}]"))).when(turn % 4 == 2, F.concat(F.lit('"choices":[{"message":{"content":[{"type":"text","text":'), text, F.lit("}]}}]"))).otherwise(F.lit('"other":1'))
    response = F.concat(F.lit("{"), body, F.lit(","), usage, F.lit("}"))
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", response.alias("r"))
    tokens = A.usage(F.col("r"))
    return rows.select("conv_id", "turn", A.model_output(F.col("r")).alias("output"), tokens["input_tokens"].alias("input_tokens"), tokens["output_tokens"].alias("output_tokens"))


_ATTEMPTS = """WITH a AS (SELECT event_id, user_id AS provider, (event_id % 3)::INTEGER AS m, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 401 WHEN 2 THEN 400 WHEN 3 THEN 500 ELSE 200 END AS code, event_id % 11 <> 0 AS model_match, event_id % 5 <> 0 AS schema_valid, CASE WHEN event_id % 2 = 0 THEN 'schema' ELSE 'parse' END AS error_type,
  CASE WHEN event_id % 14 = 2 THEN 'response_format is not supported' ELSE 'bad  request' END AS message FROM events),
f AS (SELECT *, CASE WHEN NOT model_match THEN 'resolved_model_mismatch' WHEN code IN (401, 403) THEN 'auth_error' WHEN code IS NULL THEN 'transport_error' WHEN code = 400 AND event_id % 14 = 2 THEN 'unsupported_mode' WHEN code >= 400 THEN 'provider_error' WHEN NOT schema_valid AND error_type = 'schema' THEN 'schema_incompatible_mode' WHEN NOT schema_valid THEN 'parse_error' END AS failure FROM a)
"""


def attempts(spark, sf_dir):
    e = F.col("event_id")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("user_id").alias("provider"), choose(A.MODES, e).alias("mode"), F.when(e % 7 == 1, 401).when(e % 7 == 2, 400).when(e % 7 == 3, 500).when(e % 7 != 0, 200).alias("code"), (e % 11 != 0).alias("model_match"), (e % 5 != 0).alias("schema_valid"),
        F.when(e % 2 == 0, "schema").otherwise("parse").alias("error_type"), F.when(e % 14 == 2, "response_format is not supported").otherwise("bad  request").alias("message"),
    )
    unsupported = A.is_unsupported_format(F.col("code"), F.col("message"))
    return rows.withColumn("failure", A.failure_class(F.col("code"), F.col("model_match"), F.col("schema_valid"), unsupported, F.col("error_type")))


@query(_ATTEMPTS + "SELECT event_id, failure, regexp_replace(message, '\\s+', ' ', 'g') AS excerpt FROM f")
def failure_class(spark, sf_dir):
    return attempts(spark, sf_dir).select("event_id", "failure", A.message_excerpt(F.col("message")).alias("excerpt"))


@query(_ATTEMPTS + """, one AS (SELECT provider, m, arg_min(failure, event_id) FILTER (WHERE true) AS failure, min(event_id) AS id FROM f GROUP BY provider, m), last AS (SELECT o.provider, o.m, f.failure FROM one o JOIN f ON f.event_id = o.id),
e AS (SELECT *, failure IS NULL OR failure NOT IN ('unsupported_mode', 'schema_incompatible_mode', 'parse_error') AS ends FROM last), t AS (SELECT * FROM e x WHERE NOT EXISTS (SELECT 1 FROM e y WHERE y.provider = x.provider AND y.m < x.m AND y.ends))
SELECT provider, max(CASE WHEN failure IS NULL THEN CASE m WHEN 0 THEN 'json_schema' WHEN 1 THEN 'json_object' ELSE 'prompt_json_only' END END) AS mode, count(*) AS tried, arg_max(coalesce(failure, '-'), m) AS stopped_by FROM t GROUP BY provider""")
def negotiation(spark, sf_dir):
    first = attempts(spark, sf_dir).groupBy("provider", "mode").agg(F.min_by(F.struct("failure"), "event_id").alias("f")).select("provider", "mode", "f.failure")
    return A.negotiation(first).withColumn("stopped_by", F.coalesce("stopped_by", F.lit("-")))


_RULES, _TITLE = ["Use only the supplied evidence.", "Return one JSON object."], "ANNOTATION"
_HEAD = "\n".join([_TITLE, *_RULES, "", "TAXONOMY", *(f"- {d}: domain {d}" for d in A.DOMAINS), "", "DOCUMENT METADATA", ""])
_TAIL = "\n".join(["", "<<<END_FINAL_EVIDENCE>>>", "", "OUTPUT FIELDS", *A.FIELDS])


@query(EVIDENCE + f"""SELECT w.doc_id AS item_id, '{_HEAD}' || '{{"page_count":' || f.page_count || '}}' || chr(10) || chr(10) || 'EVIDENCE' || chr(10) || '<<<BEGIN_FINAL_EVIDENCE>>>' || chr(10) || substr(t, 1, {EVIDENCE_CHARS}) || '{_TAIL}' AS prompt FROM whole w JOIN files f ON f.doc_id = w.doc_id""")
def prompt_render(spark, sf_dir):
    """Prompts over the evidence that a run takes."""
    f = files(spark, sf_dir)
    requests = f.select(F.col("doc_id").alias("item_id"), F.lit(None).cast("string").alias("metadata_title"), "page_count", evidence_of(f)["evidence_text"].alias("evidence_text"))
    return A.prompts(requests, [(d, f"domain {d}") for d in A.DOMAINS], _RULES, _TITLE)


@query("SELECT 'D' || lpad(i::VARCHAR, 2, '0') AS code, i AS place, sha256('D' || lpad(i::VARCHAR, 2, '0')) AS code_hash FROM (SELECT range AS i FROM range(1, 13))")
def taxonomy_dim(spark, sf_dir):
    one = F.posexplode(F.array(*map(F.lit, A.DOMAINS))).alias("p", "code")
    return spark.range(1).select(one).select("code", (F.col("p") + 1).alias("place"), F.sha2("code", 256).alias("code_hash"))
