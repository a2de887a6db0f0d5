"""Paired annotations: validation of outputs, agreement, retry decisions, and analysis of provider attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.functions import text as T

# fixed values: the vocabulary of annotation outputs
DOMAINS = tuple(f"D{i:02d}" for i in range(1, 13))
PRIMARY_DOMAINS = (*DOMAINS, "OUT_OF_SCOPE", "UNCERTAIN")
TAXONOMY_FITS = ("clear_fit", "cross_domain", "ambiguous", "taxonomy_gap", "out_of_scope", "insufficient_evidence")
CONFIDENCES = ("high", "medium", "low")
USABILITIES = ("usable", "partially_usable", "unreadable", "insufficient")
FIELDS = ("primary_domain", "secondary_domains", "taxonomy_fit", "confidence", "evidence_usability", "evidence_keywords", "evidence_rationale", "review_note")
REVISIONS = ("evidence_revision", "taxonomy_revision", "prompt_revision", "schema_revision")
RETRY_USABILITIES = ("unreadable", "insufficient")
REVIEW_FITS = ("ambiguous", "taxonomy_gap", "out_of_scope", "insufficient_evidence")
SCHEMA = "primary_domain string, secondary_domains array<string>, taxonomy_fit string, confidence string, evidence_usability string, evidence_keywords array<string>, evidence_rationale string, review_note string"
MAX_EVIDENCE_RETRIES = 1


def _blank(c: Column) -> Column:
    return F.coalesce(T.stripped(c) == "", F.lit(True))


def violations(output: Column) -> Column:
    """Codes of everything that is wrong with an annotation output, given as JSON text; empty for a valid one."""
    keys = F.json_object_keys(output)
    expected = F.array(*map(F.lit, FIELDS))
    x = F.from_json(output, SCHEMA)
    second, words, note = x["secondary_domains"], x["evidence_keywords"], x["review_note"]
    enum = lambda field, allowed: ~F.coalesce(x[field].isin(*allowed), F.lit(False))
    rules = [
        (F.size(F.array_except(keys, expected)) > 0, "unknown_field"),
        (F.size(F.array_except(expected, keys)) > 0, "missing_field"),
        (enum("primary_domain", PRIMARY_DOMAINS), "primary_domain"),
        (second.isNull() | (F.size(second) > 3), "secondary_domains_size"),
        (F.exists(second, lambda d: ~F.coalesce(d.isin(*DOMAINS), F.lit(False))), "secondary_domains_value"),
        (F.size(F.array_distinct(second)) < F.size(second), "secondary_domains_repeated"),
        (F.array_contains(second, x["primary_domain"]), "secondary_domains_primary"),
        (enum("taxonomy_fit", TAXONOMY_FITS), "taxonomy_fit"),
        (enum("confidence", CONFIDENCES), "confidence"),
        (enum("evidence_usability", USABILITIES), "evidence_usability"),
        (words.isNull() | (F.size(words) > 8), "evidence_keywords_size"),
        (F.exists(words, _blank), "evidence_keywords_value"),
        (F.size(F.array_distinct(words)) < F.size(words), "evidence_keywords_repeated"),
        (_blank(x["evidence_rationale"]), "evidence_rationale"),
        (T.sentence_count(x["evidence_rationale"]) > 3, "evidence_rationale_sentences"),
        (note.isNotNull() & _blank(note), "review_note"),
    ]
    codes = F.filter(F.array(*(F.when(c, code) for c, code in rules)), lambda c: c.isNotNull())
    return F.when(keys.isNull(), F.array(F.lit("not_an_object"))).otherwise(codes)


def requires_evidence_retry(fit: Column, usability: Column) -> Column:
    return F.coalesce(usability.isin(*RETRY_USABILITIES), F.lit(False)) | F.coalesce(fit == "insufficient_evidence", F.lit(False))


def pairs(annotations: DataFrame) -> DataFrame:
    """One row for each item that both annotators have (side a, side b), as structs a and b."""
    fields = [c for c in annotations.columns if c not in ("item_id", "side")]
    one = lambda s: annotations.where(F.col("side") == s).select("item_id", F.struct(*fields).alias(s))
    return one("a").join(one("b"), "item_id")


def agreement(paired: DataFrame) -> DataFrame:
    """item_id, status and reason; the first rule that applies decides."""
    a, b = F.col("a"), F.col("b")
    retry = lambda x: requires_evidence_retry(x["taxonomy_fit"], x["evidence_usability"])
    same = F.lit(True)
    for field in REVISIONS:
        same = same & a[field].eqNullSafe(b[field])
    same = same & ~a["peer_annotation_visible"] & ~b["peer_annotation_visible"]
    members = lambda x: F.array_sort(F.array_distinct(x["secondary_domains"]))
    reason = (
        F.when(a["superseded"] | b["superseded"], "superseded")
        .when(retry(a) | retry(b), "evidence_retry_required")
        .when(~same, "evidence_contract_differs")
        .when(~a["primary_domain"].eqNullSafe(b["primary_domain"]), "primary_domain")
        .when(~a["taxonomy_fit"].eqNullSafe(b["taxonomy_fit"]), "taxonomy_fit")
        .when((a["taxonomy_fit"] == "cross_domain") & (members(a) != members(b)), "secondary_domains")
        .when(a["taxonomy_fit"].isin(*REVIEW_FITS), F.concat(F.lit("review_"), a["taxonomy_fit"]))
        .when((a["confidence"] == "low") | (b["confidence"] == "low"), "low_confidence")
        .otherwise("agreed")
    )
    return paired.select("item_id", F.when(reason == "agreed", "provisionally_agreed").otherwise("conflict").alias("status"), reason.alias("reason"))


def retry_decisions(paired: DataFrame) -> DataFrame:
    """item_id, required, triggered_by_a, triggered_by_b, reasons (a before b) and may_retry (within the budget)."""

    def reasons(side: str) -> Column:
        x = F.col(side)
        usable = F.when(x["evidence_usability"].isin(*RETRY_USABILITIES), F.concat(F.lit(f"{side}.evidence_usability="), x["evidence_usability"]))
        fit = F.when(x["taxonomy_fit"] == "insufficient_evidence", F.lit(f"{side}.taxonomy_fit=insufficient_evidence"))
        return F.array_compact(F.array(usable, fit))

    a, b = reasons("a"), reasons("b")
    required = F.size(F.concat(a, b)) > 0
    return paired.select(
        "item_id", required.alias("required"), (F.size(a) > 0).alias("triggered_by_a"), (F.size(b) > 0).alias("triggered_by_b"),
        F.array_join(F.concat(a, b), "; ").alias("reasons"), (required & (F.col("a")["retry_count"] < MAX_EVIDENCE_RETRIES)).alias("may_retry"),
    )


def superseded(paired: DataFrame) -> DataFrame:
    """First-pass rows that a retry replaces: both sides of every item that requires one."""
    return retry_decisions(paired).where("required").select("item_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("side"))


def calibration_metrics(paired: DataFrame, groups: DataFrame) -> DataFrame:
    """Over all items (parent_group null) and by group: items, the rate of each taxonomy fit among both annotations, and
    the rates of agreement and conflict. `groups` has item_id and parent_group."""
    rows = paired.join(agreement(paired), "item_id").join(groups.select("item_id", "parent_group"), "item_id")
    sets = rows.select("parent_group", "status", F.col("a")["taxonomy_fit"].alias("fit_a"), F.col("b")["taxonomy_fit"].alias("fit_b")).groupingSets([[], ["parent_group"]], "parent_group")
    both = lambda fit: T.safe_ratio(F.count_if(F.col("fit_a") == fit) + F.count_if(F.col("fit_b") == fit), 2 * F.count("*"))
    share = lambda status: T.safe_ratio(F.count_if(F.col("status") == status), F.count("*"))
    return sets.agg(F.count("*").alias("items"), *(both(f).alias(f"{f}_rate") for f in TAXONOMY_FITS), share("provisionally_agreed").alias("agreement_rate"), share("conflict").alias("conflict_rate"))


# ---------------------------------------------------------------- provider responses and attempts


def model_output(response: Column) -> Column:
    """The annotation object inside a provider's response, as JSON text: the response itself, output_text, the first
    choice's content (object, text or list of text parts), or content."""
    at = lambda path: F.get_json_object(response, path)
    direct = F.when(at("$.primary_domain").isNotNull() & at("$.secondary_domains").isNotNull(), response)
    content = at("$.choices[0].message.content")
    parts = F.from_json(content, "array<struct<text:string>>")
    listed = F.when(content.startswith("["), F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), ""))
    return F.coalesce(direct, at("$.output_text"), F.nullif(listed, F.lit("")), F.when(~content.startswith("["), content), at("$.content"))


def usage(response: Column) -> dict[str, Column]:
    """Input, output and reasoning tokens: the first key that holds a whole number of 0 or more."""

    def first(*paths: str) -> Column:
        values = (F.get_json_object(response, f"$.usage.{p}") for p in paths)
        return F.coalesce(*(F.when(v.rlike(r"^[0-9]+$"), v.try_cast("long")) for v in values))

    return {
        "input_tokens": first("prompt_tokens", "input_tokens"),
        "output_tokens": first("completion_tokens", "output_tokens"),
        "reasoning_tokens": first("completion_tokens_details.reasoning_tokens", "output_tokens_details.reasoning_tokens"),
    }


def failure_class(code: Column, model_match: Column, schema_valid: Column, unsupported: Column, error_type: Column) -> Column:
    """Why an attempt failed; null if it did not."""
    return (
        F.when(~model_match, "resolved_model_mismatch")
        .when(code.isin(401, 403), "auth_error")
        .when(code.isNull(), "transport_error")
        .when(unsupported, "unsupported_mode")
        .when(code >= 400, "provider_error")
        .when((code >= 200) & (code < 300) & ~schema_valid & (error_type == "schema"), "schema_incompatible_mode")
        .when((code >= 200) & (code < 300) & ~schema_valid, "parse_error")
    )


def is_unsupported_format(code: Column, message: Column) -> Column:
    text = F.lower(message)
    return F.coalesce(code.isin(400, 422) & text.rlike("response_format|json_schema|json mode|json_object") & text.rlike("unsupported|not support|invalid|unknown"), F.lit(False))


def message_excerpt(message: Column, most: int = 240) -> Column:
    return F.nullif(F.left(T.stripped(F.regexp_replace(message, rf"{T.SPACE}+", " ")), F.lit(most)), F.lit(""))


MODES = ("json_schema", "json_object", "prompt_json_only")


def negotiation(attempts: DataFrame) -> DataFrame:
    """provider, mode (the first that passed, in the order of MODES) and stopped_by: the failure that ended the search.

    Attempts after a pass, or after a failure that another mode cannot mend, do not count.
    """
    place = F.array_position(F.array(*map(F.lit, MODES)), F.col("mode"))
    ends = F.col("failure").isNull() | ~F.col("failure").isin("unsupported_mode", "schema_incompatible_mode", "parse_error")
    w = Window.partitionBy("provider").orderBy("place")
    tried = attempts.withColumn("place", place).withColumn("ended", F.max(F.when(ends, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    tried = tried.where("coalesce(ended, 0) = 0")
    return tried.groupBy("provider").agg(F.min_by(F.when(F.col("failure").isNull(), F.col("mode")), F.when(F.col("failure").isNull(), F.col("place"))).alias("mode"), F.count("*").alias("tried"), F.max_by("failure", "place").alias("stopped_by"))


def prompts(requests: DataFrame, taxonomy: list[tuple[str, str]], rules: list[str], title: str) -> DataFrame:
    """item_id and prompt: instructions, taxonomy, permitted metadata and evidence; no path or group enters it."""
    domains = "\n".join(f"- {code}: {name}" for code, name in taxonomy)
    metadata = F.to_json(F.struct("metadata_title", "page_count"))
    head = "\n".join([title, *rules, "", "TAXONOMY", domains, "", "DOCUMENT METADATA", ""])
    tail = "\n".join(["", "<<<END_FINAL_EVIDENCE>>>", "", "OUTPUT FIELDS", *FIELDS])
    return requests.select("item_id", F.concat(F.lit(head), metadata, F.lit("\n\nEVIDENCE\n<<<BEGIN_FINAL_EVIDENCE>>>\n"), "evidence_text", F.lit(tail)).alias("prompt"))


# ---------------------------------------------------------------- requests, records and artifact rows

IDENTITY = ("run_id", "sample_id", "item_id", "annotator_id", "annotation_pass", "attempt_id")
COUNTERS = ("input_tokens", "output_tokens", "reasoning_tokens", "latency_ms", "retry_count")


def payload(model: Column, prompt: Column, mode: Column, max_tokens: int, schema: str = "{}") -> Column:
    """The request to a provider as JSON text, in one of the three structured-output modes; null for another mode.

    `schema` is the JSON schema of an output, as text.
    """
    messages = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))
    head = F.to_json(F.struct(model.alias("model"), messages.alias("messages"), F.lit(max_tokens).alias("max_tokens")))
    strict = f',"response_format":{{"type":"json_schema","json_schema":{{"name":"taxonomy_annotation","strict":true,"schema":{schema}}}}}}}'
    tail = F.when(mode == "json_schema", F.lit(strict)).when(mode == "json_object", F.lit(',"response_format":{"type":"json_object"}}')).when(mode == "prompt_json_only", F.lit("}"))
    return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), tail)


def record_violations() -> Column:
    """Codes of what is wrong with an attempt record: superseded if and only if there is a reason, counters not
    negative, valid if and only if there is a response, and no part of its identity missing."""
    rules = [
        (F.col("superseded") != F.coalesce(T.stripped("superseded_reason") != "", F.lit(False)), "superseded_reason"),
        *((F.col(c) < 0, f"negative_{c}") for c in COUNTERS),
        (F.col("schema_valid") != F.col("response").isNotNull(), "response"),
        *((_blank(F.col(c).cast("string")), f"missing_{c}") for c in IDENTITY),
    ]
    return F.array_compact(F.array(*(F.when(c, code) for c, code in rules)))


def attempt_rows(attempts: DataFrame) -> DataFrame:
    """Attempts with their record's identity, failed ones included; two rows of one identity are an error."""
    rows = attempts.withColumn("annotation_record_id", F.concat_ws(":", "run_id", "item_id", "attempt_id"))
    times = rows.groupBy("annotation_record_id").agg(F.count("*").alias("times"))
    checked = F.when(F.col("times") == 1, F.col("annotation_record_id")).otherwise(F.raise_error(F.lit("an attempt's identity is repeated")).cast("string"))
    return rows.join(times, "annotation_record_id").withColumn("annotation_record_id", checked).drop("times")


def final_rows(attempts: DataFrame) -> DataFrame:
    """The valid attempts as final annotations; one that is superseded cannot be final."""
    checked = F.when(~F.col("superseded"), F.col("response")).otherwise(F.raise_error(F.lit("a superseded annotation is not final")).cast("string"))
    return attempts.where("schema_valid").withColumn("response", checked).withColumn("annotation_record_id", F.concat_ws(":", "run_id", "item_id", "annotator_id"))


def evidence_retry_rows(decisions: DataFrame, source_revision: str, final_revision: str, engine: str, dpi: int) -> DataFrame:
    """One row for each item whose evidence is taken again; no evidence text is stored."""
    return decisions.where("required").select(
        "item_id", F.col("triggered_by_a").alias("retry_triggered_by_a"), F.col("triggered_by_b").alias("retry_triggered_by_b"), F.col("reasons").alias("retry_reason"),
        F.lit(source_revision).alias("source_evidence_revision"), F.lit(final_revision).alias("final_evidence_revision"), F.lit(engine).alias("ocr_engine"), F.lit(dpi).alias("render_dpi"),
    )
