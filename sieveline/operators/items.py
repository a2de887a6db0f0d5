"""Evaluation items as the design documents specify them: validation, units, contamination, datasets, coverage, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.functions import text as T
from sieveline.operators.annotation import retry_decisions
from sieveline.operators.scoring import within_tolerance

# fixed values: capabilities of the three tracks, answer types with options, and policies that need a unit
CAPABILITIES = {"T1": [f"K{i}" for i in range(1, 9)], "T2": [f"C{i}" for i in range(1, 9)], "T3": [f"M{i}" for i in range(1, 12)]}
CHOICES = ("single_choice", "multiple_choice")
GROUNDED = ("source_grounded", "parameterized_from_source")
UNIT_POLICIES = ("unit_specified_in_question", "explicit_unit_required")

ITEM = """item_id long, item_revision int, item_status string, track string, capability string, secondary_capabilities array<string>, assets array<struct<asset_id:string,source_evidence_id:string>>,
has_multimodal boolean, visual_dependency boolean, answer_type string, options array<struct<option_id:string,content:string>>, correct_option_ids array<string>,
truth struct<value:double,unit:string,dimensionless:boolean,absolute_tolerance:double,relative_tolerance:double,rounding_rule:string,accepted_unit_conversions:array<string>>, unit_policy string,
provenance_type string, evidence array<struct<evidence_id:string,document_id:long,bbox:array<double>,coordinate_system:string,origin:string,page_index:int,page_width:double,page_height:double>>, primary_evidence_id string,
rejection_reason string, empirical_difficulty double, pilot_validated boolean, content_hash string, released_hash string, released_revision int, revisions array<int>, membership_revisions array<int>,
quality_summary string, verified_revision int, calculation_agrees boolean, verification_passed boolean"""


def item_violations(items: DataFrame, documents: DataFrame) -> DataFrame:
    """item_id and violations: a code for each of the 23 rules that an item breaks, in the rules' order.

    `items` has the columns of ITEM; `documents` the document_id of every source document.
    """
    has = lambda c: F.coalesce(c, F.lit(False))
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    col, truth = F.col, F.col("truth")
    track, kind, none = col("track"), col("answer_type"), F.array().cast("array<string>")
    options = F.coalesce(F.transform("options", lambda o: o["option_id"]), none)
    given = F.coalesce("correct_option_ids", none)
    evidence_ids = F.coalesce(F.transform("evidence", lambda e: e["evidence_id"]), none)
    of_track = lambda t: (track == t) & ~has(col("capability").isin(*CAPABILITIES[t]))
    numeric, unit, bare = kind == "numeric", truth["unit"], has(truth["dimensionless"])
    placed = lambda e: e["coordinate_system"].isNotNull() & e["origin"].isNotNull() & e["page_index"].isNotNull() & e["page_width"].isNotNull() & e["page_height"].isNotNull()
    complete = truth["value"].isNotNull() & truth["dimensionless"].isNotNull() & truth["rounding_rule"].isNotNull() & truth["accepted_unit_conversions"].isNotNull()
    passed = has(col("quality_summary") == "passed")
    policy = col("unit_policy")
    rules = [
        (of_track("T1"), "t1_capability"),
        (of_track("T2"), "t2_capability"),
        (of_track("T3") | ((track == "T3") & ~(some(col("assets")) & has(col("has_multimodal")))), "t3_capability_or_asset"),
        ((track == "T3") & ~has(col("visual_dependency")), "t3_visual_dependency"),
        (kind.isin(*CHOICES) & (~some(col("options")) | has(F.exists("options", lambda o: o["option_id"].isNull() | o["content"].isNull()))), "options"),
        ((kind == "single_choice") & some(col("options")) & ((F.size(given) != 1) | (F.size(F.array_except(given, options)) > 0)), "single_choice"),
        ((kind == "multiple_choice") & some(col("options")) & ((F.size(given) < 1) | (F.size(F.array_except(given, options)) > 0)), "multiple_choice"),
        (numeric & ~has(complete), "numeric_truth"),
        (col("provenance_type").isin(*GROUNDED) & ~some(col("evidence")), "grounded_without_evidence"),
        (has(col("unresolved")), "evidence_document"),
        (has(F.exists("evidence", lambda e: e["bbox"].isNotNull() & ~placed(e))), "bbox_context"),
        ((col("item_status") == "rejected") & T.stripped(F.coalesce("rejection_reason", F.lit(""))).eqNullSafe(""), "rejection_reason"),
        (col("empirical_difficulty").isNotNull() & ~has(col("pilot_validated")), "difficulty_before_pilot"),
        (has(F.array_contains("secondary_capabilities", col("capability"))), "secondary_capability_repeats"),
        (has((col("content_hash") != col("released_hash")) & (col("item_revision") <= col("released_revision"))), "released_revision"),
        (numeric & has(complete) & (unit.isNotNull() == bare), "unit_xor_dimensionless"),
        (col("primary_evidence_id").isNotNull() & ~has(F.array_contains(evidence_ids, col("primary_evidence_id"))), "primary_evidence"),
        (has(F.exists("assets", lambda a: a["source_evidence_id"].isNotNull() & ~F.array_contains(evidence_ids, a["source_evidence_id"]))), "asset_evidence"),
        (F.size(F.array_except(F.coalesce("membership_revisions", F.array().cast("array<int>")), F.coalesce("revisions", F.array().cast("array<int>")))) > 0, "membership_revision"),
        (some(col("membership_revisions")) & ~col("item_status").isin("accepted", "released"), "membership_without_acceptance"),
        (passed & ~col("verified_revision").eqNullSafe(col("item_revision")), "quality_without_verification"),
        (has(~col("calculation_agrees") & col("verification_passed")), "calculation_conflict"),
        (numeric & has(complete) & (unit.isNotNull() != bare) & ((bare & ~has(policy == "dimensionless")) | (unit.isNotNull() & ~has(policy.isin(*UNIT_POLICIES)))), "unit_policy"),
    ]
    known = documents.select("document_id").distinct().withColumn("known", F.lit(True))
    each = items.select("item_id", "item_revision", F.explode("evidence").alias("e")).select("item_id", "item_revision", "e.document_id")
    lost = each.join(known, "document_id", "left").where("known is null").select("item_id", "item_revision").distinct().withColumn("unresolved", F.lit(True))
    codes = F.array_compact(F.array(*(F.when(c, code) for c, code in rules)))
    return items.join(lost, ["item_id", "item_revision"], "left").select("item_id", "item_revision", codes.alias("violations"))


def unit_scores(answers: DataFrame, units: DataFrame) -> DataFrame:
    """item_id, status and score of numeric answers under the item's unit policy.

    answers: item_id, value, unit, key, key_unit, policy, absolute, relative; units: unit, dimension, factor (to the
    dimension's base; a small table). A compatible unit is converted to the key's; an incompatible one scores 0; a
    missing one counts as the key's only where the question has said the unit; otherwise the answer is ambiguous.
    """
    dim = lambda side: F.broadcast(units.select(F.col("unit").alias(side), F.col("dimension").alias(f"{side}_dimension"), F.col("factor").alias(f"{side}_factor")))
    rows = answers.join(dim("unit"), "unit", "left").join(dim("key_unit"), "key_unit", "left")
    bare, needs = F.col("unit").isNull(), F.col("policy") != "dimensionless"
    status = (
        F.when(~needs, F.when(bare, "scored").otherwise("ambiguous"))
        .when(F.col("key_unit_dimension").isNull(), "ambiguous")
        .when(bare, F.when(F.col("policy") == "unit_specified_in_question", "scored").otherwise("ambiguous"))
        .when(F.col("unit_dimension").isNull(), "ambiguous")
        .when(F.col("unit_dimension") != F.col("key_unit_dimension"), "incompatible")
        .otherwise("scored")
    )
    value = F.when(bare, F.col("value")).otherwise(F.col("value") * F.col("unit_factor") / F.col("key_unit_factor"))
    right = within_tolerance(value, F.col("key"), F.col("absolute"), F.col("relative"))
    return rows.withColumn("status", status).select("item_id", "status", F.when(F.col("status") == "scored", right.cast("double")).when(F.col("status") == "incompatible", 0.0).alias("score"))


def grams(df: DataFrame, key: str, words: int) -> DataFrame:
    """key and the distinct hashes g of the runs of `words` lower-case words of its text.

    Words are what matches, not what is left between matches of all else: the latter takes six times as long. A run is
    hashed from the hashes of two shorter runs that cover it, so its words are read once whatever their number.
    """
    own = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9À-ɏ]++"), F.lit(0))
    runs, length = F.transform(own, lambda w: F.xxhash64(w)), 1
    while length < words:
        by = min(length, words - length)
        runs, length = _joined_runs(runs, by), length + by
    return df.select(key, F.explode(F.array_distinct(runs)).alias("g"))


def _joined_runs(runs: Column, by: int) -> Column:
    """Hashes of each run with the one that begins `by` words later."""
    left = lambda r: F.greatest(F.size(r) - by, F.lit(0))
    return T.bound(runs, lambda r: F.zip_with(F.slice(r, F.lit(1), left(r)), F.slice(r, F.lit(by + 1), left(r)), lambda a, b: F.xxhash64(a, b)))


def training_exclusions(documents: DataFrame, items: DataFrame, words: int = 13) -> DataFrame:
    """document_id, item_id and shared: documents that may not train a model which the items test, by shared runs of words.

    Runs that many documents have stand once for each document; only those of items go through the join.
    """
    asked = grams(items, "item_id", words)
    known = asked.select("g").distinct()
    own = grams(documents, "document_id", words).join(known, "g", "left_semi")
    return own.join(asked, "g").groupBy("document_id", "item_id").agg(F.count("*").alias("shared"))


def assembled(items: DataFrame, version: str) -> DataFrame:
    """The memberships of a dataset version: the latest accepted revision of every item that isn't rejected later on."""
    latest = items.groupBy("item_id").agg(F.max_by(F.struct("item_revision", "item_status", "content_hash"), "item_revision").alias("x")).select("item_id", "x.*")
    return latest.where(F.col("item_status").isin("accepted", "released")).select(F.lit(version).alias("dataset_version"), "item_id", "item_revision", "content_hash")


def freeze_violations(frozen: DataFrame, items: DataFrame) -> DataFrame:
    """violation and n: frozen memberships whose revision is gone, or whose content has changed under its revision."""
    now = items.select("item_id", "item_revision", F.col("content_hash").alias("now"))
    joined = frozen.join(now, ["item_id", "item_revision"], "left")
    kind = F.when(F.col("now").isNull(), "revision_gone").when(F.col("now") != F.col("content_hash"), "content_changed")
    return joined.withColumn("violation", kind).where("violation is not null").groupBy("violation").agg(F.count("*").alias("n"))


def domain_coverage(items: DataFrame, domains: DataFrame) -> DataFrame:
    """By domain of the dimension `domains` (domain, reason): items, tracks with their counts, capabilities, sources and
    families; the reason stands where a domain has no item."""
    tracks = items.groupBy("domain", "track").agg(F.count("*").alias("n"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("track", "n"))), lambda x: F.concat_ws(":", x["track"], x["n"])), ",")  # a few tracks
    spread = tracks.groupBy("domain").agg(listed.alias("track_distribution"))
    counts = items.groupBy("domain").agg(F.count("*").alias("item_count"), F.count_distinct("capability").alias("capability_count"), F.count_distinct("source").alias("source_count"), F.count_distinct("family").alias("document_family_count"))
    zero = ["item_count", "capability_count", "source_count", "document_family_count"]
    return F.broadcast(domains).join(counts, "domain", "left").join(spread, "domain", "left").na.fill(0, zero).select("domain", *zero, F.coalesce("track_distribution", F.lit("")).alias("track_distribution"), F.when(F.col("item_count") == 0, F.col("reason")).alias("reason"))


def dry_run_metrics(paired: DataFrame, problems: DataFrame, attempts: DataFrame) -> DataFrame:
    """One row: retries by side and by either, false ones (of items without a problem), and structured outputs.

    problems: item_id; attempts: schema_valid, format_retry.
    """
    known = problems.select("item_id").distinct().withColumn("problem", F.lit(True))
    rows = retry_decisions(paired).join(known, "item_id", "left")
    clean = F.col("problem").isNull()
    retries = rows.agg(
        F.count_if("triggered_by_a").alias("retry_triggered_by_a"), F.count_if("triggered_by_b").alias("retry_triggered_by_b"), F.count_if("required").alias("retry_triggered_by_either"),
        F.count_if(F.col("required") & clean).alias("false_retry_count"), T.safe_ratio(F.count_if(F.col("required") & clean), F.count_if(clean)).alias("false_retry_rate"),
    )
    outputs = attempts.agg(T.safe_ratio(F.count_if("schema_valid"), F.count("*")).alias("valid_structured_output_rate"), F.count_if("format_retry").alias("format_retry_count"))
    return retries.crossJoin(outputs)  # one row each


def final_view(first: DataFrame, second: DataFrame, paired: DataFrame) -> DataFrame:
    """Annotations after the retries: the second pass where one was required and made, the first pass where none was.

    Items that require a retry and have no second pass of both sides have no final annotation.
    """
    retried = retry_decisions(paired).where("required").select("item_id")
    whole = second.groupBy("item_id").agg(F.count_distinct("side").alias("sides")).where("sides = 2").select("item_id")
    kept = first.join(retried, "item_id", "left_anti").withColumn("annotation_pass", F.lit(1))
    return kept.unionByName(second.join(retried.join(whole, "item_id"), "item_id", "left_semi").withColumn("annotation_pass", F.lit(2)))


def canonical_hash(payload: Column) -> Column:
    """SHA-256 of a struct as JSON with its keys in the struct's order (give them sorted) and nulls written out."""
    return F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256)
