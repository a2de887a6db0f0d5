"""Queries over single files: names, identities, pages, signals, duplicates, counts, snapshots and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.operators import evidence as E, inventory as I, snapshots as S
from sieveline.plans.corpus import DUPLICATES, FILES, PAGE, Registry, documents, every, files

registry = query = Registry()
_first_three = lambda n: F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda p: p < n)


@query(FILES + "SELECT doc_id, split_part(relative_path, '/', 1) AS parent_group, split_part(relative_path, '/', 2) AS file_name, '.pdf' AS extension FROM files")
def path_parts(spark, sf_dir):
    path = F.col("relative_path")
    return files(spark, sf_dir).select("doc_id", T.parent_group(path).alias("parent_group"), T.base_name(path).alias("file_name"), T.extension(T.base_name(path)).alias("extension"))


@query(FILES + "SELECT doc_id, file_instance_id FROM files")
def stable_uuid(spark, sf_dir):
    return files(spark, sf_dir).select("doc_id", "file_instance_id")


@query(FILES + """SELECT doc_id, CASE WHEN s = 'matched' THEN substr(file_name, 2, 4) END AS filename_year, CASE WHEN s = 'matched' THEN substr(file_name, 7, 2) END AS filename_issue,
  CASE WHEN s = 'matched' THEN regexp_extract(file_name, '】(.*)[.]pdf$', 1) END AS filename_title, s AS filename_parse_status FROM (SELECT *, filename_parse_status AS s FROM files)""")
def filename_parse(spark, sf_dir):
    name = F.col("file_name")
    parts = [T.filename_part(name, k).alias(f"filename_{n}") for k, n in enumerate(("year", "issue", "title"), 1)]
    return files(spark, sf_dir).select("doc_id", *parts, T.filename_status(name).alias("filename_parse_status"))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_hash(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("sha256"))


@query(FILES + "SELECT doc_id, inventory_status, pdf_status FROM files")
def record_status(spark, sf_dir):
    return files(spark, sf_dir).select("doc_id", "inventory_status", "pdf_status")


@query(FILES + "SELECT doc_id, text_layer_status FROM files")
def text_layer(spark, sf_dir):
    return files(spark, sf_dir).select("doc_id", "text_layer_status")


@query(FILES + "SELECT doc_id, CASE WHEN n = 0 THEN '' WHEN n = 1 THEN '0' WHEN n = 2 THEN '0,1' ELSE '0,' || (n // 2)::VARCHAR || ',' || (n - 1)::VARCHAR END AS pages FROM (SELECT doc_id, page_count AS n FROM files)")
def probe_pages(spark, sf_dir):
    return files(spark, sf_dir).select("doc_id", F.array_join(T.probe_pages(F.col("page_count")).cast("array<string>"), ",").alias("pages"))


@query(FILES + """
, wanted AS (SELECT doc_id, p, page_count AS n FROM files, (VALUES (0), (1), (2)) v(p)
  UNION SELECT doc_id, ((page_count - 1) // 2)::INTEGER, page_count FROM files UNION SELECT doc_id, (((page_count - 1) * 3) // 4)::INTEGER, page_count FROM files)
SELECT f.doc_id, coalesce(w.pages, '') AS pages FROM files f LEFT JOIN (SELECT doc_id, string_agg(p::VARCHAR, ',' ORDER BY p) AS pages FROM wanted WHERE p >= 0 AND p < n GROUP BY doc_id) w ON f.doc_id = w.doc_id""")
def ocr_pages(spark, sf_dir):
    return files(spark, sf_dir).select("doc_id", F.array_join(T.ocr_pages(F.col("page_count")).cast("array<string>"), ",").alias("pages"))


_PAGES = """, pages AS (SELECT f.doc_id, p.n, {text} AS page FROM files f, unnest({numbers}) AS p(n)),
whole AS (SELECT f.doc_id, coalesce(string_agg('<<<PAGE:' || p.n || '>>>' || chr(10) || {cut}, chr(10) ORDER BY p.n), '') AS t, coalesce(sum(length(p.page)), 0)::BIGINT AS raw, count(*) FILTER (WHERE length(p.page) > {most}) AS cut FROM files f LEFT JOIN pages p ON p.doc_id = f.doc_id GROUP BY f.doc_id)
"""
_PAGE_TEXT = "substr(f.text, (p.n * 1500 + 1)::BIGINT, 1500)"
EVIDENCE = FILES + _PAGES.format(text=_PAGE_TEXT, numbers="list_filter([0, 1, 2], lambda k: k < f.page_count)", cut="p.page", most=1 << 30)
_OCR_NUMBERS = "list_distinct(list_filter([0, 1, 2, (f.page_count - 1) // 2, ((f.page_count - 1) * 3) // 4], lambda k: k >= 0 AND k < f.page_count))"
# pages, characters of a page and of all evidence that a run takes
EVIDENCE_CHARS, OCR_PAGE_CHARS, OCR_CHARS = 12000, 4000, 20000


def evidence_of(files_, cap=EVIDENCE_CHARS):
    numbers = _first_three(F.col("page_count"))
    return E.assemble(T.pages_of(F.col("text"), numbers, PAGE), numbers, cap)


@query(EVIDENCE + f"SELECT doc_id, sha256(substr(t, 1, {EVIDENCE_CHARS})) AS evidence_sha256, length(substr(t, 1, {EVIDENCE_CHARS})) AS evidence_char_count, length(t) > {EVIDENCE_CHARS} AS evidence_truncated, raw AS raw_text_char_count FROM whole")
def evidence_assemble(spark, sf_dir):
    f = files(spark, sf_dir)
    out = evidence_of(f)
    return f.select("doc_id", F.sha2(out["evidence_text"], 256).alias("evidence_sha256"), *(out[k].alias(k) for k in ("evidence_char_count", "evidence_truncated")), out["raw_text_char_count"].cast("long").alias("raw_text_char_count"))


@query(FILES + _PAGES.format(text=_PAGE_TEXT, numbers=_OCR_NUMBERS, cut=f"substr(p.page, 1, {OCR_PAGE_CHARS})", most=OCR_PAGE_CHARS) + f"SELECT doc_id, sha256(substr(t, 1, {OCR_CHARS})) AS evidence_sha256, raw AS raw_chars, cut AS pages_truncated, length(t) > {OCR_CHARS} AS globally_truncated FROM whole")
def ocr_assemble(spark, sf_dir):
    numbers = T.ocr_pages(F.col("page_count"))
    out = E.assemble_ocr(T.pages_of(F.col("text"), numbers, PAGE), numbers, OCR_PAGE_CHARS, OCR_CHARS)
    return files(spark, sf_dir).select("doc_id", F.sha2(out["evidence_text"], 256).alias("evidence_sha256"), out["raw_chars"].cast("long").alias("raw_chars"), out["pages_truncated"].cast("long").alias("pages_truncated"), out["globally_truncated"].alias("globally_truncated"))


@query("""WITH d AS (SELECT vec_id, k, least(embedding[k + 2], embedding[k + 4]) AS top, least(embedding[k + 1], embedding[k + 3]) AS left_ FROM embeddings, (SELECT unnest([0, 4, 8, 12, 16]) AS k))
SELECT vec_id, string_agg('t' || k, ',' ORDER BY top, left_, k) AS texts FROM d GROUP BY vec_id""")
def reading_order(spark, sf_dir):
    """Detections made of embedding values, in reading order."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    one = lambda k: F.struct(F.array(point(F.col("embedding")[k], F.col("embedding")[k + 1]), point(F.col("embedding")[k + 2], F.col("embedding")[k + 3])).alias("box"), F.lit(f"t{k}").alias("text"), F.col("embedding")[k].cast("double").alias("score"))
    order = E.reading_order(F.array(*(one(k) for k in range(0, 20, 4))))
    return e.select("vec_id", F.array_join(F.transform(order, lambda d: d["text"]), ",").alias("texts"))


_SIGNAL_SQL = """total_chars, fffd AS replacement_char_count, round(fffd / total_chars, 6) AS replacement_char_rate, pua AS private_use_char_count, cc AS control_char_count, total_chars - pua - cc - nl AS printable_char_count,
  round((total_chars - pua - cc - nl) / total_chars, 6) AS printable_char_ratio, digits AS digit_count, letters AS ascii_letter_count, spaces AS whitespace_count, fffd + pua + cc AS suspicious_char_count, round((fffd + pua + cc) / total_chars, 6) AS suspicious_char_rate"""
SIGNALS = """
WITH marked AS (SELECT doc_id, text || repeat(chr(65533), (doc_id % 7)::INTEGER) || repeat(chr(57344), (doc_id % 4)::INTEGER) || repeat(chr(1), (doc_id % 5)::INTEGER) AS t FROM documents),
counted AS (SELECT doc_id, t, length(t) AS total_chars, length(t) - length(replace(t, chr(65533), '')) AS fffd, length(t) - length(replace(t, chr(57344), '')) AS pua, length(t) - length(replace(t, chr(1), '')) AS cc,
  length(t) - length(replace(replace(replace(t, chr(10), ''), chr(13), ''), chr(9), '')) AS nl, length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS digits, length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS letters,
  length(t) - length(regexp_replace(t, '\\s', '', 'g')) AS spaces FROM marked)
"""
_SHOWN = ("total_chars", "replacement_char_count", "replacement_char_rate", "private_use_char_count", "control_char_count", "printable_char_count", "printable_char_ratio", "digit_count", "ascii_letter_count", "whitespace_count", "suspicious_char_count", "suspicious_char_rate")


def marked(spark, sf_dir):
    """Documents with some characters that the signals count."""
    extra = [F.repeat(F.lit(c), (F.col("doc_id") % n).cast("int")) for c, n in (("\ufffd", 7), ("\ue000", 4), ("\x01", 5))]
    return documents(spark, sf_dir).select("doc_id", F.concat("text", *extra).alias("t"))


@query(SIGNALS + f"SELECT doc_id, {_SIGNAL_SQL} FROM counted")
def quality_signals(spark, sf_dir):
    own = F.col("s")
    rows = marked(spark, sf_dir).select("doc_id", T.quality_signals(F.col("t")).alias("s"))
    return rows.select("doc_id", *(F.round(own[k], 6).alias(k) if k.endswith(("rate", "ratio")) else own[k].alias(k) for k in _SHOWN))


@query(SIGNALS + "SELECT doc_id, doc_id % 23 <> 0 AS evidence_text_available, CASE WHEN doc_id % 23 <> 0 THEN total_chars END AS total_chars, CASE WHEN doc_id % 23 <> 0 THEN total_chars = total_chars END AS total_chars_matches, CASE WHEN doc_id % 23 <> 0 THEN round((fffd + pua + cc) / total_chars, 6) END AS suspicious_char_rate FROM counted")
def signal_rows(spark, sf_dir):
    sample = marked(spark, sf_dir).select("doc_id", F.length("t").alias("canonical_chars"))
    texts = marked(spark, sf_dir).select("doc_id", F.when(~every(23), F.col("t")).alias("t"))
    own = F.col("s")
    signals = sample.join(texts, "doc_id").select("doc_id", "canonical_chars", "t", T.quality_signals(F.col("t")).alias("s"))
    return signals.select("doc_id", F.col("t").isNotNull().alias("evidence_text_available"), own["total_chars"].alias("total_chars"), (own["total_chars"] == F.col("canonical_chars")).alias("total_chars_matches"), F.round(own["suspicious_char_rate"], 6).alias("suspicious_char_rate"))


@query("SELECT conv_id, turn, greatest(1, len(list_filter(regexp_split_to_array(text, '[。！？!?；;.!]+'), lambda s: regexp_replace(s, '\\s', '', 'g') <> ''))) AS sentences FROM conversations")
def sentence_count(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", T.sentence_count(F.col("text")).alias("sentences"))


# ---------------------------------------------------------------- duplicates, counts, distributions


@query(DUPLICATES + "SELECT * FROM duplicates")
def exact_duplicates(spark, sf_dir):
    return I.exact_duplicates(files(spark, sf_dir))


@query(DUPLICATES + "SELECT count(DISTINCT duplicate_group_id) AS group_count, count(*) AS file_count, coalesce(max(group_size), 0) AS largest_group, round(count(*) / (SELECT count(*) FROM files), 6) AS duplicate_rate FROM duplicates")
def dup_summary(spark, sf_dir):
    f = files(spark, sf_dir)
    return I.duplicate_summary(f, I.exact_duplicates(f)).withColumn("duplicate_rate", F.round("duplicate_rate", 6))


@query(DUPLICATES + "SELECT f.doc_id FROM files f LEFT JOIN duplicates d USING (file_instance_id) WHERE coalesce(d.is_representative, true)")
def dup_collapse(spark, sf_dir):
    f = files(spark, sf_dir)
    return I.collapse_duplicates(f, I.exact_duplicates(f)).select("doc_id")


@query(DUPLICATES + """, bad AS (SELECT d.duplicate_group_id, CASE WHEN f.doc_id % 3 = 0 THEN 'x' ELSE d.sha256 END AS sha256, d.group_size + CASE WHEN f.doc_id % 2 = 0 THEN 1 ELSE 0 END AS group_size, CASE WHEN f.doc_id % 7 = 0 THEN 'unknown' ELSE d.file_instance_id END AS file_instance_id, d.is_representative AND f.doc_id % 5 <> 0 AS is_representative FROM duplicates d JOIN files f USING (file_instance_id)),
found AS (SELECT 'unknown_file' AS violation FROM bad WHERE file_instance_id = 'unknown' UNION ALL SELECT 'hash_differs' FROM bad b JOIN files f USING (file_instance_id) WHERE f.sha256 <> b.sha256
  UNION ALL SELECT 'size_differs' FROM bad GROUP BY duplicate_group_id HAVING count(*) <> max(group_size) UNION ALL SELECT 'representatives' FROM bad GROUP BY duplicate_group_id HAVING count(*) FILTER (WHERE is_representative) <> 1
  UNION ALL SELECT 'in_two_groups' FROM bad GROUP BY file_instance_id HAVING count(DISTINCT duplicate_group_id) > 1)
SELECT violation, count(*) AS n FROM found GROUP BY violation""")
def dup_validate(spark, sf_dir):
    f = files(spark, sf_dir)
    d = I.exact_duplicates(f).join(f.select("doc_id", "file_instance_id"), "file_instance_id")
    bad = d.select(
        "duplicate_group_id", F.when(every(3), "x").otherwise(F.col("sha256")).alias("sha256"), (F.col("group_size") + F.when(every(2), 1).otherwise(0)).alias("group_size"),
        F.when(every(7), "unknown").otherwise(F.col("file_instance_id")).alias("file_instance_id"), (F.col("is_representative") & ~every(5)).alias("is_representative"),
    )
    return I.duplicate_violations(f, bad)


@query(FILES + "SELECT parent_group, count(*) AS total_files, count(*) FILTER (WHERE text_layer_status = 'text_present') AS text_present, count(*) FILTER (WHERE text_layer_status = 'text_absent') AS text_absent, count(*) FILTER (WHERE text_layer_status = 'mixed_or_uncertain') AS mixed_or_uncertain, count(*) FILTER (WHERE text_layer_status = 'check_failed') AS check_failed FROM files GROUP BY parent_group")
def status_pivot(spark, sf_dir):
    return I.status_pivot(files(spark, sf_dir), "text_layer_status", I.TEXT_STATUSES)


@query(FILES + "SELECT coalesce(filename_parse_status, 'None') AS value, count(*) AS n FROM files GROUP BY 1")
def value_counts(spark, sf_dir):
    return I.value_counts(files(spark, sf_dir), "filename_parse_status")


@query(FILES + "SELECT count(size_bytes) AS count, min(size_bytes) AS min, round(quantile_cont(size_bytes, 0.5), 4) AS median, round(quantile_cont(size_bytes, 0.9), 4) AS p90, round(quantile_cont(size_bytes, 0.95), 4) AS p95, round(quantile_cont(size_bytes, 0.99), 4) AS p99, max(size_bytes) AS max FROM files")
def distribution(spark, sf_dir):
    return I.distribution(files(spark, sf_dir), "size_bytes", 4)


@query("""WITH r AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT source, max(n) AS count, min(n_chars) AS min, max(n_chars) FILTER (WHERE i = round_even((n - 1) * 0.1, 0)) AS p10, max(n_chars) FILTER (WHERE i = round_even((n - 1) * 0.5, 0)) AS median, max(n_chars) FILTER (WHERE i = round_even((n - 1) * 0.9, 0)) AS p90, max(n_chars) AS max FROM r GROUP BY source""")
def nearest_rank(spark, sf_dir):
    return I.nearest_rank(documents(spark, sf_dir).select("source", "n_chars"), "n_chars", ["source"])


@query(FILES + """SELECT count(*) AS total_files, count(DISTINCT file_instance_id) AS unique_files, count(*) FILTER (WHERE inventory_status = 'success') AS successful_files, count(*) FILTER (WHERE inventory_status = 'partial') AS partial_files,
  count(*) FILTER (WHERE inventory_status = 'failed') AS failed_files, sum(size_bytes)::BIGINT AS total_bytes, count(*) FILTER (WHERE pdf_open_status = 'success') AS open_success, count(*) FILTER (WHERE pdf_open_status = 'failed') AS open_failure,
  count(*) FILTER (WHERE pdf_status = 'valid') AS valid_count, count(*) FILTER (WHERE pdf_status = 'corrupted_or_invalid') AS invalid_count, count(*) FILTER (WHERE page_count = 0) AS zero_page_count,
  count(*) FILTER (WHERE text_layer_status = 'text_present') AS text_present, count(*) FILTER (WHERE text_layer_status = 'text_absent') AS text_absent, count(*) FILTER (WHERE text_layer_status = 'mixed_or_uncertain') AS mixed_or_uncertain,
  count(*) FILTER (WHERE text_layer_status = 'check_failed') AS check_failed, count(*) FILTER (WHERE filename_parse_status = 'matched') AS filename_matched, round(count(*) FILTER (WHERE filename_parse_status = 'matched') / count(*), 6) AS filename_match_rate,
  round(count(*) / 64.0, 6) AS files_per_second, round(sum(size_bytes) / 1048576.0 / 64.0, 6) AS mib_per_second FROM files""")
def inventory_stats(spark, sf_dir):
    out = I.inventory_stats(files(spark, sf_dir), 64.0)
    return out.select(*(F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes))


@query(FILES + ", r AS (SELECT source_root_id, count(*) AS files, sum(size_bytes)::BIGINT AS bytes, count(DISTINCT parent_group) AS groups FROM files GROUP BY 1) SELECT * FROM r UNION ALL SELECT NULL, sum(files)::BIGINT, sum(bytes)::BIGINT, sum(groups)::BIGINT FROM r")
def snapshot_totals(spark, sf_dir):
    return I.snapshot_totals(files(spark, sf_dir))


@query(FILES + """, e AS (SELECT source_root_id, parent_group, substr(sha256(relative_path), 1, 3) AS cell, sha256(source_root_id || chr(31) || relative_path || chr(31) || size_bytes::VARCHAR || chr(31) || mtime_ns::VARCHAR) AS h FROM files),
c AS (SELECT source_root_id, parent_group, cell, sha256(string_agg(h, ',' ORDER BY h)) AS h FROM e GROUP BY 1, 2, 3), g AS (SELECT source_root_id, parent_group, sha256(string_agg(h, ',' ORDER BY cell)) AS h FROM c GROUP BY 1, 2)
SELECT sha256(string_agg(h, ',' ORDER BY source_root_id, parent_group)) AS fingerprint, count(*) AS groups FROM g""")
def fingerprint(spark, sf_dir):
    return I.fingerprint(files(spark, sf_dir))


_ERRORS = FILES + """, errors AS (SELECT file_instance_id, source_root_id, relative_path, parent_group, 'hash' AS stage, 'OSError' AS error_category FROM files WHERE doc_id % 89 = 0
  UNION ALL SELECT file_instance_id, source_root_id, relative_path, parent_group, 'pdf_open', 'FileDataError' FROM files WHERE doc_id % 97 = 0
  UNION ALL SELECT file_instance_id, source_root_id, relative_path, parent_group, 'metadata', 'zero_page_count' FROM files WHERE doc_id % 53 = 0
  UNION ALL SELECT file_instance_id, source_root_id, relative_path, parent_group, 'text_sample', 'RuntimeError' FROM files WHERE doc_id % 41 = 0 OR doc_id % 43 = 0)
"""


@query(_ERRORS + "SELECT * FROM errors")
def error_rows(spark, sf_dir):
    return I.error_rows(files(spark, sf_dir))


@query(_ERRORS + "SELECT CASE WHEN doc_id % 2 = 0 THEN '<unknown>' ELSE e.parent_group END AS parent_group, count(*) AS n FROM errors e JOIN files f USING (file_instance_id) GROUP BY 1")
def errors_by_group(spark, sf_dir):
    f = files(spark, sf_dir)
    known = f.select("file_instance_id", F.when(every(2), "").otherwise(F.col("parent_group")).alias("parent_group"))
    return I.error_counts_by_group(I.error_rows(f), known)


@query(_ERRORS + "SELECT 'stage' AS dimension, stage AS value, count(*) AS n FROM errors GROUP BY stage UNION ALL SELECT 'category', error_category, count(*) FROM errors GROUP BY error_category UNION ALL SELECT 'parent_group', parent_group, count(*) FROM errors GROUP BY parent_group")
def error_breakdown(spark, sf_dir):
    return I.error_breakdown(I.error_rows(files(spark, sf_dir)))


@query(FILES + "SELECT source_root_id, parent_group, file_name, relative_path FROM files WHERE filename_parse_status = 'unmatched' ORDER BY source_root_id, relative_path LIMIT 20")
def unmatched_examples(spark, sf_dir):
    return I.unmatched_examples(files(spark, sf_dir))


# ---------------------------------------------------------------- snapshots, checkpoints, checks


def before_and_after(spark, sf_dir):
    """Two snapshots of the files: some are gone, new or changed in the second."""
    f = files(spark, sf_dir).select("doc_id", "source_root_id", "relative_path", "size_bytes", "mtime_ns", "file_instance_id", "parent_group")
    return f.where(~every(19)), f.where(~every(13)).withColumn("size_bytes", F.col("size_bytes") + F.when(every(29), 1).otherwise(0))


@query(FILES + """, d AS (SELECT CASE WHEN doc_id % 19 = 0 THEN 'added' WHEN doc_id % 13 = 0 THEN 'missing' ELSE 'metadata_changed' END AS change, source_root_id || ':' || relative_path AS name, source_root_id, relative_path
  FROM files WHERE (doc_id % 19 = 0) <> (doc_id % 13 = 0) OR (doc_id % 29 = 0 AND doc_id % 19 <> 0 AND doc_id % 13 <> 0)),
r AS (SELECT *, row_number() OVER (PARTITION BY change ORDER BY source_root_id, relative_path) AS i FROM d)
SELECT change, count(*) AS n, string_agg(name, '|' ORDER BY name) FILTER (WHERE i <= 20) AS examples FROM r GROUP BY change""")
def snapshot_diff(spark, sf_dir):
    return S.diff_summary(S.snapshot_diff(*before_and_after(spark, sf_dir)))


@query(FILES + "SELECT file_instance_id, CASE WHEN doc_id % 3 = 0 THEN 'process' WHEN doc_id % 11 = 0 THEN 'reprocess' ELSE 'reuse' END AS action, CASE WHEN doc_id % 3 <> 0 AND doc_id % 11 = 0 THEN 'source_changed_since_checkpoint' END AS error_category FROM files")
def checkpoint_reconcile(spark, sf_dir):
    f = files(spark, sf_dir)
    part = f.where(~every(3)).select("file_instance_id", "size_bytes", F.when(every(11), 0).otherwise(F.col("mtime_ns")).alias("mtime_ns"), F.lit(2).alias("batch_id"))
    older = f.where(every(4) & ~every(3)).select("file_instance_id", F.lit(-1).cast("long").alias("size_bytes"), "mtime_ns", F.lit(1).alias("batch_id"))
    return S.reconcile(f, part.unionByName(older))


@query(FILES + """, parts AS (SELECT CASE WHEN doc_id % 61 = 0 THEN 'unknown-' || doc_id ELSE file_instance_id END AS file_instance_id, doc_id % 10 AS batch_id, CASE WHEN doc_id % 67 = 0 THEN 'other' ELSE 'run' END AS inventory_run_id FROM files
  UNION ALL SELECT file_instance_id, doc_id % 10, 'run' FROM files WHERE doc_id % 71 = 0 AND doc_id % 61 <> 0), others AS (SELECT DISTINCT doc_id % 10 AS batch_id FROM files WHERE doc_id % 10 <> 3 UNION SELECT 11),
found AS (SELECT 'unpaired_part' AS violation FROM (SELECT DISTINCT batch_id FROM parts) p LEFT JOIN others o USING (batch_id) WHERE o.batch_id IS NULL UNION ALL SELECT 'unpaired_part' FROM others o LEFT JOIN (SELECT DISTINCT batch_id AS b FROM parts) p ON o.batch_id = p.b WHERE p.b IS NULL
  UNION ALL SELECT 'unknown_id' FROM parts WHERE file_instance_id LIKE 'unknown-%' UNION ALL SELECT 'repeated_id' FROM parts GROUP BY file_instance_id HAVING count(*) > 1 UNION ALL SELECT 'other_run' FROM parts WHERE inventory_run_id <> 'run')
SELECT violation, count(*) AS n FROM found GROUP BY violation""")
def checkpoint_validate(spark, sf_dir):
    f = files(spark, sf_dir).select("doc_id", "file_instance_id", (F.col("doc_id") % 10).alias("batch_id"))
    bad = f.select(F.when(every(61), F.concat(F.lit("unknown-"), F.col("doc_id").cast("string"))).otherwise(F.col("file_instance_id")).alias("file_instance_id"), "batch_id", F.when(every(67), "other").otherwise("run").alias("inventory_run_id"))
    parts = bad.union(f.where(every(71) & ~every(61)).select("file_instance_id", "batch_id", F.lit("run")))
    errors = f.where("batch_id <> 3").select("batch_id").distinct().union(spark.range(11, 12).toDF("batch_id"))
    return S.checkpoint_violations(parts, errors, f, "run")


@query("SELECT count(*) FILTER (WHERE doc_id % 13 <> 0) AS selected, count(*) FILTER (WHERE doc_id % 19 <> 0) AS processed, count(*) FILTER (WHERE doc_id % 13 <> 0 AND doc_id % 19 = 0) AS not_processed, count(*) FILTER (WHERE doc_id % 13 = 0 AND doc_id % 19 <> 0) AS not_selected, count(*) FILTER (WHERE (doc_id % 13 = 0) <> (doc_id % 19 = 0)) = 0 AS equal FROM documents")
def accounting(spark, sf_dir):
    f = files(spark, sf_dir)
    return S.accounting(f.where(~every(13)), f.where(~every(19)))


@query("SELECT doc_id, 2::BIGINT AS sets FROM labels WHERE quality = 0 AND toxic = 1")
def overlap_check(spark, sf_dir):
    """Documents that are in the set of bad ones and in that of toxic ones."""
    d = spark.read.parquet(f"{sf_dir}/labels.parquet")
    both = d.where("quality = 0").select("doc_id", F.lit("a").alias("s")).union(d.where("toxic = 1").select("doc_id", F.lit("b")))
    return S.overlaps(both, "doc_id", "s")


@query(FILES + ", r AS (SELECT source_root_id, count(*) AS f, count(DISTINCT parent_group) AS g FROM files GROUP BY 1) SELECT sum(f)::BIGINT AS files, sum(g)::BIGINT AS groups, sum(f)::BIGINT - 1000 AS file_difference, sum(g)::BIGINT - 80 AS group_difference, CASE WHEN sum(f) = 1000 AND sum(g) = 80 THEN 'PASS' ELSE 'HOLD' END AS gate FROM r")
def count_gate(spark, sf_dir):
    return S.count_gate(files(spark, sf_dir), 1000, 80)


@query(FILES + """, items AS (SELECT file_instance_id, CASE WHEN doc_id % 31 = 0 THEN 'x' ELSE file_instance_id END AS recomputed_id FROM files UNION ALL SELECT file_instance_id, file_instance_id FROM files WHERE doc_id % 37 = 0),
found AS (SELECT 'count_differs' AS violation FROM items HAVING count(*) <> 5 UNION ALL SELECT 'wrong_id' FROM items WHERE file_instance_id <> recomputed_id UNION ALL SELECT 'repeated_id' FROM items GROUP BY file_instance_id HAVING count(*) > 1)
SELECT violation, count(*) AS n FROM found GROUP BY violation""")
def manifest_validate(spark, sf_dir):
    f = files(spark, sf_dir)
    own = T.file_instance_id(F.col("source_root_id"), F.col("relative_path"))
    items = f.select("file_instance_id", F.when(every(31), "x").otherwise(own).alias("recomputed_id"))
    return S.manifest_violations(items.union(f.where(every(37)).select("file_instance_id", own)), 5)


@query("SELECT doc_id, doc_id % 6 > 3 AS safe FROM documents")
def path_guard(spark, sf_dir):
    number = F.col("doc_id").cast("string")
    shapes = [F.concat(F.lit("/"), number), F.concat(F.lit("a/../"), number), F.concat(F.lit("a//"), number), F.concat(F.lit("./"), number), F.concat(F.lit("a/"), number), F.concat(F.lit("a/..b/"), number)]
    path = F.element_at(F.array(*shapes), (F.col("doc_id") % 6 + 1).cast("int"))
    return documents(spark, sf_dir).select("doc_id", T.safe_relative_path(path).alias("safe"))


@query("""SELECT source, CASE WHEN max(n_chars) <= 20000 AND count(*) % 2 = 0 AND min(doc_id) >= 5 THEN 'PASS' ELSE 'HOLD' END AS verdict,
  concat_ws('; ', CASE WHEN max(n_chars) > 20000 THEN 'long files' END, CASE WHEN count(*) % 2 <> 0 THEN 'odd count' END, CASE WHEN min(doc_id) < 5 THEN 'early files' END) AS reasons FROM documents GROUP BY source""")
def verdict(spark, sf_dir):
    groups = documents(spark, sf_dir).groupBy("source").agg(F.max("n_chars").alias("longest"), F.count("*").alias("n"), F.min("doc_id").alias("first"))
    return groups.select("source", *S.verdict([(F.col("longest") > 20000, "long files"), (F.col("n") % 2 != 0, "odd count"), (F.col("first") < 5, "early files")]))


@query("SELECT doc_id, doc_id % 89 = 0 AND doc_id % 97 <> 0 AND doc_id % 53 <> 0 AND doc_id % 41 <> 0 AND doc_id % 43 <> 0 AS retryable FROM documents")
def retryable(spark, sf_dir):
    return files(spark, sf_dir).select("doc_id", S.is_retryable(F.col("errors")).alias("retryable"))


@query("""WITH a AS (SELECT user_id AS task, least(count(*) - 1, 2) AS last, arg_max(event_type, event_id) = 'error' AS failed FROM events GROUP BY user_id)
SELECT sum(last)::BIGINT AS retry_attempts_total, count(*) FILTER (WHERE last > 0 AND NOT failed) AS recovered_by_retry, count(*) FILTER (WHERE last >= 2 AND failed) AS retry_exhausted FROM a""")
def retry_accounting(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.col("user_id").alias("task")).agg((F.least(F.count("*"), F.lit(3)) - 1).alias("last"), (F.max_by("event_type", "event_id") == "error").alias("failed"))
    attempt = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    tries = events.select("task", "last", "failed", attempt.alias("attempt")).withColumn("has_errors", F.when(F.col("attempt") < F.col("last"), True).otherwise(F.col("failed")))
    return S.retry_accounting(tries.withColumn("retryable", F.col("has_errors")))


@query("SELECT lang AS root, doc_id FROM documents")
def union_roots(spark, sf_dir):
    d = documents(spark, sf_dir).select(F.col("lang").alias("root"), "doc_id")
    out = d.where("root = 'en'")
    for root in ("de", "fr", "es"):
        out = out.unionByName(d.where(F.col("root") == root))
    return out


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_except(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id").subtract(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id"))


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def set_intersect(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id").intersect(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id"))


@query("SELECT event_id AS line, CASE WHEN json_valid(props) THEN json_type(props) = 'OBJECT' ELSE false END AS ok, CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN len(json_keys(props)) ELSE 0 END AS fields FROM events")
def jsonl_strict(spark, sf_dir):
    """Event properties as a JSON-lines table, read strictly."""
    from sieveline.sources.jsonl import strict_lines

    return strict_lines(spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("line"), F.col("props").alias("value")))


