"""Queries over samples: first per group, spread, quotas, pools, batches, and evidence by scope."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import evidence as E, inventory as I, ranking as R, sampling as S
from sieveline.plans.corpus import DUPLICATES, FILES, Registry, documents, every, files, staged, uuid_sql

registry = query = Registry()

#: i-th of k evenly spaced places among n, listed (the queries test each row instead)
_PLACES = "SELECT DISTINCT {key}, CASE WHEN n <= k THEN i WHEN k = 1 THEN 0 ELSE (i * (n - 1) + (k - 1) // 2) // (k - 1) END AS idx FROM {sizes}, (SELECT range AS i FROM range(5000)) WHERE i < least(n, k)"


@query(FILES + "SELECT source_root_id, parent_group, min(relative_path) AS relative_path FROM files GROUP BY 1, 2")
def d1_sample(spark, sf_dir):
    return S.first_per_group(files(spark, sf_dir)).select("source_root_id", "parent_group", "relative_path")


@query("WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n, 7 AS k FROM documents), s AS (SELECT DISTINCT source, n, k FROM r), p AS (" + _PLACES.format(key="source", sizes="s") + ") SELECT r.doc_id, r.source, r.idx FROM r JOIN p USING (source, idx)")
def evenly_spaced(spark, sf_dir):
    return R.evenly_spaced(documents(spark, sf_dir), ["source"], ["doc_id"], 7).select("doc_id", "source", "idx")


_D1 = ", d1 AS (SELECT source_root_id, parent_group, min(relative_path) AS relative_path FROM files GROUP BY 1, 2), rest AS (SELECT * FROM files f WHERE relative_path NOT IN (SELECT relative_path FROM d1))"


@query(FILES + _D1 + ", r AS (SELECT doc_id, source_root_id, parent_group, row_number() OVER (PARTITION BY source_root_id, parent_group ORDER BY relative_path) - 1 AS idx, count(*) OVER (PARTITION BY source_root_id, parent_group) AS n, 4 AS k FROM rest), s AS (SELECT DISTINCT source_root_id, parent_group, n, k FROM r), p AS (" + _PLACES.format(key="source_root_id, parent_group", sizes="s") + ") SELECT r.doc_id, r.idx, (SELECT count(*) FROM d1) AS group_count FROM r JOIN p USING (source_root_id, parent_group, idx)")
def d2_sample(spark, sf_dir):
    f = files(spark, sf_dir)
    return S.spread_sample(f, S.first_per_group(f), 4).select("doc_id", "idx", "group_count")


def quota_sql(counts: str, key: str, target: int, base: int) -> str:
    """CTEs that end in `quotas`, from a CTE `counts` of key and population."""
    return f"""{counts},
b AS (SELECT *, least({base}, population) AS base_quota FROM counts WHERE population > 0),
g AS (SELECT *, population - base_quota AS capacity, least({target}, sum(population) OVER ()) - sum(base_quota) OVER () AS extra FROM b),
h AS (SELECT *, (sum(capacity) OVER ())::BIGINT AS total, least(extra, sum(capacity) OVER ())::BIGINT AS goal FROM g),
fl AS (SELECT *, CASE WHEN total = 0 THEN 0 ELSE (goal * capacity) // total END AS floors, CASE WHEN total = 0 THEN 0 ELSE (goal * capacity) % total END AS remainder FROM h),
w AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY remainder DESC, {key}) <= goal - sum(floors) OVER () THEN 1 ELSE 0 END AS award FROM fl),
quotas AS (SELECT {key}, population, base_quota, floors AS proportional_quota, remainder, award AS largest_remainder_award, base_quota + floors + award AS final_quota FROM w)"""


_RG = "source_root_id, parent_group"
_QUOTAS = FILES + _D1 + quota_sql(f", counts AS (SELECT {_RG}, count(*) AS population FROM rest GROUP BY 1, 2)", _RG, 500, 5)


@query(_QUOTAS + "SELECT source_root_id, parent_group, population, base_quota, proportional_quota, round(remainder / (SELECT max(total) FROM h), 6) AS remainder, largest_remainder_award, final_quota FROM quotas")
def quota_table(spark, sf_dir):
    f = files(spark, sf_dir)
    return S.quota_table(f, S.first_per_group(f), 500, 5).withColumn("remainder", F.round(F.col("remainder") / F.col("capacity_total"), 6)).drop("capacity_total")


@query(_QUOTAS + ", r AS (SELECT f.doc_id, f.source_root_id, f.parent_group, row_number() OVER (PARTITION BY f.source_root_id, f.parent_group ORDER BY relative_path) - 1 AS idx, population AS n, final_quota AS k FROM rest f JOIN quotas q ON f.source_root_id = q.source_root_id AND f.parent_group = q.parent_group), s AS (SELECT DISTINCT source_root_id, parent_group, n, k FROM r), p AS (" + _PLACES.format(key=_RG, sizes="s") + ") SELECT r.doc_id, r.idx, r.k AS final_quota FROM r JOIN p USING (source_root_id, parent_group, idx)")
def d3_sample(spark, sf_dir):
    f = files(spark, sf_dir)
    return S.proportional_sample(f, S.first_per_group(f), 500, 5).select("doc_id", "idx", "final_quota")


@query("""WITH c AS (SELECT source, count(*) AS capacity FROM documents GROUP BY source), t AS (SELECT *, (sum(capacity) OVER ())::BIGINT AS total FROM c),
f AS (SELECT *, (least(101, total) * capacity) // total AS floor_share, (least(101, total) * capacity) % total AS remainder FROM t)
SELECT source, capacity, floor_share, CASE WHEN row_number() OVER (ORDER BY remainder DESC, source) <= least(101, total) - sum(floor_share) OVER () THEN 1 ELSE 0 END AS award FROM f""")
def hamilton(spark, sf_dir):
    capacities = documents(spark, sf_dir).groupBy("source").agg(F.count("*").alias("capacity"))
    return R.hamilton(capacities, ["source"], "capacity", F.lit(101)).select("source", "capacity", "floor_share", "award")


_HEALTHY = "inventory_status = 'success' AND pdf_open_status = 'success' AND page_count > 0"


@query(FILES + f"SELECT doc_id FROM files WHERE {_HEALTHY} AND text_layer_status IN ('text_present', 'mixed_or_uncertain')")
def main_eligible(spark, sf_dir):
    return files(spark, sf_dir).where(S.is_main_eligible()).select("doc_id")


@query(FILES + f"SELECT 'text_absent' AS pool, doc_id FROM files WHERE {_HEALTHY} AND text_layer_status = 'text_absent' UNION ALL SELECT 'mixed_text', doc_id FROM files WHERE {_HEALTHY} AND text_layer_status = 'mixed_or_uncertain' UNION ALL SELECT 'filename_unmatched', doc_id FROM files WHERE {_HEALTHY} AND filename_parse_status = 'unmatched'")
def audit_candidates(spark, sf_dir):
    f = files(spark, sf_dir)
    one, two, three = (S.audit_candidates(f, p).select(F.lit(p).alias("pool"), "doc_id") for p in S.AUDIT)
    return one.union(two).union(three)


# the cascade: main, exceptions and three audit pools, each from what the earlier ones left
MAIN_TARGET, MAIN_BASE, AUDIT_TARGETS = 200, 5, {"text_absent": 25, "mixed_text": 22, "filename_unmatched": 24}


def _pool_sql(name: str, candidates: str, target: int, base: int) -> str:
    n = name
    quota = quota_sql(f", c_{n} AS ({candidates}), counts_{n} AS (SELECT parent_group, count(*) AS population FROM c_{n} GROUP BY 1)", "parent_group", target, base)
    for cte in ("b", "g", "h", "fl", "w", "quotas"):
        quota = quota.replace(f"\n{cte} AS (", f"\n{cte}_{n} AS (")
    for a, b in (("counts WHERE", f"counts_{n} WHERE"), ("FROM b)", f"FROM b_{n})"), ("FROM g)", f"FROM g_{n})"), ("FROM h)", f"FROM h_{n})"), ("FROM fl)", f"FROM fl_{n})"), ("FROM w)", f"FROM w_{n})")):
        quota = quota.replace(a, b)
    return (
        quota
        + f""",
r_{n} AS (SELECT c.file_instance_id, c.doc_id, c.parent_group, c.relative_path, row_number() OVER (PARTITION BY c.parent_group ORDER BY relative_path, file_instance_id) - 1 AS idx, population AS n, final_quota AS k FROM c_{n} c JOIN quotas_{n} q ON c.parent_group = q.parent_group),
s_{n} AS (SELECT DISTINCT parent_group, n, k FROM r_{n}), p_{n} AS ({_PLACES.format(key="parent_group", sizes=f"s_{n}")}),
{n} AS (SELECT r.doc_id, r.file_instance_id, r.parent_group, r.relative_path, '{n}' AS pool_name, r.n AS group_population, r.k AS group_quota, r.idx AS selection_index FROM r_{n} r JOIN p_{n} USING (parent_group, idx))"""
    )


def _cascade() -> str:
    collapsed = "file_instance_id NOT IN (SELECT file_instance_id FROM duplicates WHERE NOT is_representative)"
    sql = DUPLICATES + _pool_sql("main", f"SELECT * FROM files WHERE {_HEALTHY} AND text_layer_status IN ('text_present', 'mixed_or_uncertain') AND {collapsed}", MAIN_TARGET, MAIN_BASE)
    sql += """,
source_quality_exception AS (SELECT doc_id, file_instance_id, parent_group, relative_path, 'source_quality_exception' AS pool_name, count(*) OVER (PARTITION BY parent_group) AS group_population, count(*) OVER (PARTITION BY parent_group) AS group_quota,
  row_number() OVER (ORDER BY parent_group, relative_path, file_instance_id) - 1 AS selection_index FROM files WHERE inventory_status = 'partial' AND file_instance_id NOT IN (SELECT file_instance_id FROM main))"""
    used = ["main", "source_quality_exception"]
    for name, (column, value) in S.AUDIT.items():
        left = " AND ".join(f"file_instance_id NOT IN (SELECT file_instance_id FROM {u})" for u in used)
        sql += _pool_sql(name, f"SELECT * FROM files WHERE {_HEALTHY} AND {column} = '{value}' AND {left} AND {collapsed}", AUDIT_TARGETS[name], 1)
        used.append(name)
    union = " UNION ALL ".join(f"SELECT * FROM {u}" for u in used)
    return sql + f", pools AS ({union}) "


CASCADE = _cascade()


def pools(spark, sf_dir):
    write = staged(spark, "pools")
    f = write(files(spark, sf_dir), "files")
    d = write(I.exact_duplicates(f), "duplicates")
    return f, d, S.calibration_pools(f, d, MAIN_TARGET, MAIN_BASE, AUDIT_TARGETS, stage=write)


@query(CASCADE + "SELECT doc_id, group_population, group_quota, selection_index FROM main")
def main_pool(spark, sf_dir):
    f = staged(spark, "main")(files(spark, sf_dir), "files")
    eligible = I.collapse_duplicates(f.where(S.is_main_eligible()), I.exact_duplicates(f))
    return S.grouped_pool(eligible, "main", MAIN_TARGET, MAIN_BASE).select("doc_id", "group_population", "group_quota", "selection_index")


@query(FILES + "SELECT doc_id, count(*) OVER (PARTITION BY parent_group) AS group_population, i AS selection_index FROM (SELECT *, row_number() OVER (ORDER BY parent_group, relative_path, file_instance_id) - 1 AS i FROM files WHERE inventory_status = 'partial')")
def exception_pool(spark, sf_dir):
    partial = files(spark, sf_dir).where("inventory_status = 'partial'")
    return S.exception_pool(partial).select("doc_id", "group_population", "selection_index")



@query(CASCADE + f"SELECT {uuid_sql("'corpus://calibration-item/sample-1/' || p.file_instance_id")} AS calibration_item_id, CASE WHEN pool_name = 'main' THEN 'main' ELSE 'audit' END AS sample_role, pool_name, p.file_instance_id, f.sha256, f.size_bytes, d.duplicate_group_id AS exact_duplicate_group_id, coalesce(d.is_representative, true) AS exact_duplicate_representative, group_population, group_quota, selection_index FROM pools p JOIN files f ON p.file_instance_id = f.file_instance_id LEFT JOIN duplicates d ON p.file_instance_id = d.file_instance_id")
def pool_items(spark, sf_dir):
    f, d, p = pools(spark, sf_dir)
    return S.pool_items(p, f, d, "sample-1").select("calibration_item_id", "sample_role", "pool_name", "file_instance_id", "sha256", "size_bytes", "exact_duplicate_group_id", "exact_duplicate_representative", "group_population", "group_quota", "selection_index")


@query(CASCADE + """, e AS (SELECT sha256(concat_ws('|', pool_name, parent_group, relative_path, group_population::VARCHAR, group_quota::VARCHAR, selection_index::VARCHAR)) AS h FROM pools),
six AS (SELECT substr(h, 1, 6) AS six, sha256(string_agg(h, ',' ORDER BY h)) AS h, count(*) AS items FROM e GROUP BY 1), three AS (SELECT substr(six, 1, 3) AS three, sha256(string_agg(h, ',' ORDER BY h)) AS h, sum(items) AS items FROM six GROUP BY 1)
SELECT sha256(string_agg(h, ',' ORDER BY h)) AS selection_hash, sum(items)::BIGINT AS items FROM three""")
def selection_hash(spark, sf_dir):
    return S.selection_hash(pools(spark, sf_dir)[2])


@query(CASCADE + "SELECT pool_name, count(*) AS actual, count(DISTINCT parent_group) AS groups, sum(selection_index)::BIGINT AS index_sum, count(*) = count(DISTINCT file_instance_id) AS is_disjoint FROM pools GROUP BY pool_name")
def selection_stats(spark, sf_dir):
    return pools(spark, sf_dir)[2].groupBy("pool_name").agg(F.count("*").alias("actual"), F.count_distinct("parent_group").alias("groups"), F.sum("selection_index").alias("index_sum"), (F.count("*") == F.count_distinct("file_instance_id")).alias("is_disjoint"))


@query(FILES + _D1 + "SELECT f.source_root_id, count(*) AS items, string_agg(f.file_instance_id, ',' ORDER BY f.relative_path) AS ids FROM files f JOIN d1 ON f.source_root_id = d1.source_root_id AND f.relative_path = d1.relative_path GROUP BY 1")
def sample_manifest(spark, sf_dir):
    """The ids of the first sample by root; one id for each group."""
    first = S.first_per_group(files(spark, sf_dir))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("relative_path", "file_instance_id"))), lambda x: x["file_instance_id"]), ",")
    return first.groupBy("source_root_id").agg(F.count("*").alias("items"), ids.alias("ids"))


@query("SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 500 AS batch_id FROM events")
def batches(spark, sf_dir):
    return S.batches(spark.read.parquet(f"{sf_dir}/events.parquet"), ["ts", "event_id"], 500).select("event_id", "batch_id")


@query(FILES + """, e AS (SELECT source_root_id AS pool_name, parent_group, CASE WHEN doc_id % 17 = 0 THEN 'failed' WHEN doc_id % 5 = 0 THEN 'partial' WHEN doc_id % 7 = 0 THEN 'not_applicable' ELSE 'success' END AS evidence_status, n_chars > 3000 AS evidence_truncated,
  CASE WHEN doc_id % 11 = 0 THEN 0 ELSE n_chars END AS raw_text_char_count, least(n_chars, 3000) AS evidence_char_count, CASE WHEN filename_parse_status = 'matched' THEN 'Title' END AS filename_title FROM files),
m AS (SELECT 'overall' AS scope, '' AS name, * FROM e UNION ALL SELECT 'pool', pool_name, * FROM e UNION ALL SELECT 'group', parent_group, * FROM e)
SELECT scope, name, count(*) AS count, count(*) FILTER (WHERE evidence_status = 'success') AS success_count, count(*) FILTER (WHERE evidence_status = 'partial') AS partial_count, count(*) FILTER (WHERE evidence_status = 'failed') AS failed_count, count(*) FILTER (WHERE evidence_status = 'not_applicable') AS not_applicable_count,
  count(*) FILTER (WHERE evidence_truncated) AS truncated_count, count(*) FILTER (WHERE evidence_status IN ('success', 'partial') AND raw_text_char_count = 0) AS zero_text_count, sum(evidence_char_count)::BIGINT AS evidence_chars, round(count(filename_title) / count(*), 6) AS filename_title_rate FROM m GROUP BY scope, name""")
def evidence_metrics(spark, sf_dir):
    f = files(spark, sf_dir)
    status = F.when(every(17), "failed").when(every(5), "partial").when(every(7), "not_applicable").otherwise("success")
    rows = f.select(
        F.col("source_root_id").alias("pool_name"), "parent_group", status.alias("evidence_status"), (F.col("n_chars") > 3000).alias("evidence_truncated"),
        F.when(every(11), 0).otherwise(F.col("n_chars")).alias("raw_text_char_count"), F.least("n_chars", F.lit(3000)).alias("evidence_char_count"), F.when(F.col("filename_parse_status") == "matched", "Title").alias("filename_title"),
    )
    return E.evidence_metrics(rows).withColumn("filename_title_rate", F.round("filename_title_rate", 6))
