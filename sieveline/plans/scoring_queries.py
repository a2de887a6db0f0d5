"""Queries over evaluation scores, beyond what is implemented elsewhere: the design documents' measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import scoring as S
from sieveline.plans.corpus import Registry, documents, every

registry = query = Registry()


def items(spark, sf_dir):
    """Scored items: tracks are languages, some items have no score."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("item_id"), F.col("lang").alias("track"), F.col("source").alias("domain"), F.when(~every(9), F.col("doc_id") % 4 / 3).alias("score"))


_ITEMS = "WITH items AS (SELECT doc_id AS item_id, lang AS track, source AS domain, CASE WHEN doc_id % 9 <> 0 THEN (doc_id % 4) / 3 END AS score FROM documents) "


@query("""WITH c AS (SELECT doc_id, doc_id % 3 AS a, doc_id % 5 AS b, doc_id % 2 AS k FROM documents), s AS (SELECT doc_id, CASE WHEN a = b THEN 1 ELSE 2 END AS na, CASE WHEN k = 0 THEN 1 ELSE 2 END AS nk, CASE WHEN 0 IN (a, b) THEN 1 ELSE 0 END + CASE WHEN k = 1 AND 1 IN (a, b) THEN 1 ELSE 0 END AS hit FROM c)
SELECT doc_id, CASE WHEN hit = na AND hit = nk THEN 1 ELSE 0 END AS exact, round(hit / na, 6) AS precision, round(hit / nk, 6) AS recall, round(2 * hit / (na + nk), 6) AS f1 FROM s""")
def choice_scores(spark, sf_dir):
    """Options chosen: two numbers of the id; right: 0, and for odd ids 0 and 1."""
    d = F.col("doc_id")
    own = S.choice_scores(F.array(d % 3, d % 5), F.when(d % 2 == 0, F.array(F.lit(0).cast("long"))).otherwise(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))))
    return documents(spark, sf_dir).select("doc_id", own["exact"].alias("exact"), *(F.round(own[k], 6).alias(k) for k in ("precision", "recall", "f1")))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN abs(n_chars - 1000) <= greatest(50, 100) WHEN 1 THEN abs(n_chars - 1000) <= 50 WHEN 2 THEN abs(n_chars - 1000) <= 100 ELSE n_chars = 1000 END AS within FROM documents")
def numeric_tolerance(spark, sf_dir):
    d = F.col("doc_id") % 4
    ok = S.within_tolerance(F.col("n_chars").cast("double"), F.lit(1000.0), F.when(d < 2, F.lit(50.0)), F.when((d == 0) | (d == 2), F.lit(0.1)))
    return documents(spark, sf_dir).select("doc_id", ok.alias("within"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE NULL END AS value FROM documents")
def boolean_answers(spark, sf_dir):
    word = F.element_at(F.array(*map(F.lit, (" Yes", "FALSE", "t\n", "maybe"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return documents(spark, sf_dir).select("doc_id", S.as_boolean(word).alias("value"))


@query("SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE round((1 + doc_id % 2) / 2, 6) END AS score FROM documents")
def structured_score(spark, sf_dir):
    fields = F.array(F.when(~every(6), F.lit(1.0)), (F.col("doc_id") % 2).cast("double"))
    return documents(spark, sf_dir).select("doc_id", F.round(S.structured_score(fields), 6).alias("score"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 ELSE NULL END AS score FROM documents")
def item_scores(spark, sf_dir):
    status = F.element_at(F.array(*map(F.lit, ("scored", "refused", "unparsed", "not_run"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return documents(spark, sf_dir).select("doc_id", S.item_score(F.lit(0.5), status).alias("score"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'normalised' WHEN 2 THEN 'alias' WHEN 3 THEN 'pattern' ELSE NULL END AS stage FROM documents")
def short_answers(spark, sf_dir):
    answer = F.element_at(F.array(*map(F.lit, ("Deep groove", " deep  GROOVE", "DGB", "groove 42", "other"))), (F.col("doc_id") % 5 + 1).cast("int"))
    return documents(spark, sf_dir).select("doc_id", S.short_answer(answer, F.lit("Deep groove"), F.array(F.lit("dgb")), F.lit("^groove [0-9]+$")).alias("stage"))


@query(_ITEMS + ", t AS (SELECT track, avg(score) AS score, count(score) AS item_count FROM items GROUP BY track) SELECT track, round(score, 6) AS score, item_count FROM t UNION ALL SELECT 'overall', round(avg(score), 6), sum(item_count)::BIGINT FROM t")
def track_means(spark, sf_dir):
    return S.track_means(items(spark, sf_dir)).withColumn("score", F.round("score", 6))


@query(_ITEMS + "SELECT track, domain, round(avg(score), 6) AS score, count(score) AS item_count FROM items GROUP BY GROUPING SETS ((track), (domain), (track, domain))")
def slice_metrics(spark, sf_dir):
    return S.slices(items(spark, sf_dir), "track", "domain").withColumn("score", F.round("score", 6))


_STEPS = ", ".join(f"({e!r})" for e in S.poisson_steps())


@query(_ITEMS + f""", d AS (SELECT track, score, b * 4 + k AS draw, substr(md5(item_id || '-7-' || b), (k * 8 + 1)::INTEGER, 8) AS w FROM items, (SELECT range AS b FROM range(50)), (SELECT range AS k FROM range(4)) WHERE score IS NOT NULL),
u AS (SELECT track, score, draw, list_sum(list_transform(range(8), lambda i: (strpos('0123456789abcdef', substr(w, (i + 1)::INTEGER, 1)) - 1) * pow(16, 7 - i))) / 4294967296.0 AS u FROM d),
t AS (SELECT track, score, draw, (SELECT count(*) FROM (VALUES {_STEPS}) s(e) WHERE u.u >= s.e) AS times FROM u),
m AS (SELECT track, draw, sum(score * times) / sum(times) AS mean FROM t GROUP BY track, draw)
SELECT track, round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.975), 6) AS high FROM m GROUP BY track""")
def bootstrap_interval(spark, sf_dir):
    return S.bootstrap(items(spark, sf_dir)).select("track", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query(_ITEMS + ", r AS (SELECT item_id, row_number() OVER (ORDER BY sha256(item_id::VARCHAR || 'rev-1'), item_id) AS place, count(*) OVER () AS n FROM items) SELECT item_id, place FROM r WHERE place <= ceil(n * 0.1)")
def audit_tenth(spark, sf_dir):
    return S.audit_sample(items(spark, sf_dir), "rev-1")


@query(_ITEMS + "SELECT domain, count(*) FILTER (WHERE track = 'de') AS de, count(*) FILTER (WHERE track = 'en') AS en, count(*) FILTER (WHERE track = 'es') AS es, count(*) FILTER (WHERE track = 'fr') AS fr FROM items GROUP BY domain")
def group_matrix(spark, sf_dir):
    return S.group_matrix(items(spark, sf_dir), "domain", "track", ["de", "en", "es", "fr"])


@query("SELECT doc_id AS item_id, CASE WHEN n_chars < 500 THEN 'too_short' WHEN doc_id % 7 = 0 THEN 'restricted' END AS reason FROM documents WHERE n_chars < 500 OR doc_id % 7 = 0")
def hard_exclusions(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("item_id", F.col("doc_id"))
    return S.exclusions(rows, [(F.col("n_chars") < 500, "too_short"), (every(7), "restricted")])


_RESULTS = "WITH results AS (SELECT user_id % 50 AS item_id, event_type AS model, avg(CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE 0.0 END) AS score FROM events GROUP BY 1, 2), "


@query(_RESULTS + """st AS (SELECT model, ntile(2) OVER (ORDER BY avg(score) DESC, model) AS half FROM results GROUP BY model)
SELECT item_id, round(avg(score), 6) AS difficulty, round(avg(score) FILTER (WHERE half = 1) - avg(score) FILTER (WHERE half = 2), 6) AS discrimination, min(score) >= 1 AS ceiling, max(score) <= 0 AS floor FROM results JOIN st USING (model) GROUP BY item_id""")
def item_difficulty(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    results = events.groupBy((F.col("user_id") % 50).alias("item_id"), F.col("event_type").alias("model")).agg(F.avg(F.when(F.col("event_id") % 3 == 0, 1.0).otherwise(0.0)).alias("score"))
    return S.difficulty(results).withColumn("difficulty", F.round("difficulty", 6)).withColumn("discrimination", F.round("discrimination", 6))
