"""Queries over routing rules: grids, evaluation and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.operators import routing as R
from sieveline.plans.corpus import Registry, every, staged
from sieveline.plans.inventory_queries import SIGNALS, marked

registry = query = Registry()

#: reviewed rows (labels: quality 0 is the positive role)
ROWS = (
    SIGNALS
    + """, rows AS (SELECT c.doc_id AS calibration_item_id, CASE WHEN c.doc_id % 2 = 0 THEN 'main' ELSE 'audit' END AS pool_name, CASE WHEN l.quality = 0 THEN 'positive' WHEN l.quality = 1 THEN 'negative' END AS role,
  CASE WHEN c.doc_id % 23 <> 0 THEN fffd / total_chars END AS replacement_char_rate, CASE WHEN c.doc_id % 23 <> 0 THEN pua / total_chars END AS private_use_char_rate, CASE WHEN c.doc_id % 23 <> 0 THEN cc / total_chars END AS control_char_rate,
  CASE WHEN c.doc_id % 23 <> 0 THEN (total_chars - pua - cc - nl) / total_chars END AS printable_char_ratio, CASE WHEN c.doc_id % 23 <> 0 THEN (fffd + pua + cc) / total_chars END AS suspicious_char_rate
  FROM counted c LEFT JOIN labels l ON c.doc_id = l.doc_id),
long AS (SELECT calibration_item_id, pool_name, role, 'replacement_char_rate' AS signal, replacement_char_rate AS value, 1 AS sign FROM rows UNION ALL SELECT calibration_item_id, pool_name, role, 'private_use_char_rate', private_use_char_rate, 1 FROM rows
  UNION ALL SELECT calibration_item_id, pool_name, role, 'control_char_rate', control_char_rate, 1 FROM rows UNION ALL SELECT calibration_item_id, pool_name, role, 'printable_char_ratio', printable_char_ratio, -1 FROM rows UNION ALL SELECT calibration_item_id, pool_name, role, 'suspicious_char_rate', suspicious_char_rate, 1 FROM rows),
grid AS (SELECT DISTINCT signal, sign, value AS threshold FROM long WHERE role IS NOT NULL AND value IS NOT NULL),
tot AS (SELECT count(*) FILTER (WHERE role = 'positive') AS p, count(*) FILTER (WHERE pool_name = 'main') AS m FROM rows)
"""
)


def rows(spark, sf_dir):
    signals = marked(spark, sf_dir).select("doc_id", T.quality_signals(F.when(~every(23), F.col("t"))).alias("s"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.when(F.col("quality") == 0, "positive").when(F.col("quality") == 1, "negative").alias("role"))
    out = signals.select("doc_id", *(F.col("s")[s].alias(s) for s in R.SIGNALS)).join(labels, "doc_id", "left")
    return out.withColumnRenamed("doc_id", "calibration_item_id").withColumn("pool_name", F.when(F.col("calibration_item_id") % 2 == 0, "main").otherwise("audit"))


def written_rows(spark, sf_dir):
    """For the searches, which read the rows several times."""
    return staged(spark, "signals")(rows(spark, sf_dir), "rows")


@query(ROWS + "SELECT calibration_item_id, coalesce(suspicious_char_rate >= 0.01, false) AS triggered FROM rows")
def threshold_rule(spark, sf_dir):
    return rows(spark, sf_dir).select("calibration_item_id", R.threshold_rule("suspicious_char_rate", ">=", 0.01).alias("triggered"))


@query(ROWS + "SELECT calibration_item_id, coalesce(control_char_rate >= 0.01, false) OR coalesce(printable_char_ratio <= 0.98, false) AS triggered FROM rows")
def or_rule(spark, sf_dir):
    return rows(spark, sf_dir).select("calibration_item_id", R.or_rule(("control_char_rate", ">=", 0.01), ("printable_char_ratio", "<=", 0.98)).alias("triggered"))


@query(ROWS + "SELECT signal, threshold FROM grid")
def threshold_grid(spark, sf_dir):
    return R.threshold_grid(rows(spark, sf_dir))


@query(ROWS + "SELECT count(*) FILTER (WHERE role = 'positive' AND printable_char_ratio <= 0.99) AS true_positives, count(*) FILTER (WHERE role = 'negative' AND printable_char_ratio <= 0.99) AS false_positives, count(*) FILTER (WHERE pool_name = 'main' AND printable_char_ratio <= 0.99) AS main_triggered, round(count(*) FILTER (WHERE role = 'positive' AND printable_char_ratio <= 0.99) / count(*) FILTER (WHERE role = 'positive'), 6) AS recall, round(count(*) FILTER (WHERE pool_name = 'main' AND printable_char_ratio <= 0.99) / count(*) FILTER (WHERE pool_name = 'main'), 6) AS main_rate FROM rows")
def trigger_eval(spark, sf_dir):
    out = R.evaluate_trigger(rows(spark, sf_dir), R.threshold_rule("printable_char_ratio", "<=", 0.99))
    return out.withColumn("recall", F.round("recall", 6)).withColumn("main_rate", F.round("main_rate", 6))


_EVALUATED = """, ev AS (SELECT g.signal, g.threshold, count(*) FILTER (WHERE role = 'positive') AS true_positives, count(*) FILTER (WHERE role = 'negative') AS false_positives, count(*) FILTER (WHERE pool_name = 'main') AS main_triggered
  FROM grid g JOIN long l ON g.signal = l.signal AND l.value * g.sign >= g.threshold * g.sign GROUP BY g.signal, g.threshold),
rated AS (SELECT ev.*, true_positives / p AS recall, main_triggered / m AS main_rate FROM ev, tot),
best AS (SELECT *, row_number() OVER (PARTITION BY signal ORDER BY CASE WHEN abs(recall - 1) <= 1e-9 THEN 0 ELSE 1 END, CASE WHEN abs(recall - 1) <= 1e-9 THEN main_triggered ELSE -recall END, false_positives, threshold) AS r FROM rated)
"""


@query(ROWS + _EVALUATED + "SELECT signal, threshold, true_positives, false_positives, main_triggered, round(recall, 6) AS recall, CASE WHEN abs(recall - 1) <= 1e-9 AND main_rate <= 0.15 THEN 'automatic_pre_annotation_ocr' ELSE 'annotation_side_retry' END AS strategy FROM best WHERE r = 1")
def rule_search(spark, sf_dir):
    found = R.strategy(R.best(R.rule_search(written_rows(spark, sf_dir)), ["threshold"], ["signal"]))
    return found.select("signal", "threshold", "true_positives", "false_positives", "main_triggered", F.round("recall", 6).alias("recall"), "strategy")


@query(ROWS + _EVALUATED.split("rated AS")[0].rstrip().rstrip(",") + """, names AS (SELECT * FROM (VALUES ('replacement_char_rate', 1), ('private_use_char_rate', 2), ('control_char_rate', 3), ('printable_char_ratio', 4), ('suspicious_char_rate', 5)) v(signal, place)),
marks AS (SELECT signal, threshold, sign, place, row_number() OVER (PARTITION BY signal ORDER BY threshold * sign) AS lev FROM grid JOIN names USING (signal)),
reach AS (SELECT l.calibration_item_id, l.role, l.pool_name, l.signal, max(m.lev) AS lev FROM long l JOIN marks m ON m.signal = l.signal AND l.value * l.sign >= m.threshold * m.sign GROUP BY ALL),
hist AS (SELECT a.signal AS sa, a.lev AS i, b.signal AS sb, b.lev AS j, count(*) FILTER (WHERE a.role = 'positive') AS tp, count(*) FILTER (WHERE a.role = 'negative') AS fp, count(*) FILTER (WHERE a.pool_name = 'main') AS main FROM reach a JOIN reach b USING (calibration_item_id) GROUP BY ALL),
cube AS (SELECT x.signal AS sa, x.threshold AS ta, x.lev AS i, y.signal AS sb, y.threshold AS tb, y.lev AS j, coalesce(h.tp, 0) AS tp, coalesce(h.fp, 0) AS fp, coalesce(h.main, 0) AS main FROM marks x JOIN marks y ON x.place < y.place LEFT JOIN hist h ON h.sa = x.signal AND h.i = x.lev AND h.sb = y.signal AND h.j = y.lev),
rowsum AS (SELECT sa, ta, i, sb, tb, j, sum(tp) OVER w AS tp, sum(fp) OVER w AS fp, sum(main) OVER w AS main FROM cube WINDOW w AS (PARTITION BY sa, sb, i ORDER BY j DESC)),
joint AS (SELECT sa, ta, sb, tb, sum(tp) OVER w AS tp, sum(fp) OVER w AS fp, sum(main) OVER w AS main FROM rowsum WINDOW w AS (PARTITION BY sa, sb, j ORDER BY i DESC)),
ruled AS (SELECT sa AS left_signal, ta AS left_threshold, sb AS right_signal, tb AS right_threshold, (e.true_positives + q.true_positives - tp)::BIGINT AS true_positives, (e.false_positives + q.false_positives - fp)::BIGINT AS false_positives, (e.main_triggered + q.main_triggered - main)::BIGINT AS main_triggered
  FROM joint JOIN ev e ON e.signal = sa AND e.threshold = ta JOIN ev q ON q.signal = sb AND q.threshold = tb),
placed AS (SELECT *, true_positives / p AS recall FROM ruled, tot), firsts AS (SELECT *, row_number() OVER (PARTITION BY left_signal, right_signal ORDER BY CASE WHEN abs(recall - 1) <= 1e-9 THEN 0 ELSE 1 END, CASE WHEN abs(recall - 1) <= 1e-9 THEN main_triggered ELSE -recall END, false_positives, left_threshold, right_threshold) AS r FROM placed)
SELECT left_signal, left_threshold, right_signal, right_threshold, true_positives, false_positives, main_triggered FROM firsts WHERE r = 1""")
def pair_search(spark, sf_dir):
    """The best of all rules of each pair of signals."""
    found = R.best_pairs(written_rows(spark, sf_dir))
    return found.select("left_signal", "left_threshold", "right_signal", "right_threshold", "true_positives", "false_positives", "main_triggered")


@query(ROWS + "SELECT role, count(*) AS n, count(*) FILTER (WHERE pool_name = 'main') AS in_main FROM rows WHERE role IS NOT NULL GROUP BY role")
def review_roles(spark, sf_dir):
    return rows(spark, sf_dir).where("role is not null").groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.col("pool_name") == "main").alias("in_main"))


@query(ROWS + "SELECT signal, role, coalesce(min(value), 0.0) AS min, coalesce(round(quantile_cont(value, 0.5), 6), 0.0) AS median, coalesce(max(value), 0.0) AS max FROM long WHERE role IS NOT NULL GROUP BY signal, role")
def signal_distribution(spark, sf_dir):
    return R.signal_distribution(rows(spark, sf_dir))
