"""Routing rules over quality signals: thresholds, pairs of thresholds, their evaluation and the search for the best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.functions import text as T
from sieveline.operators.ranking import running
from sieveline.sources.staging import Stages

# fixed values: the routing signals and the comparison that each allows
SIGNALS = {"replacement_char_rate": ">=", "private_use_char_rate": ">=", "control_char_rate": ">=", "printable_char_ratio": "<=", "suspicious_char_rate": ">="}
BUDGET = 0.15


def rule_text(signal: str, op: str, threshold: float) -> str:
    """A rule in words, with the threshold so that it reads back as the same number."""
    return f"{signal} {op} {threshold:.17g}"


def threshold_rule(signal: str, op: str, threshold: float) -> Column:
    """Whether a row's signal reaches the threshold; a null signal never does."""
    if SIGNALS.get(signal) != op:
        raise ValueError(f"{signal} does not allow {op}")
    if threshold != threshold or threshold in (float("inf"), float("-inf")):
        raise ValueError("a threshold must be finite")
    value = F.col(signal)
    return F.coalesce(value >= threshold if op == ">=" else value <= threshold, F.lit(False))


def or_rule(left: tuple[str, str, float], right: tuple[str, str, float]) -> Column:
    if left[0] == right[0]:
        raise ValueError("the two signals must differ")
    return threshold_rule(*left) | threshold_rule(*right)


def unpivoted(rows: DataFrame) -> DataFrame:
    """One row for each row and signal: calibration_item_id, pool_name, role, signal, value."""
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("signal"), F.col(s).cast("double").alias("value")) for s in SIGNALS)))
    return rows.select("calibration_item_id", "pool_name", "role", each.alias("s")).select("calibration_item_id", "pool_name", "role", "s.signal", "s.value")


def threshold_grid(rows: DataFrame) -> DataFrame:
    """The distinct values of each signal over the reviewed rows."""
    return unpivoted(rows.where("role is not null")).where("value is not null").select("signal", F.col("value").alias("threshold")).distinct()


def _passes() -> Column:
    return F.when(F.col("signal") == "printable_char_ratio", F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold"))


def _evaluated(hits: DataFrame, key: list[str], rows: DataFrame) -> DataFrame:
    """Counts of the rows that each rule triggers on, with the rates of the whole review."""
    totals = rows.agg(F.count_if(F.col("role") == "positive").alias("positives"), F.count_if(F.col("role") == "negative").alias("negatives"), F.count_if(F.col("pool_name") == "main").alias("mains"))
    counts = hits.groupBy(*key).agg(F.sum("tp").alias("true_positives"), F.sum("fp").alias("false_positives"), F.sum("main").alias("main_triggered"))
    rates = counts.crossJoin(F.broadcast(totals))
    return rates.select(*key, "true_positives", "false_positives", "main_triggered", T.safe_ratio(F.col("true_positives"), F.col("positives")).alias("recall"), T.safe_ratio(F.col("main_triggered"), F.col("mains")).alias("main_rate"))


def _flags() -> list[Column]:
    return [F.when(c, 1).otherwise(0).alias(n) for n, c in (("tp", F.col("role") == "positive"), ("fp", F.col("role") == "negative"), ("main", F.col("pool_name") == "main"))]


def rule_search(rows: DataFrame, grid: DataFrame | None = None) -> DataFrame:
    """Every single-threshold rule with its counts.

    Rows are counted by signal and value first; a running sum along the values then gives every threshold's counts,
    so no rule is compared with all rows.
    """
    grid = threshold_grid(rows) if grid is None else grid
    values = unpivoted(rows).where("value is not null").select("signal", "value", *_flags())
    at = values.groupBy("signal", "value").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("main").alias("main"))
    marks = grid.select("signal", F.col("threshold").alias("value"), F.lit(0).alias("tp"), F.lit(0).alias("fp"), F.lit(0).alias("main"), F.lit(True).alias("is_rule"))
    both = at.withColumn("is_rule", F.lit(False)).unionByName(marks)
    up = F.when(F.col("signal") == "printable_char_ratio", F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("signal").orderBy("up").rangeBetween(Window.unboundedPreceding, 0)
    run = both.withColumn("up", up).select("signal", "value", "is_rule", *(F.sum(c).over(w).alias(c) for c in ("tp", "fp", "main"))).where("is_rule")
    return _evaluated(run, ["signal", "value"], rows).withColumnRenamed("value", "threshold")


#: thresholds of a signal that pairs are made of, at most: the rules are as many as pairs of thresholds
MOST_THRESHOLDS = 2000


def pair_search(rows: DataFrame, grid: DataFrame | None = None, most: int = MOST_THRESHOLDS) -> DataFrame:
    """Every pair of thresholds of two signals, triggering if either does. More than `most` thresholds of a signal are
    an error when the rows are computed: the result has a row for each pair. `best_pairs` has no such limit.

    No rule meets a row. A row's level in a signal is the number of thresholds that it reaches; rows are counted by
    their levels in two signals, and sums along both sides give the rows that reach both thresholds of a pair. Those
    that reach either are the ones of the two single rules less these.
    """
    grid = threshold_grid(rows) if grid is None else grid
    names = list(SIGNALS)
    strict = F.when(F.col("signal") == "printable_char_ratio", -F.col("threshold")).otherwise(F.col("threshold"))
    of = Window.partitionBy("signal")  # `most` thresholds
    checked = F.when(F.col("of") <= most, F.col("level")).otherwise(F.raise_error(F.concat(F.lit("too many thresholds of "), "signal")).cast("int"))
    marks = grid.withColumn("strict", strict).withColumn("of", F.count("*").over(of)).withColumn("level", F.row_number().over(of.orderBy("strict")))
    marks = marks.select("signal", "threshold", "strict", checked.alias("level"))
    # levels of the values: the number of thresholds up to a value, along its signal
    each = unpivoted(rows).where("value is not null").select("signal", "value").distinct()
    up = F.when(F.col("signal") == "printable_char_ratio", -F.col("value")).otherwise(F.col("value"))
    both = each.select("signal", "value", up.alias("strict"), F.lit(0).alias("mark")).union(marks.select("signal", F.lit(None).cast("double"), "strict", F.lit(1)))
    reached = F.sum("mark").over(of.orderBy("strict").rangeBetween(Window.unboundedPreceding, 0))
    levels = both.withColumn("level", reached).where("value is not null").select("signal", "value", "level")
    combos = rows.select(*names, *_flags()).groupBy(*names).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("main").alias("main"))
    for s in names:
        own = levels.where(F.col("signal") == s).select(F.col("value").alias(s), F.col("level").alias(f"{s}_level"))
        combos = combos.withColumn(s, F.col(s).cast("double")).join(own, s, "left").withColumn(f"{s}_level", F.coalesce(f"{s}_level", F.lit(0)))
    sides = [F.struct(F.lit(a).alias("left_signal"), F.col(f"{a}_level").alias("i"), F.lit(b).alias("right_signal"), F.col(f"{b}_level").alias("j")) for k, a in enumerate(names) for b in names[k + 1 :]]
    sums = [F.sum(c).alias(c) for c in ("tp", "fp", "main")]
    counted = combos.select(F.explode(F.array(*sides)).alias("x"), "tp", "fp", "main").groupBy("x.left_signal", "x.i", "x.right_signal", "x.j").agg(*sums)
    # the rules, with the zero levels that rows of neither threshold have
    level = lambda side, n: marks.select(F.col("signal").alias(f"{side}_signal"), F.col("threshold").alias(f"{side}_threshold"), F.col("level").alias(n)).union(marks.select("signal", F.lit(None).cast("double"), F.lit(0)).distinct())
    place = lambda c: F.array_position(F.array(*map(F.lit, names)), F.col(c))
    pair = level("left", "i").withColumn("left_place", place("left_signal")).join(level("right", "j").withColumn("right_place", place("right_signal")), F.col("left_place") < F.col("right_place"))
    cube = pair.join(counted, ["left_signal", "i", "right_signal", "j"], "left").na.fill(0, ["tp", "fp", "main"])
    key = ["left_signal", "right_signal"]
    along = lambda c, fixed, by: F.sum(c).over(Window.partitionBy(*key, fixed).orderBy(F.desc(by)))
    for fixed, by in (("i", "j"), ("j", "i")):
        cube = cube.withColumns({c: along(c, fixed, by) for c in ("tp", "fp", "main")})
    # reaching level 0 of a signal is no condition: there the sums are those of one rule
    single = lambda fixed: Window.partitionBy(*key, fixed)
    either = {c: F.max(F.when(F.col("j") == 0, F.col(c))).over(single("i")) + F.max(F.when(F.col("i") == 0, F.col(c))).over(single("j")) - F.col(c) for c in ("tp", "fp", "main")}
    hits = cube.select(*key, "left_threshold", "right_threshold", "i", "j", *(v.alias(c) for c, v in either.items())).where("i > 0 and j > 0")
    return _evaluated(hits, ["left_signal", "left_threshold", "right_signal", "right_threshold"], rows)


def best(rules: DataFrame, key: list[str], by: list[str] | None = None) -> DataFrame:
    """The best rule (of each `by`): full recall and fewest main triggers, else highest recall; then fewest false
    positives, then the rule itself."""
    full = F.abs(F.col("recall") - 1) <= 1e-9
    order = [F.when(full, 0).otherwise(1), F.when(full, F.col("main_triggered").cast("double")).otherwise(-F.col("recall")), F.col("false_positives"), *map(F.col, key)]
    if by:
        return rules.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("place = 1").drop("place")
    return rules.orderBy(*order).limit(1)


def best_pairs(rows: DataFrame) -> DataFrame:
    """The best rule of each pair of signals, as `best` finds it among all of `pair_search`, without listing the pairs.

    Thresholds are signed so that a row reaches those up to its value. Both orders of `best` ask for the highest recall
    first, so only pairs that trigger on every positive row with a value count (full recall is every positive row: the
    tolerance leaves out none of fewer than 10^9). For a left threshold a, these are the right ones up to B(a), the
    smallest right value of the positive rows below a. B falls as a rises, and a higher b never triggers on more rows,
    so B(a) is the best for a. A row (x, y) escapes (a, B(a)) just if x < a <= A(y), A(y) being the smallest left value
    of the positive rows with a right value up to y: running sums over the ends of these stretches give the escaped rows
    of every a. Of ties, the smallest left threshold is taken, then the smallest right one that lets the same rows escape.
    """
    names, pair, counts = list(SIGNALS), ["left_signal", "right_signal"], ["tp", "fp", "main", "seen"]
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    signed = lambda of, c: F.when(of == "printable_char_ratio", 0.0 - F.col(c)).otherwise(F.col(c))
    stages = Stages(rows.sparkSession, "best_pairs")
    own = rows.select(*(signed(F.lit(s), s).cast("double").alias(s) for s in names), *_flags(), F.when(F.col("role").isNotNull(), 1).otherwise(0).alias("seen"))
    combos = stages.write(own.groupBy(*names).agg(*(F.sum(c).alias(c) for c in counts)), "combos")
    sides = [F.struct(F.lit(a).alias("left_signal"), F.lit(b).alias("right_signal"), F.col(a).alias("x"), F.col(b).alias("y")) for k, a in enumerate(names) for b in names[k + 1 :]]
    points = combos.select(F.explode(F.array(*sides)).alias("p"), *counts).select("p.*", *counts)
    # no value lies below all thresholds
    points = points.withColumn("at_x", F.coalesce("x", low)).withColumn("at_y", F.coalesce("y", low))
    asked = (F.col("tp") > 0) & (F.col("x").isNotNull() | F.col("y").isNotNull())
    # one row a pair: the last right threshold, the last left one that every row without a right value allows
    limits = points.groupBy(*pair).agg(
        F.max(F.when(F.col("seen") > 0, F.col("y"))).alias("most"), F.min(F.when(asked & F.col("y").isNull(), F.col("x"))).alias("last"),
        (F.abs(T.safe_ratio(F.sum(F.when(asked, F.col("tp"))), F.sum("tp")) - 1) <= 1e-9).alias("full"),
    ).where("most is not null")
    limits = stages.write(limits, "limits")
    until = running(points.groupBy(*pair, "at_y").agg(F.min(F.when(asked, F.col("at_x"))).alias("until")), pair, "at_y", mins=["until"])
    each = points.join(until.select(*pair, "at_y", F.coalesce("until_upto", high).alias("until")), [*pair, "at_y"]).join(F.broadcast(limits), pair)
    escapes = F.when(F.col("at_y") < F.col("most"), 1).otherwise(0)
    step = lambda at, by, rule: F.struct(at.alias("a"), (by * escapes * F.col("fp")).alias("fp"), (by * escapes * F.col("main")).alias("main"), rule.alias("is_rule"))
    steps = F.array(step(F.col("at_x"), 1, F.col("x").isNotNull() & (F.col("seen") > 0)), step(F.greatest("at_x", "until"), -1, F.lit(False)))
    ends = each.select(*pair, F.explode(steps).alias("s")).groupBy(*pair, "s.a").agg(F.sum("s.fp").alias("fp"), F.sum("s.main").alias("main"), F.max("s.is_rule").alias("is_rule"))
    lefts = running(ends, pair, "a", sums=["fp", "main"]).where("is_rule").join(F.broadcast(limits), pair).where("last is null or a <= last")
    escaped = lambda c: F.col(f"{c}_upto") - F.col(c)  # noqa: E731  # those of rows below a
    order = F.struct(F.when(F.col("full"), -escaped("main")).otherwise(0).alias("main"), (-escaped("fp")).alias("fp"), signed(F.col("left_signal"), "a").alias("left_threshold"), F.col("a"))
    chosen = lefts.groupBy(*pair, "most", "full").agg(F.min(order).alias("o")).select(*pair, "most", "full", "o.left_threshold", "o.a")
    chosen = stages.write(chosen, "lefts")
    below = points.join(F.broadcast(chosen), pair).where("at_x < a")
    top = chosen.join(below.where(asked).groupBy(*pair).agg(F.min("y").alias("b")), pair, "left").withColumn("b", F.least("b", "most"))
    top = stages.write(top, "tops")
    told = (F.col("fp") > 0) | (F.col("full") & (F.col("main") > 0))
    floors = points.join(F.broadcast(top), pair).where((F.col("at_x") < F.col("a")) & (F.col("at_y") < F.col("b")) & told).groupBy(*pair).agg(F.max("at_y").alias("floor"))
    above = points.where("seen > 0").join(F.broadcast(floors), pair, "left").where("y > coalesce(floor, double('-inf'))").groupBy(*pair).agg(F.min("y").alias("least"))
    right = F.when(F.col("right_signal") == "printable_char_ratio", F.col("b")).otherwise(F.col("least"))
    rules = top.join(above, pair).withColumn("b", right).select(*pair, "left_threshold", signed(F.col("right_signal"), "b").alias("right_threshold"), "a", "b")
    hits = points.join(F.broadcast(stages.write(rules, "rules")), pair).where("x >= a or y >= b")
    return _evaluated(hits, ["left_signal", "left_threshold", "right_signal", "right_threshold"], rows)


def strategy(best_single: DataFrame) -> DataFrame:
    ok = (F.abs(F.col("recall") - 1) <= 1e-9) & (F.col("main_rate") <= BUDGET)
    return best_single.withColumn("strategy", F.when(ok, "automatic_pre_annotation_ocr").otherwise("annotation_side_retry"))


def evaluate_trigger(rows: DataFrame, rule: Column) -> DataFrame:
    hits = rows.where(rule).select(F.lit(1).alias("rule"), *_flags())
    none = rows.sparkSession.range(1).select(F.lit(1).alias("rule"), *(F.lit(0).alias(c) for c in ("tp", "fp", "main")))
    return _evaluated(hits.union(none), ["rule"], rows).drop("rule")


def signal_distribution(rows: DataFrame) -> DataFrame:
    """min, median and max of each signal by review role, 0 where there is no value."""
    at = lambda c: F.coalesce(c, F.lit(0.0))
    reviewed = unpivoted(rows.where("role is not null"))
    return reviewed.groupBy("signal", "role").agg(at(F.min("value")).alias("min"), at(F.round(F.percentile("value", 0.5), 6)).alias("median"), at(F.max("value")).alias("max"))
