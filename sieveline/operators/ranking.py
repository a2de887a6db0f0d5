"""Deterministic ranking, quotas and evenly spaced selection within groups, and ranked values.

Nothing here sorts a group that may hold most rows in one task: such a group is range-partitioned by its order, ranked
within the ranges, and the ranges' sizes are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.sources.staging import Stages

#: rows of a group that one task may sort
GROUP_ROWS = 1_000_000


def ranked(df: DataFrame, group: list[str], order: list[str], most: int | None = None) -> DataFrame:
    """With idx (from 0) and n (rows of the group); a group of more than `most` rows is ranked in ranges."""
    most = GROUP_ROWS if most is None else most
    largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    w = Window.partitionBy(*group)
    if largest <= most:
        return df.withColumn("idx", F.row_number().over(w.orderBy(*order)) - 1).withColumn("n", F.count("*").over(w))
    return ranked_by_range(df, group, order)


def ranked_by_range(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """`ranked` without a task for each group: rows are written in ranges of (group, order), numbered there, and moved
    by the rows of the group in earlier ranges."""
    stages = Stages(df.sparkSession, "ranked")
    ranges = df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in (*group, *order))).withColumn("_range", F.spark_partition_id())
    ranges = stages.write(ranges, "ranges")  # the bounds come from a sample: they are drawn once
    sizes = ranges.groupBy(*group, "_range").agg(F.count("*").alias("_rows"))
    w = Window.partitionBy(*group)  # ranges of a group: not more than partitions
    sizes = sizes.withColumn("_before", F.sum("_rows").over(w.orderBy("_range")) - F.col("_rows")).withColumn("n", F.sum("_rows").over(w))
    named = [F.col(c).alias(f"_g{k}") for k, c in enumerate(group)]
    sizes = sizes.select(*named, F.col("_range").alias("_of"), "_before", "n")
    same = F.col("_range") == F.col("_of")
    for k, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{k}"))
    own = F.row_number().over(Window.partitionBy(*group, "_range").orderBy(*order)) - 1
    out = ranges.withColumn("_own", own).join(sizes, same)
    return out.select(*df.columns, (F.col("_before") + F.col("_own")).cast("int").alias("idx"), "n")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """With the place (from 0) of each row in the order of all rows, by ranges as above."""
    stages = Stages(df.sparkSession, "numbered")
    at = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    rows = stages.write(rows, "ranges")
    sizes = rows.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count("*").alias("_rows"))
    before = sizes.select("_range", (F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")).alias("_before"))
    out = rows.withColumn("_range", F.shiftright("_at", 33)).join(F.broadcast(before), "_range")  # a row a partition
    return out.select(*df.columns, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def value_ranks(df: DataFrame, column: str, group: list[str] | None = None) -> DataFrame:
    """v, upto and total by group: of the distinct values of a number, how many rows have one up to it, and the rows.

    Equal values are counted first. The values are then dealt into cells that keep their order (by their logarithm),
    the cells' sizes are added up, and values are ranked within their cell.
    """
    group = group or []
    counts = df.where(F.col(column).isNotNull()).groupBy(*group, F.col(column).alias("v")).agg(F.count("*").alias("c"))
    cell = F.signum("v") * F.floor(F.log2(F.abs(F.col("v").cast("double")) + 1) * 256)
    counts = counts.withColumn("cell", cell.cast("int"))
    w = Window.partitionBy(*group)  # some ten thousand cells at most
    cells = counts.groupBy(*group, "cell").agg(F.sum("c").alias("n"))
    cells = cells.withColumn("before", F.sum("n").over(w.orderBy("cell")) - F.col("n")).withColumn("total", F.sum("n").over(w)).drop("n")
    inside = F.sum("c").over(Window.partitionBy(*group, "cell").orderBy("v"))
    return counts.withColumn("inside", inside).join(cells, [*group, "cell"]).select(*group, "v", (F.col("before") + F.col("inside")).alias("upto"), "total")


def running(df: DataFrame, group: list[str], by: str, sums: list[str] | None = None, mins: list[str] | None = None) -> DataFrame:
    """With {column}_upto: sums or minima over the rows of a group up to a row's value of `by`, by ranges as above."""
    stages = Stages(df.sparkSession, "running")
    ranges = df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in (*group, by))).withColumn("_range", F.spark_partition_id())
    ranges = stages.write(ranges, "ranges")
    kinds = dict.fromkeys(sums or [], F.sum) | dict.fromkeys(mins or [], F.min)
    totals = ranges.groupBy(*group, "_range").agg(*(f(c).alias(c) for c, f in kinds.items()))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # ranges of a group
    before = totals.select(*group, "_range", *(f(c).over(earlier).alias(f"_before_{c}") for c, f in kinds.items()))
    inside = Window.partitionBy(*group, "_range").orderBy(by).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranges.withColumns({f"{c}_upto": f(c).over(inside) for c, f in kinds.items()}).join(F.broadcast(before), [*group, "_range"])
    upto = {c: F.least(f"_before_{c}", f"{c}_upto") if f is F.min else F.coalesce(f"_before_{c}", F.lit(0)) + F.col(f"{c}_upto") for c, f in kinds.items()}
    return out.select(*df.columns, *(v.alias(f"{c}_upto") for c, v in upto.items()))


def at_place(place: Column) -> Column:
    """Of `value_ranks`: the value at a place (from 0)."""
    return F.min(F.when(F.col("upto") > place, F.col("v")))


def is_evenly_spaced(idx: str, n: str, k: str) -> Column:
    """Whether place idx of n is among k evenly spaced places, both ends included, in whole numbers.

    The i-th of them is (i (n - 1) + (k - 1) div 2) div (k - 1). Instead of listing them for each group, a row asks
    for the smallest i whose place is not before it, and is kept if that place is its own.
    """
    m, last = f"greatest({k} - 1, 1)", f"greatest({n} - 1, 1)"
    i = f"greatest(({idx} * {m} - {m} div 2 + {last} - 1) div {last}, 0)"
    return F.expr(f"case when {k} < 1 then false when {n} <= {k} then true when {k} = 1 then {idx} = 0 else {i} <= {m} and ({i} * {last} + {m} div 2) div {m} = {idx} end")


def evenly_spaced(df: DataFrame, group: list[str], order: list[str], k: int | str) -> DataFrame:
    """k evenly spaced rows of each group in the order; k is a number or a column that is constant in a group."""
    return ranked(df, group, order).where(is_evenly_spaced("idx", "n", str(k)))


def hamilton(df: DataFrame, key: list[str], capacity: str, target: Column) -> DataFrame:
    """Largest-remainder shares of a target: adds floor_share, remainder, capacity_total, award and share.

    For small frames, one row a group. Remainders have one denominator, so their numerators are compared; ties go to
    the smaller key. The target is at most the sum of the capacities.
    """
    every = Window.partitionBy()
    total = F.sum(capacity).over(every)
    goal = F.least(target.cast("long"), total)
    shares = df.withColumn("capacity_total", F.coalesce(total, F.lit(0)).cast("long")).withColumn("goal", F.coalesce(goal, F.lit(0)).cast("long"))
    product = F.col("goal") * F.col(capacity)
    some = F.col("capacity_total") > 0
    shares = shares.withColumn("floor_share", F.when(some, F.expr(f"(goal * {capacity}) div capacity_total")).otherwise(F.lit(0)).cast("long"))
    shares = shares.withColumn("remainder", F.when(some, product % F.col("capacity_total")).otherwise(F.lit(0)).cast("long"))
    place = F.row_number().over(Window.orderBy(F.desc("remainder"), *key))
    left = F.col("goal") - F.sum("floor_share").over(every)
    shares = shares.withColumn("award", F.when(place <= left, 1).otherwise(0).cast("long"))
    return shares.withColumn("share", F.col("floor_share") + F.col("award")).drop("goal")


def quotas(counts: DataFrame, key: list[str], population: str, target: int, base: int) -> DataFrame:
    """Minimum coverage and proportional shares of what is left, for groups with rows.

    base_quota = min(base, population); the rest of the target goes by `hamilton` over the rest of the populations.
    A target below the sum of the base quotas is an error when the rows are computed.
    """
    every = Window.partitionBy()
    some = counts.where(F.col(population) > 0).withColumn("base_quota", F.least(F.lit(base), F.col(population)).cast("long"))
    some = some.withColumn("capacity", F.col(population) - F.col("base_quota"))
    goal = F.least(F.lit(target).cast("long"), F.sum(population).over(every)) - F.sum("base_quota").over(every)
    some = some.withColumn("extra", goal)
    checked = F.when(F.col("extra") >= 0, F.col("extra")).otherwise(F.raise_error(F.lit("target is smaller than the base quotas")).cast("long"))
    out = hamilton(some.withColumn("extra", checked), key, "capacity", F.col("extra"))
    return out.select(
        *key, F.col(population).cast("long").alias("population"), "base_quota", F.col("floor_share").alias("proportional_quota"),
        "remainder", "capacity_total", F.col("award").alias("largest_remainder_award"), (F.col("base_quota") + F.col("share")).alias("final_quota"),
    )


def quota_sample(df: DataFrame, key: list[str], order: list[str], target: int, base: int) -> DataFrame:
    """Evenly spaced rows of each group, as many as its quota; with idx, population and final_quota."""
    counts = df.groupBy(*key).agg(F.count("*").alias("rows_of_group"))
    shares = quotas(counts, key, "rows_of_group", target, base).select(*key, "population", "final_quota")
    # one row a group: the quotas are as small as the grouped frame
    return evenly_spaced(df.join(F.broadcast(shares), key), key, order, "final_quota")
