"""Evaluation scores and audits that the design documents of the domain specify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.functions import text as T


def choice_scores(answer: Column, key: Column) -> dict[str, Column]:
    """Exact set match, and precision, recall and F1 of two option sets."""
    a, k = F.array_distinct(answer), F.array_distinct(key)
    hit = F.size(F.array_intersect(a, k))
    return {"exact": (F.array_sort(a) == F.array_sort(k)).cast("int"), "precision": T.safe_ratio(hit, F.size(a)), "recall": T.safe_ratio(hit, F.size(k)), "f1": T.safe_ratio(2 * hit, F.size(a) + F.size(k))}


def as_boolean(text: Column) -> Column:
    word = F.lower(T.stripped(text))
    return F.when(word.isin("true", "yes", "y", "1", "t"), True).when(word.isin("false", "no", "n", "0", "f"), False)


def within_tolerance(value: Column, key: Column, absolute: Column, relative: Column) -> Column:
    """|value - key| against the larger of both tolerances; one that is missing does not count; none: equality."""
    allowed = F.greatest(absolute, relative * F.abs(key))
    return F.abs(value - key) <= F.coalesce(allowed, F.lit(0.0))


def structured_score(fields: Column) -> Column:
    """Mean of the fields' scores; null if one is unresolved or there is none."""
    return F.when((F.size(fields) > 0) & F.forall(fields, lambda f: f.isNotNull()), F.aggregate(fields, F.lit(0.0), lambda a, f: a + f) / F.size(fields))


def item_score(score: Column, status: Column) -> Column:
    """The score of an answered item, 0 for one that was refused or cannot be parsed, null for one that was not run."""
    return F.when(status == "scored", score).when(status.isin("refused", "unparsed"), 0.0)


def short_answer(answer: Column, key: Column, aliases: Column, pattern: Column) -> Column:
    """The first stage that accepts an answer: exact, normalised, alias or pattern; null if none does."""
    norm = lambda c: F.lower(T.stripped(F.regexp_replace(c, rf"{T.SPACE}+", " ")))
    return (
        F.when(answer == key, "exact")
        .when(norm(answer) == norm(key), "normalised")
        .when(F.exists(aliases, lambda a: norm(a) == norm(answer)), "alias")
        .when(F.coalesce(F.regexp(answer, pattern), F.lit(False)), "pattern")
    )


def track_means(items: DataFrame) -> DataFrame:
    """Mean and count by track, and overall as the mean of the tracks' means (null if a track has none)."""
    tracks = items.groupBy("track").agg(F.avg("score").alias("score"), F.count("score").alias("item_count"))
    overall = tracks.agg(F.lit("overall").alias("track"), F.when(F.count("score") == F.count("*"), F.avg("score")).alias("score"), F.sum("item_count").alias("item_count"))
    return tracks.union(overall)


def slices(items: DataFrame, first: str, second: str) -> DataFrame:
    sets = items.groupingSets([[first], [second], [first, second]], first, second)
    return sets.agg(F.avg("score").alias("score"), F.count("score").alias("item_count"))


def poisson_steps() -> list[float]:
    """Upper ends of the values 0, 1, ... of a Poisson variate of mean 1, up to the last one that 32 bits can tell."""
    out, p, total, k = [], 0.36787944117144233, 0.0, 0
    while 1 - total > 2**-32:
        total += p
        out.append(total)
        k += 1
        p /= k
    return out


def bootstrap(items: DataFrame, draws: int = 200, seed: int = 7) -> DataFrame:
    """track, low and high: 95 % interval of the mean by Poisson resampling.

    Every item counts in each draw as often as a Poisson variate of mean 1 says, which follows from 32 bits of an MD5 of
    item, seed and draw: a digest serves four draws. The digests' rows are summed where they are made; what is shuffled
    is a row for each track, task and four draws.
    """
    block = F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // 4))).alias("block")
    each = items.where("score is not null").select("track", "score", "item_id", block)
    each = each.select("track", "score", "block", F.md5(F.concat_ws("-", "item_id", F.lit(seed), "block")).alias("digest"))

    uniform = each.select("track", "score", "block", *((F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("double") / float(1 << 32)).alias(f"u{k}") for k in range(4)))
    counted = uniform.select("track", "score", "block", *(sum((F.when(F.col(f"u{k}") >= e, 1).otherwise(0) for e in poisson_steps()), F.lit(0)).alias(f"t{k}") for k in range(4)))
    sums = counted.groupBy("track", "block").agg(*(F.try_divide(F.sum(F.col("score") * F.col(f"t{k}")), F.sum(f"t{k}")).alias(f"m{k}") for k in range(4)))
    drawn = F.posexplode(F.array(*(F.col(f"m{k}") for k in range(4)))).alias("k", "mean")
    means = sums.select("track", "block", drawn).where(F.col("block") * 4 + F.col("k") < draws)
    return means.groupBy("track").agg(F.percentile("mean", 0.025).alias("low"), F.percentile("mean", 0.975).alias("high"))


def audit_sample(items: DataFrame, revision: str, share: float = 0.1) -> DataFrame:
    """The ceil(share) part of the items with the smallest hashes of id and revision.

    Hashes are counted by their first bits before any ranking, so only the cell that holds the cut is ordered.
    """
    h = F.sha2(F.concat(F.col("item_id").cast("string"), F.lit(revision)), 256)
    keyed = items.select("item_id", h.alias("h")).withColumn("cell", F.substring("h", 1, 4))
    cells = keyed.groupBy("cell").agg(F.count("*").alias("n"))
    w = Window.orderBy("cell")
    upto = cells.select("cell", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    ranked = keyed.join(F.broadcast(upto), "cell")  # 65,536 cells at most
    place = F.col("before") + F.row_number().over(Window.partitionBy("cell").orderBy("h", "item_id"))
    return ranked.withColumn("place", place).where(F.col("place") <= F.ceil(F.col("total") * share)).select("item_id", "place")


def group_matrix(items: DataFrame, group: str, domain: str, domains: list[str]) -> DataFrame:
    return items.groupBy(group).pivot(domain, domains).agg(F.count(F.lit(1))).na.fill(0)


def exclusions(items: DataFrame, rules: list[tuple[Column, str]]) -> DataFrame:
    """item_id and the first reason that excludes it, for items that a reason excludes."""
    reason = F.coalesce(*(F.when(c, r) for c, r in rules))
    return items.withColumn("reason", reason).where("reason is not null").select("item_id", "reason")


def difficulty(results: DataFrame) -> DataFrame:
    """By item: mean score over models, discrimination (score of the better half less that of the other), ceiling, floor."""
    strength = results.groupBy("model").agg(F.avg("score").alias("strength"))
    half = strength.withColumn("half", F.ntile(2).over(Window.orderBy(F.desc("strength"), "model"))).select("model", "half")  # one row a model
    joined = results.join(F.broadcast(half), "model")
    return joined.groupBy("item_id").agg(
        F.avg("score").alias("difficulty"), (F.avg(F.when(F.col("half") == 1, F.col("score"))) - F.avg(F.when(F.col("half") == 2, F.col("score")))).alias("discrimination"),
        (F.min("score") >= 1).alias("ceiling"), (F.max("score") <= 0).alias("floor"),
    )
