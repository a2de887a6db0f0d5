"""Document fingerprints (operator 9): threshold-scaled sketches of word shingles. Native only.

A sketch holds every distinct shingle hash below a fixed fraction of the hash range. The threshold is the same for
all documents, so sketches of any two texts can be compared however unequal their lengths are, and the sketch of a
union is the union of the sketches: `merge` is an aggregation like any other. `jaccard` and `containment` estimate
the resemblance of the shingle sets and the share of one set that the other holds.

An estimate from n shingles of the union has a standard error of sqrt(J (1 - J) / (FRACTION n)): 0.03 for 1000 shingles
and J = 0.5, 0.1 for 100. Short texts keep few hashes: one of a single shingle has an empty sketch three times in four,
one of eight words once in three, one of twenty words once in a hundred. Two such texts count as alike only if they are
equal. A larger fraction sharpens that, at the cost of sketches as large as the texts.

Defined cases: null counts as empty; a text of fewer words than a shingle is one shingle, one without words has an
empty sketch; two empty sketches are alike (1.0) if their texts are equal and unlike (0.0) if not; other columns are
not read. In `edited_documents`, documents stand in descending order of doc_id, those of one doc_id by a hash of the
text, a null doc_id last; each row has one successor, the last row has the first, a single row has itself; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.llm.common import pick

WORDS = 5
FRACTION = 0.25
#: cells of the doc_id order: their bounds and first ids are all that the driver holds
MOST_CELLS = 1 << 16
_LOWEST = -(1 << 63)


def _bind(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def sketch(text: Column, words: int = WORDS, fraction: float = FRACTION) -> Column:
    """Sorted distinct shingle hashes (as longs) below the fraction (at most a half) of the unsigned hash range."""
    below = F.lit(int(fraction * 2**64) - 1)
    own = F.filter(F.split(F.lower(text), r"[\x09-\x0D\x20]+"), lambda w: w != "")
    hashed = F.transform(own, lambda w: F.xxhash64(w))

    def kept(h: Column) -> Column:
        ends = F.sequence(F.lit(0), F.size(h) - words)
        long = F.transform(ends, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(words))))
        short = F.array(F.xxhash64(h))
        shingles = F.when(F.size(h) >= words, long).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))
        return F.sort_array(F.array_distinct(F.filter(shingles, lambda x: x.between(F.lit(0), below))))

    return _bind(hashed, kept)


def fingerprint(hashes: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits a hash, in order."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def jaccard(a: Column, b: Column, equal: Column) -> Column:
    """Estimated resemblance; `equal` tells whether the texts are equal, for two empty sketches."""

    def of(both: Column) -> Column:
        union = F.size(a) + F.size(b) - both
        return F.when(union > 0, both / union).otherwise(F.when(equal, 1.0).otherwise(0.0))

    return _bind(F.size(F.array_intersect(a, b)), of)


def containment(a: Column, b: Column, equal: Column) -> Column:
    """Estimated share of a's shingles that b holds."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.when(equal, 1.0).otherwise(0.0))


def merge(df: DataFrame, key: str, hashes: str) -> DataFrame:
    """The sketch of each group's texts together."""
    each = df.select(key, F.explode(hashes).alias("h")).distinct()
    return each.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(hashes))


# ---------------------------------------------------------------- each document and the next


def _longs(values: list[int]) -> Column:
    """A constant array: folded to one literal, however many values it has."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def _cell(key: Column, bounds: list[int]) -> Column:
    """The number of bounds below the key, found in two steps of about the square root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    heads, all_bounds = _longs(bounds[::step]), _longs(bounds)
    below = lambda xs: F.size(F.filter(xs, lambda b: b < key))

    def inside(block: Column) -> Column:
        first = F.greatest(block - 1, F.lit(0)) * step
        return first + below(F.slice(all_bounds, first + 1, step))

    return _bind(below(heads), inside)


def _share(key: Column, hashed: Column, heavy: dict[int, int]) -> Column:
    """For a key that fills several cells, which of them a text's hash falls into; a last one for the lower keys."""
    last = F.lit(1 << 31).cast("long")
    if not heavy:
        return last
    own = F.map_from_arrays(_longs(list(heavy)), _longs(list(heavy.values())))
    # the upper 31 bits of the hash in its signed order
    place = F.shiftrightunsigned(hashed.bitwiseXOR(F.lit(_LOWEST)), 33)
    return F.coalesce(F.shiftright(place * F.try_element_at(own, key), 31), last)


def edited_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text and edited for every row, with the text's sketch and the next text's.

    In `edited`, the last half of the text's characters (rounded down) is replaced by as many of the next text's
    first. Rows are dealt into cells of the order and meet their successor there; the first rows of a cell are also
    dealt to the cell before it, so that no sort of the whole table is needed. A doc_id (or null) that many rows have
    fills several cells, dealt by the hash of the text; only rows equal in both are in one cell whatever their number.
    """
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(_LOWEST))
    cells = min(MOST_CELLS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.percentile_approx(key, [k / cells for k in range(1, cells)], 16 * cells)).first()[0]
    times = Counter(cuts or [])
    bounds, heavy = sorted(times), {k: n for k, n in times.items() if n > 1}
    hashed = F.xxhash64("text")
    cell = F.struct((-_cell(F.col("key"), bounds)).alias("down"), _share(F.col("key"), F.col("h"), heavy).alias("part"))
    numbered = rows.withColumn("key", key).withColumn("h", hashed).withColumn("cell", cell)
    # each cell's first row also stands at the end of the cell before it; before the very first cell comes the last
    order = Window.orderBy("cell")  # over MOST_CELLS rows at most
    firsts = numbered.groupBy("cell").agg(F.max(F.struct("key", F.bitwise_not("h").alias("h"))).alias("head"))
    before = F.coalesce(F.lag("cell").over(order), F.max("cell").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    copies = F.broadcast(firsts.select(F.col("head.key").alias("head"), F.bitwise_not("head.h").alias("head_h"), before.alias("before")))
    own = F.struct(F.col("cell"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("cell"), F.lit(True).alias("guest"))
    placed = numbered.join(copies, (numbered.key == copies["head"]) & (numbered.h == copies["head_h"]), "left")
    dealt = placed.select("doc_id", "text", "key", "h", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("at"))
    dealt = dealt.select("doc_id", "text", "key", "h", "at.cell", "at.guest").repartition("cell").withColumn("sketch", sketch(F.col("text")))
    within = Window.partitionBy("cell").orderBy("guest", F.desc("key"), "h", "text")
    pairs = dealt.withColumn("next", F.lead(F.struct("text", "sketch")).over(within)).where(~F.col("guest"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next.text"), F.lit(1), half))
    return pairs.select("doc_id", "text", "sketch", F.col("next.text").alias("next_text"), F.col("next.sketch").alias("next_sketch"), edited.alias("edited"))


def compared(docs: DataFrame) -> DataFrame:
    """edited_documents with the edited text's sketch."""
    return edited_documents(docs).withColumn("edited_sketch", sketch(F.col("edited")))
