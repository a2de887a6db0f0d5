"""SimHash near-duplicate groups (operator 4): fingerprints, a binary-trie self-join, and components.

A text's fingerprint is the 64-bit SimHash of its word shingles. Fingerprints are dealt into blocks, and inside each
block a binary trie is joined with itself: pairs of nodes walk down together, and a pair is dropped once its differing
bits exceed the budget. Two ways of dealing:

  by bits    the bits are cut into `budget + 2` runs; two fingerprints within the budget agree on two whole runs at
             least, so they meet in one of the blocks keyed by a pair of runs, and every pair within the budget is found.
  by draws   for a wide budget, which bits can't deal: in each of `draws` random orders of the shingles, the `sample`
             smallest ones of a text are its key. Sets of Jaccard similarity J share a key with probability of about
             J ** sample in each draw, however long the texts are, so a text makes a few rows at any size of the corpus.

`without_near_duplicates` deals by draws and compares the sets of shingles of all candidates: what it links is decided
by the similarity, and a pair is lost only if no draw of ten brings it together (0.5 % at 0.8, less above).

A block or candidate group with more members than one task should hold is crowded. A few pivots of it meet all members,
cell by cell; what the pivots don't connect meets all members of the block. A large family of near copies so costs one
pass over it, and no pair is left out. A crowded block of bits whose rest is large is dealt again by its other bits.

Defined cases: a null text counts as empty; a text without words has fingerprint zero, linked like any other; rows
with the same doc_id are separate rows of the same component; a null doc_id is fingerprinted and grouped, and is
never a component's smallest id unless all ids of it are null; an empty table gives an empty result; other columns
are not read by `near_duplicates` and are kept as they are by `without_near_duplicates`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import Stages, pick

SEED = 42
BITS = 64
#: fingerprints that one block may hold before it is crowded
BLOCK_LIMIT = 1024
#: members of a crowded block that meet all others, about
PIVOTS = 8
#: times that a crowded block is dealt by further bits
LEVELS = 3
#: shingles, and texts, that one cell of a large candidate group may hold
CELL_SHINGLES, CELL_TEXTS = 1 << 20, 512
#: keys whose rows are joined by broadcast because each has over a 1/HOT_KEYS of all rows: there are no more than that
HOT_KEYS, HOT_ROWS = 50_000, 1000


@dataclass(frozen=True)
class Rule:
    """What links two texts: words of a shingle, the budget of differing bits, whether a shingle counts once however
    often a text repeats it (as it must for draws), and the draws and shingles of a draw if blocks are dealt by draws."""

    words: int = 4
    budget: int = 4
    once: bool = False
    draws: int = 0
    sample: int = 4


#: candidates for a similarity of 0.8 of the sets of five-word shingles: two such texts differ in 9.7 of 64 bits on
#: average (an angle of arccos(2 J / (1 + J)), as a share of half a turn), with three standard deviations more
SIMILAR = Rule(words=5, budget=18, once=True, draws=10)
SIMILARITY = 0.8


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of the shingles, repeats included, of ASCII-lower-cased words; of all words if they are fewer."""
    own = (text or "").encode("utf-8", "replace").lower().split()
    if not own:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(own) > words:
        starts, ends = starts[: 1 - words or None], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """A 64-bit SimHash: a bit is set if it is in over half the hashes."""
    total = np.zeros(64, dtype=np.int64)
    big = hashes.astype(">u8")
    for i in range(0, len(big), 1 << 15):
        total += np.unpackbits(big[i : i + (1 << 15)].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > len(big)).tobytes(), "big")


def code(text: str | None, rule: Rule) -> int:
    """The fingerprint of a text."""
    h = shingle_hashes(text, rule.words)
    return majority(np.unique(h) if rule.once else h) if len(h) else 0


def draw_keys(h: np.ndarray, rule: Rule) -> np.ndarray:
    """For each draw, a hash of the `sample` smallest of the distinct shingles in the draw's order."""
    out, step = [], max(1, (1 << 20) // max(1, len(h)))
    for at in range(0, rule.draws, step):
        seeds = np.arange(at + 1, min(at + step, rule.draws) + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        x = (h ^ seeds) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        if len(h) > rule.sample:
            x = np.partition(x, rule.sample - 1, axis=1)[:, : rule.sample]
        out.append(((x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)).sum(axis=1, dtype=np.uint64))
    return np.concatenate([np.zeros(0, dtype=np.uint64), *out])


def codes(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, h (a hash of the text), c (the fingerprint, as a signed long) of every row; and if shingles count once,
    w and s (size and hash of their set) and d (the keys of the draws)."""

    def work(batches):
        for batch in batches:
            prints, sets, keys = [], [], [np.zeros(0, dtype=np.uint64)]
            for t in batch.column(1):
                h = shingle_hashes(t.as_py(), rule.words)
                if rule.once:
                    h = np.unique(h)
                    sets.append((len(h), xxhash.xxh64_intdigest(h.tobytes(), SEED)))
                    keys.append(draw_keys(h, rule))
                prints.append(majority(h) if len(h) else 0)
            sets = sets or [(0, 0)] * len(prints)
            sets = np.array(sets, dtype=np.uint64).view(np.int64).reshape(-1, 2)
            d = pa.ListArray.from_arrays(np.arange(len(prints) + 1, dtype=np.int32) * rule.draws, pa.array(np.concatenate(keys).view(np.int64)))
            c = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), c, pa.array(sets[:, 0]), pa.array(sets[:, 1]), d], ["doc_id", "h", "c", "w", "s", "d"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("h"))
    return rows.mapInArrow(work, "doc_id long, h long, c long, w long, s long, d array<long>")


# ---------------------------------------------------------------- the trie join inside blocks


def trie_pairs(values: np.ndarray, bounds: np.ndarray, budget: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all pairs of a block whose values differ in at most `budget` bits.

    `values` (uint64) is sorted within each block; block k is values[bounds[k]:bounds[k + 1]]. A trie node is a run of
    values with a common prefix. The walk holds pairs of nodes of one depth with the bits that differ so far. It
    starts at every block's root paired with itself, replaces a pair by its children's pairs bit by bit, and drops a
    pair once its errors exceed the budget. Pairs of single leaves are settled at once by their remaining bits.
    """
    a0, a1 = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    keep = a1 - a0 > 1
    a0, a1 = a0[keep], a1[keep]
    b0, b1, err = a0.copy(), a1.copy(), np.zeros(len(a0), dtype=np.int8)
    left, right = [], []
    for depth in range(bits):
        if not len(a0):
            break
        ones = np.concatenate(([0], np.cumsum((values >> np.uint64(bits - 1 - depth)) & np.uint64(1)).astype(np.int64)))
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        parts = []
        for x0, x1, y0, y1, bit in ((a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)):
            e = err + bit
            ok = (x1 > x0) & (y1 > y0) & (e <= budget)
            if bit and x1 is a1:
                ok &= ~same  # a node paired with itself has its mixed children once
            ok &= ~((x0 == y0) & (x1 - x0 == 1))  # a value is no pair with itself
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], e[ok]))
        a0, a1, b0, b1, err = (np.concatenate(p) for p in zip(*parts, strict=True))
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            left.append(i[near])
            right.append(j[near])
            a0, a1, b0, b1, err = (x[~leaf] for x in (a0, a1, b0, b1, err))
    if len(a0):  # nodes at full depth: equal prints of different codes
        i, j = _products(a0, a1, b0, b1)
        left.append(i)
        right.append(j)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions reaches over the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _products(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that link all members of each pair of nodes: within a node or between nodes, enough to
    compare every member of the one with every member of the other."""
    rows, cols = a1 - a0, b1 - b0
    n = rows * cols
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(cols, n)
    i, j = np.repeat(a0, n) + k // wide, np.repeat(b0, n) + k % wide
    ok = (i < j) | (np.repeat(a0, n) != np.repeat(b0, n))
    return i[ok], j[ok]


def _blocks(batches, n_key: int, most: int = 1 << 16):
    """Rows of longs, sorted by their first `n_key` columns, as arrays of some 65,536 rows of whole blocks."""
    held, rows = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
        rows += len(held[-1])
        if rows >= most:
            own = np.concatenate(held)
            change = np.flatnonzero((own[1:, :n_key] != own[:-1, :n_key]).any(axis=1))
            end = int(change[-1]) + 1 if len(change) else 0
            if end:
                yield own[:end]
            held, rows = [own[end:]], len(own) - end
    if rows:
        yield np.concatenate(held)


def _trie_links(batches, rule: Rule, n_key: int, labels: bool = False):
    """From rows (key..., id, v) sorted by key, the links that span each block's groups: every member to the first.

    With `labels`, rows are (key..., rank, home, id, v), sorted by key and rank, and every row that is at home or
    linked comes out as (key..., id, root, home).
    """
    for own in _blocks(batches, n_key):
        starts = np.flatnonzero(np.concatenate(([True], (own[1:, :n_key] != own[:-1, :n_key]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(own)))
        if not labels:
            own, sizes = own[np.repeat(sizes > 1, sizes)], sizes[sizes > 1]
        ids, values = own[:, -2], own[:, -1].view(np.uint64)
        k, at = 0, 0
        while k < len(sizes):
            cost = np.cumsum(sizes[k : k + 4096].astype(np.int64) ** 2)
            end = k + max(1, int(np.searchsorted(cost, 2 * BLOCK_LIMIT**2, "right")))
            block = np.repeat(np.arange(end - k), sizes[k:end])
            here = slice(at, at + len(block))
            v, i_d = values[here], ids[here]
            by = np.lexsort((v, block))
            i, j = trie_pairs(v[by], np.concatenate(([0], np.cumsum(sizes[k:end]))), rule.budget)
            root = forest(len(block), by[i], by[j])
            far = root != np.arange(len(block))
            if labels:
                home = own[here, n_key + 1]
                out = np.flatnonzero(far | (home == 1))
                columns = [*(own[here, c][out] for c in range(n_key)), i_d[out], i_d[root[out]], home[out]]
            else:
                out = np.flatnonzero(far)
                columns = [i_d[out], i_d[root[out]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f"_{c}" for c in range(len(columns))])
            k, at = end, at + len(block)


# ---------------------------------------------------------------- joins on keys of which one may hold most rows


def hot_join(rows: DataFrame, other: DataFrame, key: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """rows join other, which has one row a key and, in `count`, the key's rows: keys that hold a large share of the
    rows are at most HOT_KEYS, so their part of `other` is broadcast, and their rows stay where they are."""
    hot = F.col(count) > max(HOT_ROWS, total // HOT_KEYS)
    many, few = F.broadcast(other.where(hot)), other.where(~hot)
    cold = rows.join(many.select(*key), key, "left_anti").join(few, key, how)
    return cold if how == "left_anti" else rows.join(many, key, how).unionByName(cold)


# ---------------------------------------------------------------- crowded blocks

def first_look(rows: DataFrame, hot: DataFrame, total: int, work: Callable, stages: Stages) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of crowded blocks (part, key, count, cells): the links of each cell with the block's pivots, the members' labels
    (cell, root), and for every block the label `best` that most members have and `rest`, the number of the others.

    `rows` has part, key, id and what `work(n_key, labels)` compares.
    """
    placed = hot_join(rows, hot, ["part", "key"], "count", total).withColumn("cell", F.pmod(F.xxhash64("id"), "cells"))
    pivot = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.floor(F.col("count") / PIVOTS), F.lit(1))) == 0
    cells = F.when(pivot, F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).otherwise(F.array("cell"))
    payload = [c for c in rows.columns if c not in ("part", "key", "id")]
    dealt = placed.withColumn("rank", F.when(pivot, 0).otherwise(1).cast("long")).withColumn("to", F.explode(cells))
    dealt = dealt.select("part", "key", F.col("to").alias("cell"), "rank", (F.col("to") == F.col("cell")).cast("long").alias("home"), "id", *payload)
    dealt = dealt.repartition("part", "key", "cell").sortWithinPartitions("part", "key", "cell", "rank", "id")
    found = stages.write(dealt.mapInArrow(work(3, True), "part long, key long, cell long, id long, root long, home long"), "looked")
    labels = found.where("home = 1").drop("home")
    each = labels.groupBy("part", "key", "root").agg(F.count("*").alias("n"))
    best = each.groupBy("part", "key").agg(F.max_by("root", F.struct("n", "root")).alias("best"), (F.sum("n") - F.max("n")).alias("rest"))
    best = stages.write(best.join(hot.select("part", "key", "cells"), ["part", "key"]), "best")
    return found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")), labels, best


def second_look(rows: DataFrame, labels: DataFrame, best: DataFrame, limit: int, work: Callable, stages: Stages) -> DataFrame:
    """The links between the members that don't have their block's best label and all members, for the blocks in `best`."""
    each = best.where("rest > 0").withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    marked = labels.join(each, ["part", "key", "cell"]).withColumn("askers", F.ceil(F.col("rest") / limit))
    marked = marked.select("part", "key", "id", "cell", "cells", "askers", (F.col("root") != F.col("best")).alias("asks"))
    held = rows.join(marked, ["part", "key", "id"])
    payload = [c for c in rows.columns if c not in ("part", "key", "id")]
    zero = F.lit(0).cast("long")
    answers = held.withColumn("asker", F.explode(F.sequence(zero, F.col("askers") - 1)))
    asks = held.where("asks").withColumn("asker", F.pmod(F.xxhash64("id", F.lit(2)), "askers")).withColumn("cell", F.explode(F.sequence(zero, F.col("cells") - 1)))
    keys = ["part", "key", "asker", "cell"]
    dealt = answers.select(*keys, "id", *payload).union(asks.select(*keys, "id", *payload))
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return stages.write(dealt.mapInArrow(work(4, False), "a long, b long").where("a <> b"), "again")


# ---------------------------------------------------------------- dealing into blocks


def _runs(positions: list[int], parts: int) -> list[int]:
    """Masks of `parts` runs that cover the bit positions."""
    return [sum(1 << int(p) for p in run) for run in np.array_split(np.array(positions), parts) if len(run)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def first_masks(rule: Rule) -> list[int]:
    return [x | y for x, y in combinations(_runs(list(range(BITS)), rule.budget + 2), 2)]


def finer_masks(mask: int, rule: Rule) -> list[int]:
    """Masks of which two fingerprints within the budget, equal in `mask`, agree on one."""
    return [mask | run for run in _runs([p for p in range(BITS) if not mask >> p & 1], rule.budget + 1)]


def links(nodes: DataFrame, rule: Rule, stages: Stages, limit: int = BLOCK_LIMIT) -> DataFrame:
    """Links (a, b) between the ids of `nodes` (id, c, d): they span all groups that the rule links."""

    def work(n_key: int, labels: bool) -> Callable:
        return lambda batches: _trie_links(batches, rule, n_key, labels)

    nodes_n = nodes.count()
    masks, found = [] if rule.draws else first_masks(rule), []
    if rule.draws:
        keyed = nodes.select("id", F.col("c").alias("v"), F.posexplode("d").alias("part", "key")).select(F.col("part").cast("long").alias("part"), "key", "id", "v")
    else:
        each = F.explode(F.array(*(F.lit(_signed(m)).cast("long") for m in masks)))
        keyed = nodes.select("id", F.col("c").alias("v"), each.alias("part")).select("part", F.col("v").bitwiseAND(F.col("part")).alias("key"), "id", "v")
    total = nodes_n * (rule.draws or len(masks))
    for level in range(LEVELS + 1):
        counts = keyed.groupBy("part", "key").agg(F.count("*").alias("count"))
        hot = stages.write(counts.where(F.col("count") > limit).withColumn("cells", F.ceil(2 * F.col("count") / limit)), "hot")
        crowded = not hot.isEmpty()
        small = hot_join(keyed, hot, ["part", "key"], "count", total, "left_anti") if crowded else keyed
        small = small.repartition("part", "key").sortWithinPartitions("part", "key")
        found.append(stages.write(small.mapInArrow(work(2, False), "a long, b long").distinct(), "links"))
        if not crowded:
            break
        own, labels, best = first_look(keyed, hot, total, work, stages)
        # a block whose rest costs more rows than another dealing is dealt again, while it has bits for it
        finer = {m: finer_masks(m, rule) for m in masks if level < LEVELS and BITS - m.bit_count() > rule.budget}
        again = (F.ceil(2 * F.col("rest") / limit) > rule.budget + 1) & F.col("part").isin([_signed(m) for m in finer])
        found += [own.distinct(), second_look(keyed, labels, best.where(~again), limit // 2 or 1, work, stages)]
        left = stages.write(best.where(again).join(hot.select("part", "key", "count"), ["part", "key"]), "left")
        if left.isEmpty():
            break
        # the masks of a level follow from the rule and the level: 15, then five times as many each time at most
        step = nodes.sparkSession.createDataFrame([(_signed(m), [_signed(f) for f in fs]) for m, fs in finer.items()], "part long, finer array<long>")
        dealt = hot_join(keyed, left.select("part", "key", "count"), ["part", "key"], "count", total).join(F.broadcast(step), "part")
        dealt = dealt.select(F.explode("finer").alias("part"), "id", "v").dropDuplicates(["id", "part"])
        keyed = stages.write(dealt.select("part", F.col("v").bitwiseAND(F.col("part")).alias("key"), "id", "v"), "dealt")
        masks, total = sorted({f for fs in finer.values() for f in fs}), keyed.count()
    out = found[0]
    for df in found[1:]:
        out = out.union(df)
    return out.distinct()


# ---------------------------------------------------------------- components


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """node and root (the smallest node it reaches, itself included) for every node of the edges (a, b), by alternating
    stars.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node around it, until
    nothing changes; the edges then form one star for each component.
    """

    def star(df: DataFrame, large: bool, total: int) -> DataFrame:
        if large:
            df = df.union(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            df = df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = df.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))  # one exchange, used again
        joined = hot_join(df, low, ["a"], "n", total)
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return stages.write(out.where("a <> b").distinct(), "stars")

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stages.write(edges.where("a <> b").distinct(), "edges")
    seen = mark(now)
    while seen[0]:
        half = star(now, True, 2 * seen[0])
        new = star(half, False, seen[0])
        stages.drop(now, half)
        now = new
        if (got := mark(now)) == seen:
            break
        seen = got
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


# ---------------------------------------------------------------- the check of candidates on their shingles


def similar_links(sets: list[np.ndarray], similarity: float, ids: list | None = None) -> list[tuple[int, int]]:
    """Links that span the groups of sets (sorted, without repeats) whose pairs have at least that Jaccard similarity.

    Every pair is compared, unless the links before connect it already or its sizes rule it out. Sets of one id are one.
    """
    size = np.array([len(x) for x in sets])
    label, out = np.arange(len(sets)), []
    if ids is not None:
        label = np.unique(np.array(ids), return_inverse=True)[1].reshape(-1)
    by = np.argsort(size, kind="stable")
    for k, i in enumerate(by):
        # smaller sets, the nearest in size first, down to the smallest that may be similar
        low = np.searchsorted(size[by[:k]], int(similarity * size[i]))
        for j in by[low:k][::-1]:
            if label[i] == label[j]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            union = size[i] + size[j] - both
            if union == 0 or both / union >= similarity:
                out.append((int(i), int(j)))
                label[label == label[i]] = label[j]
    return out


def _text_links(batches, words: int, similarity: float, n_key: int, labels: bool = False):
    """What `_trie_links` is for fingerprints, for rows with a text in their place."""
    now, held, sets = None, [], []

    def found():
        ids = [h[-1] for h in held]
        pairs = similar_links(sets, similarity, ids)
        if not labels:
            columns = [[ids[i] for i, _ in pairs], [ids[j] for _, j in pairs]]
        else:
            root = forest(len(ids), *(np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))).tolist() if pairs else range(len(ids))
            out = [(*now, ids[k], ids[r], held[k][1]) for k, r in enumerate(root) if held[k][1] or r != k]
            columns = list(zip(*out, strict=True)) or [()] * (n_key + 3)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f"_{c}" for c in range(len(columns))])

    for batch in batches:
        longs = zip(*(c.to_pylist() for c in batch.columns[:-1]), strict=True)
        for own, text in zip(longs, batch.column(batch.num_columns - 1), strict=True):
            if own[:n_key] != now:
                if held:
                    yield found()
                now, held, sets = own[:n_key], [], []
            held.append(own[n_key:])
            sets.append(np.unique(shingle_hashes(text.as_py(), words)))
    if held:
        yield found()


def confirmed(nodes: DataFrame, roots: DataFrame, docs: DataFrame, rule: Rule, similarity: float, stages: Stages) -> DataFrame:
    """Links (a, b) that span the groups of similar texts within the candidate groups.

    A candidate group comes to one task with its texts; a larger one is crowded.
    """

    def work(n_key: int, labels: bool) -> Callable:
        return lambda batches: _text_links(batches, rule.words, similarity, n_key, labels)

    members = stages.write(nodes.select("id", "first", "w").join(roots, F.col("id") == F.col("node")).drop("node"), "members")
    total = members.count()
    sums = members.groupBy("root").agg(F.count("*").alias("count"), F.sum("w").alias("w"))
    sums = stages.write(sums.select("root", "count", F.greatest(F.ceil(F.col("count") / CELL_TEXTS), F.ceil(F.col("w") / CELL_SHINGLES), F.lit(1)).alias("cells")), "sums")
    own = hot_join(members, sums, ["root"], "count", total).select("id", "root", "cells", F.coalesce("first.doc_id", F.lit(-1)).alias("d"), F.col("first.h").alias("h"))
    # a null id stands with -1: rows of one hash have one text, whatever their id
    texts = pick(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("d"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h"))
    held = texts.join(own, ["d", "h"]).dropDuplicates(["d", "h", "id"]).select(F.lit(0).cast("long").alias("part"), F.col("root").alias("key"), "id", "cells", "text")
    held = stages.write(held, "texts")
    rows = held.drop("cells")
    small = held.where("cells = 1").select("part", "key", "id", "text").repartition("key").sortWithinPartitions("key")
    found = stages.write(small.mapInArrow(work(2, False), "a long, b long").where("a <> b"), "confirmed")
    hot = sums.where("cells > 1").select(F.lit(0).cast("long").alias("part"), F.col("root").alias("key"), "count", "cells")
    if hot.isEmpty():
        return found
    links_, labels, best = first_look(rows, hot, total, work, stages)
    return found.union(links_).union(second_look(rows, labels, best, CELL_TEXTS, work, stages))


def classes(rows: DataFrame, rule: Rule, stages: Stages, limit: int = BLOCK_LIMIT, docs: DataFrame | None = None, similarity: float = SIMILARITY) -> DataFrame:
    """Of `codes`: c, own (rows of this code), first (no_id, doc_id, h of the component's first row, by doc_id, null
    last, then h) and n (the component's rows).

    With `docs`, the components of the rule are candidates: only links of texts of that similarity stay.
    """
    # repeats of a code are one node, with the count of its rows: a hot group of copies is one row from here on
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    # one code may stand for several sets of shingles, which the check must tell apart
    same = ["c"] if docs is None else ["c", "s"]
    distinct = rows.groupBy(*same).agg(F.min(first).alias("first"), F.count("*").alias("own"), F.first("w").alias("w"), F.first("d").alias("d"))
    nodes = stages.write(distinct.withColumn("id", F.monotonically_increasing_id()), "nodes")
    roots = components(links(nodes.select("id", "c", "d"), rule, stages, limit), stages)
    if docs is not None:
        roots = components(confirmed(nodes, roots, docs, rule, similarity, stages), stages)
    of = stages.write(nodes.select("id", "c", "own", "first").join(roots, F.col("id") == F.col("node"), "left").drop("node"), "roots")
    # a code without links is its own group
    linked = of.where("root is not null")
    groups = stages.write(linked.groupBy("root").agg(F.min("first").alias("group_first"), F.sum("own").alias("n"), F.count("*").alias("count")), "groups")
    joined = hot_join(linked, groups, ["root"], "count", nodes.count()).select("c", "own", F.col("group_first").alias("first"), "n")
    return stages.write(joined.union(of.where("root is null").select("c", "own", "first", F.col("own").alias("n"))), "classes")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), limit: int = BLOCK_LIMIT) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits), component_id and component_rows (the smallest
    doc_id of its component, and the number of its rows)."""
    stages = Stages(docs.sparkSession, "simhash")
    rows = stages.write(codes(docs, rule), "codes")
    found = hot_join(rows.select("doc_id", "c"), classes(rows, rule, stages, limit), ["c"], "own", rows.count())
    return found.select("doc_id", F.lower(F.lpad(F.hex("c"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"), F.col("n").alias("component_rows"))


def without_near_duplicates(docs: DataFrame, rule: Rule = SIMILAR, similarity: float = SIMILARITY, limit: int = BLOCK_LIMIT) -> DataFrame:
    """The rows of docs with one row of each component of texts whose sets of shingles have that Jaccard similarity
    (among the candidates of the rule), with all their columns: the row of the smallest doc_id (a null
    one last; of several such rows, by a hash of the text), and one of the rows that repeat it in doc_id and text."""
    stages = Stages(docs.sparkSession, "simhash")
    rows = stages.write(codes(docs, rule), "codes")
    kept = classes(rows, rule, stages, limit, docs, similarity).select(F.coalesce("first.doc_id", F.lit(-1)).alias("kept_id"), F.col("first.no_id").alias("kept_no_id"), F.col("first.h").alias("kept_h")).distinct()
    # the columns of docs go by number, so that none has the name of another or of these
    names = docs.columns
    at = {n: f"c{next(i for i, c in enumerate(names) if c == n)}" for n in ("doc_id", "text")}
    own = docs.toDF(*(f"c{i}" for i in range(len(names))))
    own = own.withColumns({"kept_id": F.coalesce(F.col(at["doc_id"]).cast("long"), F.lit(-1)), "kept_no_id": F.col(at["doc_id"]).isNull(), "kept_h": F.xxhash64(at["text"])})
    key = ["kept_id", "kept_no_id", "kept_h"]
    return own.join(kept, key, "left_semi").dropDuplicates(key).drop(*key).toDF(*names)
