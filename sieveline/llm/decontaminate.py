"""Benchmark decontamination (operator 2): SimHash of item-sized windows, Hamming blocks, exact verification.

Texts and items are read as lower-case words; the unit is a shingle of five words (an item of fewer words is one
shingle). For every item size, the windows of that size in a document are fingerprinted (64-bit SimHash of their
shingles, with repeats). A multi-index finds all items of the window's size within RADIUS bits: the fingerprint is
cut into BLOCKS runs, and a fingerprint within the radius agrees with the item's in at least one run up to
RADIUS // BLOCKS bits, so looking up every run with that many bits flipped finds them all. A candidate counts if the
weighted similarity of the two shingle multisets (sum of the smaller counts over sum of the larger ones) is SIMILAR
or more, on the words themselves. Two multisets of similarity 0.8 differ in 9.7 of 64 bits on average; of edited pairs of
13 to 100 words one in some 9,000 lies beyond RADIUS and is lost.

A document of fewer words than an item is itself a window, if it is long enough to be similar at all.

Windows that cannot pass are not fingerprinted: two multisets of m shingles each reach the similarity s only if
2s / (1 + s) of the window's shingles occur in items of that size, and that is counted for all windows at once by running
sums. The bound is exact, so no passing window is lost.

Documents that share no run of five words (or no whole shorter item) with the benchmark are passed over after one
vectorised look-up of all their runs.

The benchmark is taken in blocks of about BLOCK_BYTES of text; the driver holds one block's text at a time, and a
worker its arrays, some ten bytes for each byte of it. The documents are scanned once for each block.

Defined cases: null counts as empty; items without words match nothing; items with equal text are each reported; rows
of docs are independent, so repeated rows give equal rows; of several windows that match an item, the most similar,
then leftmost, is reported; an empty table of either kind gives no matches; other columns are not read by `matches`
and are kept as they are by `clean`.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import pick, text_steps

SHINGLE = 5
SIMILAR = 0.8
RADIUS = 17
BLOCKS = 6
BLOCK_BYTES = 8 << 20
#: places whose running bit counts are held at once, and bytes of text that are hashed at once
SEGMENT = 1 << 14
PIECE = 1 << 20

#: a word: ASCII letters, digits and underscores, and any other character beyond ASCII; texts are lower-cased before
_WORD = re.compile("[0-9a-z_\x80-\U0010ffff]+")
_ANY_WORD = re.compile("[0-9A-Za-z_\x80-\U0010ffff]+")  # the same words in a text that is not lower-cased
#: shingles of items that a worker remembers, by item
_REMEMBERED = 4096
_IN_WORD = np.array([chr(b).isalnum() or b == 95 or b >= 128 for b in range(256)])
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# a byte at place j counts byte * BASE ** j; dividing by BASE ** start makes a word's sum independent of its place
_BASE = 0x100000001B3
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


_up, _down = _powers(_BASE, 1 << 12), _powers(_UNBASE, 1 << 12)


def _word_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and hashes of the words in lower-case UTF-8."""
    global _up, _down
    if len(_up) <= len(raw):
        _up, _down = _powers(_BASE, 2 * len(raw)), _powers(_UNBASE, 2 * len(raw))
    inside = np.concatenate(([False], _IN_WORD[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _up[: len(raw)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _down[starts]
    h ^= h >> np.uint64(32)
    return starts, h * _M2


def words_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """`_word_sums` in pieces of about PIECE bytes, cut after a byte outside words, so that long texts stay in memory."""
    array = np.frombuffer(raw, dtype=np.uint8)
    at, starts, hashes = 0, [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    while at < len(array):
        end = min(at + PIECE, len(array))
        while end < len(array) and _IN_WORD[array[end - 1]]:
            end += 1
        s, h = _word_sums(array[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def runs_of(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words at each place, from the words' hashes."""
    out = np.full(max(0, len(h) - k + 1), np.uint64(k))
    for i in range(k):
        out = (out ^ h[i : len(out) + i]) * _M1
        out ^= out >> np.uint64(31)
    out *= _M2
    return out ^ (out >> np.uint64(29))


def lower_bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def shingle_hashes(text: str | None) -> np.ndarray:
    """Hashes of the shingles at each place; of all words together if they are fewer than a shingle."""
    h = words_of(lower_bytes(text))[1]
    return runs_of(h, min(SHINGLE, len(h))) if len(h) else np.zeros(0, dtype=np.uint64)


def shingles(words: list[str]) -> Counter:
    k = min(SHINGLE, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    union = sum(a.values()) + sum(b.values()) - both
    return both / union if union else 0.0


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of `size` shingles from the given starts (ascending)."""
    out = np.zeros(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        end = int(np.searchsorted(starts, lo + SEGMENT))
        own = starts[at:end] - lo
        total = np.zeros((int(own[-1]) + size + 1, 64), dtype=np.int32)
        np.cumsum(_bits(hashes[lo : lo + len(total) - 1]), axis=0, out=total[1:])
        bits = 2 * (total[own + size] - total[own]) > size
        out[at:end] = np.packbits(bits, axis=1).reshape(-1, 8).view(">u8").reshape(-1)
        at = end
    return out


class Index:
    """Fingerprints of one block of the benchmark, by item size and Hamming block."""

    def __init__(self, items: list[tuple[int, str]]):
        lower = [(i, t.lower()) for i, t in items if t]
        lower = [(i, t) for i, t in lower if _WORD.search(t)]
        self.ids, self.texts = [i for i, _ in lower], [t for _, t in lower]
        own = [words_of(t.encode("utf-8", "replace"))[1] for t in self.texts]
        hashes = [runs_of(h, min(SHINGLE, len(h))) for h in own]
        #: words of an item: an item shorter than a shingle only matches windows of as many words
        self.size = np.array([len(h) for h in own], dtype=np.int64)
        self.prints = np.array([window_fingerprints(h, np.zeros(1, dtype=np.int64), len(h))[0] for h in hashes], dtype=np.uint64)
        short = self.size < SHINGLE
        self.short: dict[tuple, list[int]] = {}
        for k in np.flatnonzero(short).tolist():
            self.short.setdefault(tuple(_WORD.findall(self.texts[k])), []).append(k)
        long = np.flatnonzero(~short)
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *(hashes[k] for k in long)]))
        #: words in a run, with the hashes of the benchmark's runs of as many words
        self.known = {SHINGLE: self.vocabulary} | {int(n): np.unique(np.concatenate([hashes[k] for k in np.flatnonzero(short & (self.size == n))])) for n in set(self.size[short].tolist())}
        #: item sizes by shingle hash: a window of n words only counts shingles of items of n words
        of_size = [np.zeros((0, 2), dtype=np.uint64), *(np.stack([hashes[k], np.full(len(hashes[k]), np.uint64(self.size[k]))], axis=1) for k in long)]
        sized = np.unique(np.concatenate(of_size), axis=0)
        self.sized_hash, self.sized = sized[:, 0].copy(), sized[:, 1].astype(np.int64)
        self.filters = {}
        for n, hashed in self.known.items():
            self.filters[n] = np.zeros(1 << 22, dtype=bool)
            self.filters[n][hashed >> np.uint64(42)] = True
        self.sizes = {int(n): None for n in sorted(set(self.size[long].tolist()))}
        cuts = np.linspace(0, 64, BLOCKS + 1).astype(int)
        self.runs = [(int(a), int(b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        flips = RADIUS // BLOCKS
        self.flips = [np.array([sum(1 << p for p in c) for n in range(flips + 1) for c in combinations(range(width), n)], dtype=np.uint64) for _, width in self.runs]
        for n in self.sizes:
            own = np.array([k for k in long if self.size[k] == n])
            tables = []
            for a, width in self.runs:
                key = self._run(self.prints[own], a, width)
                order = np.argsort(key, kind="stable")
                tables.append((key[order], own[order]))
            self.sizes[n] = tables

    def shingles_of(self, k: int) -> Counter:
        """The shingles of item k; a worker makes those of an item when a candidate first asks for it."""
        held = self.__dict__.setdefault("_held", {})
        if k not in held:
            if len(held) >= _REMEMBERED:
                held.clear()
            held[k] = shingles(_WORD.findall(self.texts[k]))
        return held[k]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_held"}

    @staticmethod
    def _run(prints: np.ndarray, at: int, width: int) -> np.ndarray:
        return (prints >> np.uint64(at)) & np.uint64((1 << width) - 1)

    def near(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """All (fingerprint, item) pairs within the radius, for items of n words, as indices."""
        left, right = [], []
        for (a, width), flips, (keys, items) in zip(self.runs, self.flips, self.sizes[n], strict=True):
            asked = (self._run(prints, a, width)[:, None] ^ flips).reshape(-1)
            lo, hi = np.searchsorted(keys, asked, "left"), np.searchsorted(keys, asked, "right")
            hits = hi - lo
            some = np.flatnonzero(hits)
            place = np.repeat(lo[some] - np.concatenate(([0], np.cumsum(hits[some])[:-1])), hits[some]) + np.arange(hits[some].sum())
            left.append(np.repeat(some // len(flips), hits[some]))
            right.append(items[place.astype(np.int64)])
        i, k = np.concatenate(left), np.concatenate(right)
        pair = np.unique(i * len(self.ids) + k)
        i, k = pair // len(self.ids), pair % len(self.ids)
        ok = np.bitwise_count(prints[i] ^ self.prints[k]) <= RADIUS
        return i[ok], k[ok]

    def _among(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Places of the hashes that the benchmark has for runs of n words."""
        known = self.known[n]
        maybe = np.flatnonzero(self.filters[n][hashes >> np.uint64(42)])
        if not len(known) or not len(maybe):
            return np.zeros(0, dtype=np.int64)
        place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        return maybe[known[place] == hashes[maybe]]

    def suspects(self, texts: list) -> list[int]:
        """Indices of the texts that have a run of words in common with the benchmark; no other text can match."""
        raws = [lower_bytes(t) for t in texts]
        starts, h = words_of(b"\n".join(raws))
        bounds = np.cumsum([0, *(len(r) + 1 for r in raws)])
        found: set[int] = set()
        for n in self.known:
            at = self._among(runs_of(h, n), n)
            doc = np.searchsorted(bounds, starts[at], "right") - 1
            within = doc == np.searchsorted(bounds, starts[at + n - 1], "right") - 1
            found.update(doc[within].tolist())
        return sorted(found)

    def all_matches(self, texts: list) -> list[list]:
        """`matches` of each text."""
        out: list[list] = []
        for step in text_steps(texts):
            own: list[list] = [[] for _ in step]
            for i in self.suspects(step):
                own[i] = self.matches(step[i])
            out += own
        return out

    def matches(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of every item that a window of the text matches."""
        words = _WORD.findall((text or "").lower())
        best: dict[int, tuple[float, int, int]] = {}  # similarity, first word backwards, words
        if self.short:
            for n in {len(w) for w in self.short}:
                for i in range(len(words) - n + 1):
                    for k in self.short.get(tuple(words[i : i + n]), ()):
                        best.setdefault(k, (1.0, -i, n))
        hashes = shingle_hashes(text) if len(words) >= SHINGLE else np.zeros(0, dtype=np.uint64)
        known = self._among(hashes, SHINGLE)
        lo, hi = (np.searchsorted(self.sized_hash, hashes[known], side) for side in ("left", "right"))
        times = hi - lo
        size = self.sized[np.repeat(hi - np.cumsum(times), times) + np.arange(times.sum())]
        place = np.repeat(known, times)
        for n in np.unique(size).tolist():
            m = n - SHINGLE + 1
            window = min(m, len(hashes))  # a shorter document is one window
            least = SIMILAR / (1 + SIMILAR) * (m + window) - 1e-9
            own = place[size == n]
            if len(own) < least:
                continue
            before = np.zeros(len(hashes) + 1, dtype=np.int64)
            before[own + 1] = 1
            np.cumsum(before, out=before)
            starts = np.flatnonzero(before[window:] - before[:-window] >= least)
            if len(starts):
                words_n = window + SHINGLE - 1
                for i, k in zip(*self.near(window_fingerprints(hashes, starts, window), n), strict=True):
                    at = int(starts[i])
                    s = similarity(shingles(words[at : at + words_n]), self.shingles_of(int(k)))
                    if s >= SIMILAR - 1e-12 and (s, -at) > best.get(int(k), (0.0, 0, 0))[:2]:
                        best[int(k)] = (s, -at, words_n)
        return sorted((k, s, -back, n) for k, (s, back, n) in best.items())


def blocks(benchmark: DataFrame):
    """The benchmark's index in blocks of bounded text."""
    items = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Index(sorted(((r.item_id, r.text) for r in own.collect()), key=lambda r: (r[0] is None, r)))  # BLOCK_BYTES of text


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity and the place (start and end, in characters) of each item that each row matches."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema, out = "doc_id long, item_id long, similarity double, start long, end long", None
    for index in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            own = shared.value
            for batch in batches:
                found = []
                texts = batch.column(1).to_pylist()
                for doc_id, text, hits in zip(batch.column(0).to_pylist(), texts, own.all_matches(texts), strict=True):
                    if hits:
                        at = [m.span() for m in _ANY_WORD.finditer(text)]
                        found += [(doc_id, own.ids[k], s, at[a][0], at[a + n - 1][1]) for k, s, a, n in hits]
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))], ["doc_id", "item_id", "similarity", "start", "end"])

        found = rows.mapInArrow(work, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that match no item of the benchmark, with all their columns."""
    text = docs.columns.index("text")
    for index in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            for batch in batches:
                yield batch.filter(pa.array([not hits for hits in shared.value.all_matches(batch.column(text).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
