"""Suffix-array dedup (operator 7): bytes of a text that repeat a string of 50 bytes from an earlier document go.

Every 50-byte string (window) has an anchor, the 16-byte gram in it with the smallest hash, leftmost if tied: equal
windows have equal anchors wherever they stand, and neighbouring windows mostly share theirs. That deals the suffixes
of all texts into parts without sending 50 bytes for each position:

1. chunks    documents are packed into chunks of a few MB, which are written once.
2. repeated  each chunk sends the distinct hashes of its anchors, by part; a part answers which ones more than one
             chunk holds. Only these, and those that two documents of the chunk hold, are followed up.
3. sorted    each chunk sends the bytes around its repeated anchors, equal ones once with their smallest document.
             A part sorts all suffixes that start at a window there, for the first 50 bytes: the suffix array of the
             part, made in slices of whole anchors (of one very common anchor, by the place in the window). Sorting is deep-shallow: multikey quicksort with characters of 8 bytes to a depth of 16, then a
             blind trie for each group that is still tied, whose nodes skip the common prefix of the group and branch
             on one byte. Each run of suffixes equal in 50 bytes has a smallest document; the answer says for which
             windows it is smaller than the sender's.
4. removed   each chunk marks the bytes of those windows.

Exact: a window is removed if and only if its 50 bytes also start in a document with a smaller doc_id (of any part or
chunk). Groups of copies are folded within each chunk before they are sent, and once more in the part.

Memory: texts are worked on in segments and parts in slices, so a worker holds its chunk (one text at least), about a
dozen bytes for each of its bytes if all of it is repeated, and one slice. Rows: a chunk sends a row to each part, and a
part is of at least PART_BYTES of text, so rows grow with the input up to MIN_PARTS * PART_BYTES and are of kilobytes beyond.

Defined cases: null counts as empty; a text of fewer than 50 bytes loses nothing; rows with equal doc_id don't remove
anything from each other; a null doc_id counts as larger than all others; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import Stages, pick

LENGTH = 50
GRAM = 16
SHALLOW = 16
#: bytes of text in a chunk, and bytes of all text for each part; the parts of a small table
CHUNK_BYTES = 4 << 20
PART_BYTES = 16 << 20
MIN_PARTS = 64
#: positions that are hashed at once, anchors whose bytes are copied at once, and suffixes that are sorted at once
SEGMENT = 1 << 20
PIECE = 1 << 15
SLICE = 1 << 20
LAST_ID = (1 << 63) - 1
_BACK, _AHEAD = LENGTH - GRAM, LENGTH
_CONTEXT = _BACK + _AHEAD  # bytes around an anchor that its windows can cover
_ROW = -(-(_CONTEXT + 2) // 8) * 8  # with the two ends of the anchor's windows, in whole words

# odd multipliers for hashing
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _words(body: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The 8-byte words at every position but the last 7, unaligned (a view)."""
    return np.ndarray((max(0, len(body) - 7),), dtype=kind, buffer=body, strides=(1,))


def _mix(x: np.ndarray, y: np.ndarray, a: np.uint64, b: np.uint64) -> np.ndarray:
    h = x * a
    h ^= h >> np.uint64(32)
    h += y * b
    h ^= h >> np.uint64(29)
    h *= _M3
    h ^= h >> np.uint64(32)
    return h


def anchors(body: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all windows inside documents: runs of windows with one anchor, as (anchor, first start, last start, document)."""
    bounds = np.concatenate(([0], np.cumsum(lens)))
    n, reach = len(body), LENGTH - GRAM + 1
    long = lens >= LENGTH
    # windows start in runs of positions, one for each text that is long enough
    run_from, run_to = bounds[:-1][long], bounds[1:][long] - LENGTH + 1
    out = [tuple(np.zeros(0, dtype=np.int64) for _ in range(4))]
    for lo in range(0, max(0, n - LENGTH + 1), SEGMENT):
        hi = min(lo + SEGMENT, n - LENGTH + 1)
        a, b = np.searchsorted(run_to, lo, "right"), np.searchsorted(run_from, hi, "left")
        if a >= b:
            continue
        w = _words(body[lo : hi + LENGTH])
        grams = hi - lo + reach - 1
        h = _mix(w[:grams].astype(np.uint64), w[8 : 8 + grams].astype(np.uint64), _M1, _M2)
        h = (h >> np.uint64(24) << np.uint64(24)) | np.arange(grams, dtype=np.uint64)
        size = 1
        while 2 * size <= reach:
            h = np.minimum(h[: len(h) - size], h[size:])
            size *= 2
        h = np.minimum(h[: hi - lo], h[reach - size : reach - size + hi - lo])
        inside = np.zeros(hi - lo + 1, dtype=np.int32)
        np.add.at(inside, np.maximum(run_from[a:b], lo) - lo, 1)
        np.add.at(inside, np.minimum(run_to[a:b], hi) - lo, -1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]))
        at = (h[starts] & np.uint64((1 << 24) - 1)).astype(np.int64) + lo
        starts += lo
        cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((cut[1:] - 1, [len(starts) - 1]))
        out.append((at[cut], starts[cut], starts[last], np.searchsorted(bounds, at[cut], "right") - 1))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Chunk:
    """A chunk of documents with its anchors; everything here follows from its bytes, so each step may redo it."""

    def __init__(self, ids: list, lens: list, packed: bytes, parts: int):
        self.ids = ids
        self.order = np.array([LAST_ID if i is None else i for i in ids], dtype=np.int64)
        self.lens = np.array(lens, dtype=np.int64)
        raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.lens.sum())) if self.lens.sum() else b""
        self.body, self.parts = np.frombuffer(raw + bytes(8), dtype=np.uint8)[: len(raw)], parts
        self.at, self.first, self.last, self.doc = anchors(self.body, self.lens)
        w = _words(self.body)
        self.hash = _mix(w[self.at].astype(np.uint64), w[self.at + 8].astype(np.uint64), _M2, _M1)
        self.keys, self.key_of = np.unique(self.hash, return_inverse=True)
        self.by_part = np.argsort(self.keys % np.uint64(parts), kind="stable")
        self.part = (self.keys % np.uint64(parts)).astype(np.int64)[self.by_part]

    def runs(self, part: np.ndarray) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))).tolist() if len(part) else []
        for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
            yield int(part[a]), slice(a, b)

    def asked(self) -> Iterator[tuple[int, bytes]]:
        for part, own in self.runs(self.part):
            yield part, self.keys[self.by_part[own]].tobytes()

    def follow(self, answers: dict[int, bytes]) -> None:
        """Keeps the anchors that are repeated: as the answers have it, or in two documents of this chunk."""
        repeated = np.zeros(len(self.keys), dtype=bool)
        for part, own in self.runs(self.part):
            if part in answers:
                k = self.by_part[own]
                repeated[k] = np.unpackbits(np.frombuffer(answers[part], dtype=np.uint8), count=len(k)).astype(bool)
        low = np.full(len(self.keys), LAST_ID)
        high = np.full(len(self.keys), -LAST_ID - 1)
        np.minimum.at(low, self.key_of, self.order[self.doc])
        np.maximum.at(high, self.key_of, self.order[self.doc])
        repeated |= low < high
        kept = np.flatnonzero(repeated[self.key_of])
        rows = np.zeros((len(kept), _ROW), dtype=np.uint8)
        for lo in range(0, len(kept), PIECE):
            own = kept[lo : lo + PIECE]
            at, first, last = self.at[own], self.first[own], self.last[own]
            place = at[:, None] + np.arange(-_BACK, _AHEAD)
            used = (place >= first[:, None]) & (place < last[:, None] + LENGTH)
            here = rows[lo : lo + PIECE]
            here[:, :_CONTEXT] = np.where(used, self.body[np.clip(place, 0, max(0, len(self.body) - 1))], 0)
            here[:, _CONTEXT], here[:, _CONTEXT + 1] = at - last, at - first
        self.kept, (self.some, self.row_of) = kept, fold(rows)
        self.rows = rows[self.some]
        self.low = np.full(len(self.some), LAST_ID)
        np.minimum.at(self.low, self.row_of, self.order[self.doc[kept]])
        row_part = (self.hash[kept[self.some]] % np.uint64(self.parts)).astype(np.int64)
        self.row_order = np.argsort(row_part, kind="stable")
        self.row_part = row_part[self.row_order]

    def contexts(self) -> Iterator[tuple[int, int, bytes]]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for part, own in self.runs(self.row_part):
            k = self.row_order[own]
            yield part, len(k), pack(self.low[k].tobytes() + self.rows[k].tobytes())

    def removed(self, answers: dict[int, bytes]) -> np.ndarray:
        """Whether each byte is removed. An answer has, for each context, bits of the windows that a smaller document has."""
        bits = np.zeros(len(self.rows), dtype=np.uint64)
        for part, own in self.runs(self.row_part):
            bits[self.row_order[own]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(answers[part]), dtype=np.uint64)
        own = bits[self.row_of]
        at, nearest, farthest = self.at[self.kept], self.rows[self.row_of, _CONTEXT], self.rows[self.row_of, _CONTEXT + 1]
        beaten = self.order[self.doc[self.kept]] > self.low[self.row_of]  # an equal context here has a smaller document
        start = np.zeros(len(self.body) + 1, dtype=np.int8)
        for back in range(_BACK + 1):
            hit = ((own >> np.uint64(back)) & np.uint64(1)).astype(bool) | (beaten & (nearest <= back) & (back <= farthest))
            start[at[hit] - back] = 1
        gone = np.zeros(len(self.body), dtype=bool)
        for lo in range(0, len(self.body), SEGMENT):
            hi = min(lo + SEGMENT, len(self.body))
            back = max(0, lo - LENGTH + 1)
            before = np.concatenate(([0], np.cumsum(start[back:hi], dtype=np.int64)))
            i = np.arange(lo, hi)
            gone[lo:hi] = before[i + 1 - back] > before[np.maximum(back, i - LENGTH + 1) - back]
        return gone


def fold(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal rows (of whole words): the places of distinct rows, and for each row the index of its own."""
    words = rows.view(np.uint64).reshape(len(rows), -1)
    h = np.zeros(len(rows), dtype=np.uint64)
    for k in range(words.shape[1]):
        h = _mix(h ^ words[:, k], h + np.uint64(k + 1), _M1, _M2)
    _, some, own = np.unique(h, return_index=True, return_inverse=True)
    if any((words[:, k] != words[some, k][own]).any() for k in range(words.shape[1])):  # two rows with one hash
        _, some, own = np.unique(words, axis=0, return_index=True, return_inverse=True)
    return some, own.reshape(-1)


# ---------------------------------------------------------------- sorting the suffixes of a part


def _groups(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether each suffix in the order starts a new group: one of the keys differs from the one before."""
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    return new


def deep_shallow(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of `body` that start at `at`, by their first LENGTH bytes, and the number of each one's
    group of equals (by place in the order).

    `body` has at least LENGTH bytes from every start.
    """
    word = _words(body, ">u8")
    order = np.arange(len(at))
    group = np.zeros(len(at), dtype=np.int64)  # of each place in the order
    open_ = np.arange(len(at)) if len(at) > 1 else np.zeros(0, dtype=np.int64)  # places whose group isn't settled
    # shallow: multikey quicksort, a character of 8 bytes at a time; groups of one suffix are done
    for depth in range(0, SHALLOW, 8):
        if not len(open_):
            break
        own, g = order[open_], group[open_]
        key = word[at[own] + depth].astype(np.uint64)
        by = np.lexsort((key, g))
        order[open_] = own[by]
        new = _groups(by, key, g)
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        open_ = open_[_shared(group[open_])]
    # deep: every group that is left grows a blind trie from its common prefix; all tries grow a node at a time
    while len(open_):
        own, g = order[open_], group[open_]
        head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        size = np.diff(np.concatenate((head, [len(g)])))
        lead = np.repeat(own[head], size)
        agree = np.full(len(own), LENGTH)  # bytes in which a suffix agrees with its group's first
        for depth in (*range(SHALLOW, LENGTH - 8, 8), LENGTH - 8):
            some = np.flatnonzero(agree == LENGTH)
            x = word[at[own[some]] + depth] ^ word[at[lead[some]] + depth]
            x = x.astype(np.uint64)
            differ = np.flatnonzero(x)
            agree[some[differ]] = depth + _leading_zero_bytes(x[differ])
        skip = np.repeat(np.minimum.reduceat(agree, head), size)
        going = skip < LENGTH  # the others are equal: a leaf of the trie
        open_, own, g, skip = open_[going], own[going], g[going], skip[going]
        branch = body[at[own] + skip]
        by = np.lexsort((branch, g))
        order[open_] = own[by]
        new = _groups(by, branch, g)
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(open_) else group[open_]
        open_ = open_[_shared(group[open_])]
    return order, group


def _shared(g: np.ndarray) -> np.ndarray:
    """Places whose group has more than one member; groups stand together."""
    same = g[1:] == g[:-1]
    return np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same))) if len(g) else np.zeros(0, dtype=np.int64)


def _leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for shift in range(56, 0, -8):
        out += (x >> np.uint64(shift)) == 0
    return out


def beaten_windows(low: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For contexts with their smallest documents: bits (by distance back from the anchor) of the windows that some
    context with a smaller document also holds."""
    some, own = fold(rows)
    least = np.full(len(some), LAST_ID)
    np.minimum.at(least, own, low)
    near, far = rows[some, _CONTEXT].astype(np.int64), rows[some, _CONTEXT + 1].astype(np.int64)
    sent = np.argsort(own, kind="stable")  # the rows of each context
    ends = np.searchsorted(own[sent], np.arange(len(some)), "right")
    bits = np.zeros(len(rows), dtype=np.uint64)
    for contexts, lo, hi in _slices(rows[some, _BACK : _BACK + GRAM], far - near + 1):
        first_back, last_back = np.maximum(near[contexts], lo), np.minimum(far[contexts], hi)
        n = np.maximum(last_back - first_back + 1, 0)
        body = np.concatenate((rows[some[contexts]].reshape(-1), np.zeros(8, dtype=np.uint8)))
        context = np.repeat(np.arange(len(contexts)), n)
        first = np.cumsum(n) - n
        back = last_back[context] - (np.arange(n.sum()) - first[context])
        order, group = deep_shallow(body, context * _ROW + _BACK - back)
        best = np.full(len(order), LAST_ID)
        np.minimum.at(best, group, least[contexts[context[order]]])
        smallest = np.empty(len(order), dtype=np.int64)
        smallest[order] = best[group]
        # back to every row that was sent
        times = ends[contexts] - np.concatenate(([0], ends))[contexts]
        mine = np.repeat(np.arange(len(contexts)), times)
        row = sent[np.repeat(ends[contexts] - np.cumsum(times), times) + np.arange(times.sum())]
        for k in range(int(n.max()) if len(n) else 0):
            has = n[mine] > k
            w = first[mine[has]] + k
            bits[row[has]] |= (smallest[w] < low[row[has]]).astype(np.uint64) << back[w].astype(np.uint64)
    return bits


def _slices(grams: np.ndarray, windows: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """Contexts with a range of distances between anchor and window, so that equal windows are in one slice: their
    anchors are equal, and so are the distances. A slice has about SLICE windows, or a distance of one anchor."""
    if not len(grams):
        return
    key = np.ascontiguousarray(grams).view(np.uint64).reshape(-1, 2)
    by = np.lexsort((key[:, 1], key[:, 0]))
    new = np.concatenate(([True], (key[by[1:]] != key[by[:-1]]).any(axis=1)))
    heads = np.flatnonzero(new)
    total = np.concatenate(([0], np.cumsum(windows[by])))
    size = total[np.append(heads[1:], len(by))] - total[heads]
    at = 0
    while at < len(heads):
        end = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), SLICE, "right")))
        own = by[heads[at] : heads[end] if end < len(heads) else len(by)]
        step = _BACK + 1 if size[at:end].sum() <= SLICE else max(1, SLICE // len(own))
        for lo in range(0, _BACK + 1, step):
            yield own, lo, min(lo + step - 1, _BACK)
        at = end


# ---------------------------------------------------------------- the steps


def pack_chunks(docs: DataFrame, most: int = CHUNK_BYTES) -> DataFrame:
    def work(batches):
        part, n = TaskContext.get().partitionId(), 0
        ids, texts, total = [], [], 0
        pack = zstandard.ZstdCompressor(level=3).compress

        def row():
            nonlocal n, ids, texts, total
            data = [[(part << 32) + n], [ids], [[len(t) for t in texts]], [pack(b"".join(texts))]]
            n, ids, texts, total = n + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(d, t) for d, t in zip(data, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()), strict=True)], ["chunk", "ids", "lens", "body"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (t or "").encode("utf-8", "replace")
                if texts and total + len(raw) > most:
                    yield row()
                ids.append(i)
                texts.append(raw)
                total += len(raw)
        if texts:
            yield row()

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, "chunk long, ids array<long>, lens array<long>, body binary")


def _answered(table: pa.Table) -> Iterator[tuple[int, list]]:
    yield from zip(table.column("chunk").to_pylist(), table.column("sent").to_pylist(), strict=True)


def _repeated(table: pa.Table) -> pa.Table:
    """Answers which of a part's hashes come from more than one chunk."""
    sent = [(c, np.frombuffer(s, dtype=np.uint64)) for c, s in _answered(table)]
    keys = np.concatenate([k for _, k in sent])
    order = np.argsort(keys)
    s = keys[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(len(keys), dtype=bool)
    hit[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
    ends = np.cumsum([len(k) for _, k in sent])
    bits = [np.packbits(h).tobytes() for h in np.split(hit, ends[:-1])]
    return pa.table({"chunk": pa.array([c for c, _ in sent], pa.int64()), "part": table.column("part"), "answer": pa.array(bits, pa.binary())})


def _sorted(table: pa.Table) -> pa.Table:
    """Answers which windows of a part's contexts a smaller document has."""
    unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
    counts = table.column("n").to_pylist()
    ends = np.cumsum(counts)
    low, rows = np.empty(int(ends[-1]), dtype=np.int64), np.empty((int(ends[-1]), _ROW), dtype=np.uint8)
    for n, end, raw in zip(counts, ends.tolist(), table.column("sent"), strict=True):  # one at a time beside the arrays
        raw = unpack(raw.as_py())
        low[end - n : end] = np.frombuffer(raw, dtype=np.int64, count=n)
        rows[end - n : end] = np.frombuffer(raw, dtype=np.uint8, offset=8 * n).reshape(n, _ROW)
    bits = beaten_windows(low, rows)
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "answer": pa.array([pack(b.tobytes()) for b in np.split(bits, ends[:-1])], pa.binary())})


def kept_and_spans(chunk: Chunk, gone: np.ndarray) -> list[pa.Array]:
    kept, spans, at = [], [], 0
    for n in chunk.lens.tolist():
        own = gone[at : at + n]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).tolist()
        spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        kept.append(chunk.body[at : at + n][~own].tobytes())
        at += n
    return [pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())]


def remove_repeats(docs: DataFrame, emit: Callable = kept_and_spans, schema: str = "spans array<struct<start:bigint,end:bigint>>, kept binary") -> DataFrame:
    """doc_id, the removed spans (bytes) and the remaining bytes of every row, or what `emit` makes of a chunk and its removed bytes."""
    stages = Stages(docs.sparkSession, "suffixes")
    chunks = stages.write(pack_chunks(docs), "chunks")
    total = chunks.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    parts = max(MIN_PARTS, -(-total // PART_BYTES))
    names = [x.split()[0] for x in schema.replace("<start:bigint,end:bigint>", "").split(", ")]

    def ask(batches):
        for batch in batches:
            for c, ids, lens, body in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                rows = list(Chunk(ids, lens, body, parts).asked())
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int64()), pa.array([c] * len(rows), pa.int64()), pa.array([s for _, s in rows], pa.binary())], ["part", "chunk", "sent"])

    def answered(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("chunk").agg(F.collect_list(F.struct("part", "answer")).alias(name))

    def send(batches):
        for batch in batches:
            for c, ids, lens, body, repeated in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                chunk = Chunk(ids, lens, body, parts)
                chunk.follow({a["part"]: a["answer"] for a in repeated or ()})
                rows = list(chunk.contexts())
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([c] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["part", "chunk", "n", "sent"])

    def mark(batches):
        for batch in batches:
            for _, ids, lens, body, repeated, beaten in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                chunk = Chunk(ids, lens, body, parts)
                chunk.follow({a["part"]: a["answer"] for a in repeated or ()})
                gone = chunk.removed({a["part"]: a["answer"] for a in beaten or ()})
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *emit(chunk, gone)], ["doc_id", *names])

    asked = chunks.mapInArrow(ask, "part long, chunk long, sent binary")
    repeated = stages.write(asked.groupBy("part").applyInArrow(_repeated, "chunk long, part long, answer binary"), "repeated")
    follow = chunks.join(answered(repeated, "repeated"), "chunk", "left").select("chunk", "ids", "lens", "body", "repeated")
    sent = follow.mapInArrow(send, "part long, chunk long, n long, sent binary")
    beaten = stages.write(sent.groupBy("part").applyInArrow(_sorted, "chunk long, part long, answer binary"), "beaten")
    marked = follow.join(answered(beaten, "beaten"), "chunk", "left").select("chunk", "ids", "lens", "body", "repeated", "beaten")
    return marked.mapInArrow(mark, f"doc_id long, {schema}")
