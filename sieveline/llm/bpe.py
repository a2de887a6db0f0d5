"""BPE encoding and decoding (operator 10), by a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the positions of a piece's bytes; leaf i holds the merge rank of the token at i with the
next token (infinity if they don't merge) and i itself. An inner node holds the smaller of its children, so the root
is the leftmost pair of the lowest rank. A merge changes three leaves, each a logarithmic update of its path to the
root; the piece is done when the root is infinite. Short pieces go through the same tree side by side, one row of an
array each; long pieces go one by one.

Defined cases: null encodes as the empty text (no ids); texts of any length are encoded whole; rows are independent,
so ties and repeated rows give equal rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import pick, text_steps
from sieveline.llm.pieces import Cutter

#: pieces whose ids a worker remembers; a piece longer than ROW bytes is merged by itself
REMEMBERED = 400_000
ROW = 512
#: array cells that a group of short pieces fills at once
CELLS = 1 << 20

_codecs: dict[str, Codec] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    own = set(shown)
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Codec:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], byte_letters()
        self.size = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.none = len(pairs)  # the rank of a pair that doesn't merge
        self.first = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.first_ranks = self.rank(np.repeat(self.first, 256), np.tile(self.first, 256)).reshape(256, 256)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        back = {x: i for i, x in enumerate(letters)}
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[x] for x in token) if all(x in back for x in token) else token.encode()
        self.cutter = Cutter(Tokenizer.from_file(path))
        for content, i in self.cutter.special.items():
            self.bytes_of += [b""] * (i + 1 - len(self.bytes_of))
            self.bytes_of[i] = content.encode()
        self.known: dict[str, bytes] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    # ------------------------------------------------------------ the tree, many short pieces at a time

    def merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of pieces of 1 to `width` bytes; `width` is a power of two."""
        n, levels = len(words), width.bit_length() - 1
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
        length = np.array([len(w) for w in words])
        column = np.arange(width)
        there = column < length[:, None]
        token = np.where(there, self.first[raw], -1)
        following = np.where(column + 1 < length[:, None], column + 1, width)
        previous = np.broadcast_to(column - 1, (n, width)).copy()
        never = self.none * width
        tree = np.full((n, 2 * width), never, dtype=np.int64)
        start = self.first_ranks[raw[:, :-1], raw[:, 1:]] * width + column[:-1]
        tree[:, width : 2 * width - 1] = np.where(there[:, 1:] & (start < never), start, never)
        for level in range(levels - 1, -1, -1):
            lo = 1 << level
            tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
        row = np.flatnonzero(tree[:, 1] < never)
        while len(row):
            rank, at = np.divmod(tree[row, 1], width)
            made = self.merged[rank]
            gone = following[row, at]
            after = following[row, gone]
            token[row, at], token[row, gone], following[row, at] = made, -1, after
            inside = after < width
            previous[row[inside], after[inside]] = at[inside]
            right = np.full(len(row), self.none)
            right[inside] = self.rank(made[inside], token[row[inside], after[inside]])
            before = previous[row, at]
            led = before >= 0
            left = self.rank(token[row[led], before[led]], made[led])
            self._set(tree, row, gone, np.full(len(row), never), levels, width)
            self._set(tree, row, at, np.where(right < self.none, right * width + at, never), levels, width)
            self._set(tree, row[led], before[led], np.where(left < self.none, left * width + before[led], never), levels, width)
            row = row[tree[row, 1] < never]
        kept = token >= 0
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        flat = token[kept].astype("<u4").tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    @staticmethod
    def _set(tree: np.ndarray, row: np.ndarray, leaf: np.ndarray, value: np.ndarray, levels: int, width: int) -> None:
        node = leaf + width
        tree[row, node] = value
        for _ in range(levels):
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    # ------------------------------------------------------------ the tree, one long piece

    def merge_long(self, word: bytes) -> bytes:
        n = len(word)
        width = 1 << max(1, (n - 1).bit_length())
        token = self.first[np.frombuffer(word, dtype=np.uint8)].tolist()
        never, size, rank_of, merged = self.none * width, self.size, self.rank_of, self.merged.tolist()
        tree = np.full(2 * width, never, dtype=np.int64)
        raw = np.frombuffer(word, dtype=np.uint8)
        start = self.first_ranks[raw[:-1], raw[1:]]
        tree[width : width + n - 1] = np.where(start < self.none, start * width + np.arange(n - 1), never)
        lo = width >> 1
        while lo:
            tree[lo : 2 * lo] = np.minimum(tree[2 * lo : 4 * lo : 2], tree[2 * lo + 1 : 4 * lo : 2])
            lo >>= 1
        tree = tree.tolist()
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, value: int) -> None:
            node = leaf + width
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                low = a if a < b else b
                if tree[node] == low:
                    break
                tree[node] = low

        while tree[1] < never:
            rank, at = divmod(tree[1], width)
            made = token[at] = merged[rank]
            gone = following[at]
            after = following[at] = following[gone]
            token[gone] = -1
            put(gone, never)
            value = never
            if after < n:
                previous[after] = at
                if (r := rank_of.get(made * size + token[after])) is not None:
                    value = r * width + at
            put(at, value)
            if (before := previous[at]) >= 0:
                r = rank_of.get(token[before] * size + made)
                put(before, never if r is None else r * width + before)
        return np.array([t for t in token if t >= 0], dtype="<u4").tobytes()

    # ------------------------------------------------------------ texts

    def learn(self, pieces: list[str]) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            if len(raw) == 1:
                self.known[piece] = self.first[raw[0]].astype("<u4").tobytes()
            elif len(raw) > ROW:
                self.known[piece] = self.merge_long(raw)
            else:
                by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, own in by_width.items():
            step = max(1, CELLS // width)
            for k in range(0, len(own), step):
                some = own[k : k + step]
                self.known.update(zip([p for p, _ in some], self.merge_rows([r for _, r in some], width), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        cut = [list(self.cutter.pieces(t)) for t in texts]
        seen = {p for lists in cut for some in lists for p in some}
        special = {p for p in seen if isinstance(p, int)}
        new = [p for p in seen if p not in special and p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = [p for p in seen if p not in special]
        self.learn(new)
        get, once = self.known.__getitem__, {i: np.array([i], dtype="<u4").tobytes() for i in special}
        return [b"".join(b"".join(map(get, some)) if isinstance(some[0], str) else once[some[0]] for some in lists if some) for lists in cut]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def ids_and_text(ids: list[bytes], decoded: list[str]) -> list[pa.Array]:
    flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
    offsets = np.concatenate(([0], np.cumsum([len(i) // 4 for i in ids]))).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(decoded, pa.string())]


def encode_decode(docs: DataFrame, path: str, emit: Callable = ids_and_text, schema: str = "ids array<int>, decoded string") -> DataFrame:
    """doc_id with the ids of every text and the text decoded from them, or what `emit` makes of both in the worker."""
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches):
        own = codec(path)
        for batch in batches:
            at = 0
            for step in text_steps(batch.column(1).to_pylist()):
                ids = own.encode([t or "" for t in step])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(step)), *emit(ids, [own.decode(i) for i in ids])], ["doc_id", *names])
                at += len(step)

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, f"doc_id long, {schema}")
