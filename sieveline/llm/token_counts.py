"""Token counts (operator 6): the tokenizer library encodes batches inside Arrow functions; only lengths come back.

A task takes its texts in steps of about equal bytes, cuts each text at the boundaries that the encoder never
crosses, and lets the library encode every distinct cut piece of a step once, again in batches of equal bytes. A
worker keeps the lengths of pieces it has seen in a table of bounded size, so repeated text costs a look-up.

Defined cases: null counts as empty (0 bytes, 0 tokens); texts of any length are counted whole; rows are
independent, so ties and repeated rows give equal rows; an empty table gives an empty result; other columns are not
read. The strings of special tokens inside a text count as the library's default has it: one token each.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import by_bytes, pick, text_steps
from sieveline.llm.pieces import Cutter

#: bytes of pieces that the library gets at once, and pieces whose lengths a worker remembers
ENCODE_BYTES = 1 << 18
REMEMBERED = 400_000

_counters: dict[str, Counter] = {}


class Counter:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.cutter, self.known = Cutter(self.tokenizer), {}

    def _learn(self, pieces) -> None:
        if len(self.known) + len(pieces) > REMEMBERED:
            self.known.clear()
        for some in by_bytes(pieces, lambda p: len(p) + 8, ENCODE_BYTES):
            for piece, e in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                self.known[piece] = len(e)

    def counts(self, texts: list[str]) -> list[int]:
        cut = [list(self.cutter.pieces(t)) for t in texts]
        seen = {p for lists in cut for some in lists for p in some}
        special = {p for p in seen if isinstance(p, int)}
        new = [p for p in seen if p not in self.known and p not in special]
        if len(self.known) + len(new) > REMEMBERED:
            new = [p for p in seen if p not in special]  # the table starts anew
        self._learn(new)
        one = dict.fromkeys(special, 1)
        get = self.known.__getitem__
        return [sum(sum(map(get, some)) if not one or isinstance(some[0], str) else 1 for some in lists if some) for lists in cut]


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row; `path` is the tokenizer's file."""

    def work(batches):
        own = counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_tokens = [n for step in text_steps(texts) for n in own.counts([t or "" for t in step])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("n_bytes"))
    return rows.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
