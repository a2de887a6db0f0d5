"""The registered queries of the language-data operators, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline.llm import bpe, decontaminate, pii, quality, secrets, simhash, sketches, suffixes, token_counts, toxicity
from sieveline.llm.common import table

#: the vocabulary of operators 6 and 10
BYTE_BPE = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.render(F.col("base")), 256).alias("base_sha256"), secrets.render(F.col("spans")).alias("spans"))


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.Rule(words=4, budget=4))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: for the registered queries alone, where the session sets no key: anyone who reads this can undo their pseudonyms
DEMONSTRATION_KEY = "demonstration key, not for production"


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get(pii.KEY_SETTING, DEMONSTRATION_KEY)


@query
def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymised(table(spark, sf_dir, "documents"), pii_key(spark))
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", "text", *counts, F.to_json("spans").alias("spans"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), limit=1024)


def bpe_digests(ids: list[bytes], decoded: list[str]) -> list[pa.Array]:
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array([sha(d.encode()) for d in decoded], pa.string())]


def removal_digests(chunk: suffixes.Chunk, gone: np.ndarray) -> list[pa.Array]:
    ends = np.cumsum(chunk.lens)
    starts = ends - chunk.lens
    fresh = gone & ~np.concatenate(([False], gone[:-1]))  # a span begins
    at = starts[chunk.lens > 0]
    fresh[at] = gone[at]  # also where the document before ends in a removed byte
    before = np.concatenate(([0], np.cumsum(gone)))
    spans = np.concatenate(([0], np.cumsum(fresh)))
    kept = [hashlib.sha256(chunk.body[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return [pa.array(chunk.lens), pa.array(before[ends] - before[starts]), pa.array(spans[ends] - spans[starts]), pa.array(kept, pa.string())]


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), removal_digests, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.3)


@query
def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_rows(table(spark, sf_dir, "documents"))


def op9_rows(docs: DataFrame) -> DataFrame:
    rows = sketches.compared(docs)
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        sketches.fingerprint(own).alias("fingerprint"),
        sketches.fingerprint(edited).alias("edited_fingerprint"),
        sketches.jaccard(own, edited, F.col("text") == F.col("edited")).alias("near_edited"),
        sketches.jaccard(own, following, F.col("text") == F.col("next_text")).alias("near_next"),
        sketches.containment(own, edited, F.col("text") == F.col("edited")).alias("held_by_edited"),
        sketches.containment(own, following, F.col("text") == F.col("next_text")).alias("held_by_next"),
    )


@query
def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), bpe_digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")
