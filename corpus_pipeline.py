"""From raw documents to token ids, in five stages; each is written as Parquet and read back as the next one's docs.

A stage takes (spark, docs, sf_dir). All but the last return the columns of docs. The stages work on whole texts and
on all rows that the stage before has kept.

Defined cases: a null text counts as empty for every decision and stays null until it is encoded, as no ids and an empty
text; documents without words are near-duplicates of each other, so one of them stays; rows that repeat another in doc_id
and text stay once, rows of one doc_id with different texts are different documents; a null doc_id loses against any
other id in a group; long texts are worked on whole; without usable labels the classifier rejects nothing, without a
benchmark nothing is contaminated; an empty table gives an empty result; other columns pass through all stages but the
last, and n_chars follows a rewritten text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import bpe, decontaminate, pii, quality, simhash
from sieveline.llm.common import Stages, table
from sieveline.llm.queries import BYTE_BPE, pii_key, tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (shingles of five words, similarity of 0.8 or more)."""
    return simhash.without_near_duplicates(docs, simhash.SIMILAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data in their texts."""
    return pii.rewritten(docs, pii_key(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text, and the text that they decode to."""
    return bpe.encode_decode(docs, tokenizer_file(BYTE_BPE))


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("bpe encoding and decoding", encode),
]

#: SQL has neither the classifier nor the fingerprints nor the permutation; the stages are tested against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
