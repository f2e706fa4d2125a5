"""Corpus pipeline: documents -> rules -> exact dedup -> near dedup -> mixing -> packing.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` with the
rows its predecessor kept and returns the columns of ``documents`` (the last one returns
packed pieces). Between stages the rows are written to the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from effdated.llm import exact_dedup, mixing, packing, quality_rules, simhash
from effdated.llm.common import read, shared_table
from effdated.llm.registry import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the rules reject go."""
    return quality_rules.drop_rejected(docs, read(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near copies the row with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


#: Share of the mixture's tokens that may come from toxic texts.
TOXIC_SHARE = 0.02


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: thin out toxic texts to their target share. No text is repeated
    (rates are at most 1) and the clean tokens set the budget: the share of toxic texts is
    an upper bound only. Documents stay if their label is clean or they are no likelier toxic."""
    labels = mixing.label_domains(read(spark, sf_dir, "labels"))
    targets = {"clean": 1 - TOXIC_SHARE, "toxic": TOXIC_SHARE}
    return mixing.take_mixture(docs, labels, targets, max_rate=1.0, keep="clean")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row per packed piece."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", keep_quality),
    ("exact_dedup", keep_one_copy),
    ("simhash", keep_one_near_copy),
    ("mixing", mix_domains),
    ("packing", pack),
]

#: Components and packing have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
