"""Corpus pipeline over documents: each stage calls one operator; stages are written and read again."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltworks.llm import exact_dedup, packing, quality_rules, simhash, suffix_dedup  # noqa: E402
from siltworks.llm.common import documents, one_per_group, stored, without  # noqa: E402
from siltworks.llm.queries import BYTE_BPE  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return without(docs, quality_rules.judge(docs).filter(~F.col("kept")), "text", "source")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: of the rows with the smallest doc_id, or with none if no row
    has one, the text with the least row key, and one of its repeats."""
    return one_per_group(docs, exact_dedup.dedupe(docs).filter("NOT kept OR group_size > 1"), "text_sha256")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near fingerprints, chosen in the same way: texts may share a doc_id."""
    found = simhash.near_duplicates(docs)
    return one_per_group(docs, found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "root")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages. What a cut leaves of a character goes as well, and
    texts of which no word is left. A null text comes out empty."""
    found = suffix_dedup.remove_repeats(docs, with_left=True)
    cut = F.col("n_spans") > 0
    found = found.withColumn("text", F.col("left")).filter(~cut | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("text"), "n_chars": F.when(cut, F.length("text").cast("bigint")).otherwise(F.col("own.n_chars"))}
    return found.select(*[changed[c].alias(c) if c in changed else F.col("own").getField(c).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences. The encoder shares an executor's memory with what earlier stages have left there."""
    return packing.query(docs, BYTE_BPE, end_id=0, room=40_000_000)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("suffix-array dedup", passages),
    ("packing", packed),
]

# Fingerprints, hosts' priors after earlier stages and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
