"""The corpus pipeline: five stages over table documents, each an operator of riskframe.llm.

1. quality rules: documents whose posterior probability of being good is low go;
2. line dedup: lines that at least three documents hold stay in one of them;
3. MinHash near-dedup (five-word shingles, similarity 0.8): one document of each group stays;
4. benchmark decontamination: contaminated documents go;
5. byte-level BPE: every remaining text is encoded to ids and decoded again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Stages 1 to 4
return the columns of documents; stage 5 returns doc_id, n_tokens, ids_sha256
and decoded_sha256. n_chars of documents follows the text where lines went.

Defined results: rows that all stages keep keep their doc_id, null included; a
null text has no words and goes in stage 1; an empty table passes empty.
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskframe.llm import bpe, decontaminate, line_dedup, neardup, quality  # noqa: E402
from riskframe.llm.common import table, written  # noqa: E402
from riskframe.session import ship_package  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-supervision model takes for good."""
    ship_package(spark)
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that others repeat."""
    ship_package(spark)
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return neardup.keep_one(docs, words=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, digested, and the digest of what the ids decode to."""
    ship_package(spark)
    return bpe.digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte-level BPE", bpe_encoding),
]

#: Two stages (estimated posteriors, BPE merges) have no SQL form; tests compare run() with plain definitions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
