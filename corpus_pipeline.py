"""The corpus pipeline: documents to a training mix, in five written stages.

Part of the text operators (``stayflow.llm``). Each stage reads what the one
before has written and returns the columns of ``documents``; the last returns
the mix, with ``epoch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayflow.llm import decontaminate, language_id, mixing, secret_scan, simhash
from stayflow.llm.common import read_table
from stayflow.session import configure, materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts without letters and unsure ones go."""
    return language_id.keep_identified(docs, least_score=0.4)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.deduplicate(docs, shingle=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark covers to less than a twentieth."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), window=13, coverage_pct=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redact(docs, path="source")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left, one row per document and epoch."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: Stages 1 to 4 have no SQL form; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
