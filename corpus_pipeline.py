"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes each stage's result to the shared checkpoint folder and reads
it back, so a lost executor repeats a stage's tasks, never the whole chain.

Nulls: a null text counts as empty and is rejected by the first stage; null
ids and sources pass (see the operators); an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from tessera.llm.common import documents, tuned
from tessera.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    tuned(spark)
    return quality_rules.keep_clean(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand elsewhere already."""
    tuned(spark)
    return line_dedup.drop_repeats(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    tuned(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    benchmark = tuned(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document with its place in the mix of sources."""
    tuned(spark)
    return mixing.mix(docs, mixing.temperature_weights(docs))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The stages read whole texts by hashes, alignments and learned boundaries that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
