"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import stages
from eventlake.llm.common import read, save

#: name and function(spark, docs, sf_dir) of each stage, in order.
STAGES = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.dedup_lines),
    ("ngram_jaccard", stages.drop_near_copies),
    ("decontamination", stages.drop_contaminated),
    ("packing", stages.pack_documents),
]

#: Toxicity is a fitted model and packing is an algorithm, which SQL can't express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
