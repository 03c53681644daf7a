"""From raw documents to packed sequences: language, lines, near-duplicates, benchmarks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import pipeline
from tidewater.llm.common import durable
from tidewater.sources import load_table

STAGES = [
    ("language_id", pipeline.language_id),
    ("line_dedup", pipeline.line_dedup),
    ("near_dedup", pipeline.near_dedup_stage),
    ("decontamination", pipeline.decontaminate),
    ("packing", pipeline.pack),
]

#: A learnt model, similarity groups and best-fit packing have no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written and read again before the next stage."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
