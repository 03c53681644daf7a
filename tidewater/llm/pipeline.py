"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of ``docs``. Null texts never reach the second stage: the first rejects them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontamination, language, lines, near_dedup, packing
from tidewater.llm.common import durable
from tidewater.session import ship_package
from tidewater.sources import load_table

#: A prediction of less probability than this is no language.
SURE = 0.5


def _columns(docs: DataFrame):
    return [F.col(f"`{c}`") for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are in one of the languages learnt from the labelled rows of ``docs``."""
    ship_package(spark)
    found = language.identify(docs.withColumnsRenamed({"score": "_score", "lang_pred": "_lang_pred"}), language.train(docs))
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= SURE)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({"_score": "score", "_lang_pred": "lang_pred"})


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out of the texts; ``n_chars`` follows. Documents stay, even with an empty text.

    Lines that spread only with copies of one text stay: the next stage keeps one of the copies.
    """
    ship_package(spark)
    names = docs.columns
    cleaned = lines.remove_boilerplate(docs, merge_copies=True)
    return cleaned.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in names))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the least id of every group of near-duplicates, one row where ids repeat."""
    ship_package(spark)
    rows = durable(docs.withColumn("_row", F.struct(F.col("doc_id"), F.monotonically_increasing_id().alias("at"))), "rows")
    kept = near_dedup.near_duplicates(rows, id="_row").where("kept").select(F.col("doc_id").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*_columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no benchmark window occurs."""
    ship_package(spark)
    return decontamination.decontaminated(docs, load_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    ship_package(spark)
    return packing.pack(docs)
