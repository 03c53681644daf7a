"""Removal of boilerplate lines by the number of distinct sites that carry them.

HyperLogLog sketches of the sites are merged for each line. Lines whose estimate is near the threshold get an exact count;
the others are far enough from it to be decided by the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import discard, durable
from tidewater.llm.near_dedup import near_duplicates

#: Sites from which on a line is boilerplate.
SITES = 10
#: Logarithm of a sketch's slots: a relative standard error of about 1.6 %.
PRECISION = 12
#: Estimates within this factor of the threshold are counted exactly: more than 20 standard errors away on either side.
NEAR = 1.5


def line_key(line: Column) -> Column:
    return F.trim(line)


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", sites: int = SITES) -> DataFrame:
    """(line): hashes of trimmed, non-empty lines that occur at ``sites`` distinct sites or more. Null sites are no site."""
    lines = (
        docs.where(F.col(site).isNotNull())
        .select(F.col(site).alias("site"), F.explode(F.array_distinct(_keys(F.col(text)))).alias("line"))
    )
    merged = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(PRECISION))).alias("estimate"))
    merged = durable(merged.where(F.col("estimate") * NEAR >= sites), "spread")
    near = merged.where(F.col("estimate") < sites * NEAR).select("line")
    exact = lines.join(near, "line", "left_semi").groupBy("line").agg(F.countDistinct("site").alias("n")).where(F.col("n") >= sites)
    return merged.where(F.col("estimate") >= sites * NEAR).select("line").union(exact.select("line"))


def _keys(text: Column) -> Column:
    """128-bit hashes of the lines that count."""
    trimmed = F.filter(F.transform(F.split(text, "\n"), line_key), lambda line: line != "")
    return F.transform(trimmed, lambda line: F.unhex(F.md5(line)))


def independent(docs: DataFrame, found: DataFrame, text: str = "text", site: str = "source", sites: int = SITES) -> DataFrame:
    """(line): those of ``found`` that ``sites`` or more different texts carry; near-duplicates count as one text.

    The others spread only with copies of a few texts. Texts are near-duplicates as they are for ``near_duplicates``.
    """
    keyed = docs.where(F.col(site).isNotNull()).select(F.unhex(F.md5(F.col(text))).alias("copy"), F.col(text).alias("text"))
    carried = durable(
        keyed.select("copy", F.explode(F.array_distinct(_keys(F.col("text")))).alias("line")).join(found, "line").distinct(), "carried"
    )
    often = durable(carried.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites).select("line"), "often")
    carried_often = durable(carried.join(often, "line"), "carried")
    copies = durable(carried_often.select("copy").distinct(), "copies")
    discard(carried, often)
    near = near_duplicates(keyed.join(copies, "copy", "left_semi"), id="copy")
    groups = durable(near.select(F.col("doc_id").alias("copy"), F.col("component_id").alias("group")).distinct(), "groups")
    discard(copies)
    spread = carried_often.join(groups, "copy").select("line", "group").distinct()
    return spread.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites).select("line")


def remove_boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", sites: int = SITES, merge_copies: bool = False
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; ``n_lines`` and ``n_removed`` are added.

    Lines end at a newline. A line goes wherever it occurs, in every repetition, if its trimmed form is boilerplate;
    the others stay as they are, empty ones included. Null texts stay null with 0 lines. A document of boilerplate
    alone keeps its row with an empty text. Input columns named like the added ones are replaced. With ``merge_copies``
    a line that spread only with copies of a text, exact or near, is no boilerplate (see ``independent``).
    """
    docs = docs.drop("n_lines", "n_removed")
    bad = durable(boilerplate(docs, text, site, sites), "boilerplate")
    if merge_copies:
        bad = durable(independent(docs, bad, text, site, sites), "boilerplate")
    keyed = docs.withColumn("_text", F.unhex(F.md5(F.col(text))))
    carried = keyed.select("_text", F.explode(F.array_distinct(_keys(F.col(text)))).alias("line"))
    # Written, so that the join below sees two plain exchanges and can split the partition of a text with many copies.
    drops = durable(carried.join(bad, "line").groupBy("_text").agg(F.collect_set("line").alias("_drop")), "drops")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(
        lines, lambda line: (line_key(line) == "") | ~F.array_contains(F.col("_drop"), F.unhex(F.md5(line_key(line))))
    )
    joined = keyed.join(drops, "_text", "left").withColumn(
        "_kept", F.when(F.col("_drop").isNull(), lines).otherwise(kept)
    )
    n_lines, n_kept = F.coalesce(F.size(lines), F.lit(0)), F.coalesce(F.size("_kept"), F.lit(0))
    return joined.select(
        *(F.array_join("_kept", "\n").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns),
        F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(F.col(text).isNull(), 0).otherwise(n_lines - n_kept).cast("long").alias("n_removed"),
    )
