"""One registered query per operator, over whole tables, and the SQL counterparts where SQL can ask the question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    alignment,
    conversations,
    decontamination,
    language,
    licenses,
    lines,
    near_dedup,
    neighbours,
    packing,
    pages,
    repeats,
    sharding,
    token_counts,
)
from tidewater.llm.common import durable
from tidewater.session import ship_package
from tidewater.sources import load_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


@register
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text")
    marked = decontamination.mark_hits(docs, load_table(spark, folder, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.col("item_list"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(load_table(spark, folder, "documents"), width=4)


@register
def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(load_table(spark, folder, "documents")).drop("spans")


@register
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(load_table(spark, folder, "documents"))


@register
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents")
    model = language.train(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@register
def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    table = load_table(spark, folder, "pages").select("page_id", "url", "html")
    return pages.extract(table)


@register
def op8_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "source", "text")
    cleaned = lines.remove_boilerplate(docs)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"), F.length("text").cast("long").alias("n_chars"))


ORACLES["op8_lines"] = f"""
with parts as (
    select doc_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
    from documents where text is not null
), spread as (
    select trim(line) as line from parts where trim(line) <> '' group by trim(line)
    having count(distinct source) >= {lines.SITES}
), judged as (
    select p.doc_id, p.line, p.pos, s.line is not null as bad from parts p left join spread s on trim(p.line) = s.line
), rebuilt as (
    select doc_id, count(*) as n_lines, count(*) filter (bad) as n_removed,
        coalesce(string_agg(line, chr(10) order by pos) filter (not bad), '') as text
    from judged group by doc_id
)
select d.doc_id, coalesce(r.n_lines, 0) as n_lines, coalesce(r.n_removed, 0) as n_removed,
    md5(r.text) as kept_md5, length(r.text) as n_chars
from documents d left join rebuilt r on d.doc_id = r.doc_id
"""


@register
def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(load_table(spark, folder, "embeddings"))


@register
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_words", "n_tokens", "n_unknown")


@register
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "n_blocks", "n_exact", "licenses")


@register
def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_texts(load_table(spark, folder, "documents"), ["doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@register
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = load_table(spark, folder, "documents").select("doc_id", "text")
    aligned = durable(alignment.align_digests(docs), "alignment-digest")
    return alignment.score(aligned, alignment.pair_counts(aligned)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@register
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(rows, *conversations.repair(conversations.damage(rows)))
