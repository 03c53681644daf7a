"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import durable, spread

#: Orders of the n-grams, and buckets of each order.
ORDERS = (1, 2, 3)
BUCKET_BITS = 15
#: Expected number of labelled rows to learn a language from; more are thinned by a hash of the id.
TRAINING_ROWS = 2_500
#: Languages of one matrix, at 0.4 MB each: what a pass may broadcast. More languages take more passes.
LANGUAGES_AT_ONCE = 400
SMOOTHING = 0.5
UNKNOWN = "und"

_CHUNK = 1 << 19
#: Tables of counts that a counting task holds, and log probabilities that a scoring task looks up at once.
_TABLES, _LOOKUPS = 64, 1 << 22
_FACTORS = spread(np.arange(1, 1 + max(ORDERS), dtype=np.uint64)) | np.uint64(1)


def held_out(id: str | Column) -> Column:
    """Rows whose CRC-32 of the id as text is divisible by 5; a null id is not held out."""
    remainder = F.crc32(F.col(id).cast("string").cast("binary")) % 5 if isinstance(id, str) else F.crc32(id.cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def grams(texts: list[str]):
    """(bounds, buckets) per order for lower-cased texts: ``buckets[bounds[i]:bounds[i + 1]]`` belongs to text ``i``."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    for at, order in enumerate(ORDERS):
        total = np.zeros(max(len(codes) - order + 1, 0), np.uint64)
        for k in range(order):
            total += (codes[k : k + len(total)] + np.uint64(1)) * _FACTORS[k]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        buckets = (total >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + (at << BUCKET_BITS)
        usable = np.maximum(lengths - order + 1, 0)
        inside = np.ones(len(total), bool)
        for k in range(1, order):  # grams that run over the end of a text
            over = starts[1:] - k
            inside[over[(over >= 0) & (over < len(total))]] = False
        yield np.append(0, np.cumsum(usable)), buckets[inside]


def _chunked(texts: list[str]):
    first, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield first, texts[first:k]
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def _count(batches):
    width = len(ORDERS) << BUCKET_BITS
    counts: dict[str, np.ndarray] = {}

    def counted():
        for lang, table in counts.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(table[used])], ["lang", "bucket", "n"])
        counts.clear()

    for batch in batches:
        langs = batch.column(1).to_pylist()
        for first, texts in _chunked([t.lower() for t in batch.column(0).to_pylist()]):
            for bounds, buckets in grams(texts):
                for k in range(len(texts)):
                    lang = langs[first + k]
                    if lang not in counts:
                        if len(counts) == _TABLES:
                            yield from counted()
                        counts[lang] = np.zeros(width, np.int64)
                    counts[lang] += np.bincount(buckets[bounds[k] : bounds[k + 1]], minlength=width)
    yield from counted()


def _column(rows: pd.DataFrame) -> pd.DataFrame:
    """Log probabilities of one language, from its count in every bucket used."""
    counts = np.zeros((len(ORDERS), 1 << BUCKET_BITS))
    counts.reshape(-1)[rows["bucket"].dropna().astype(np.int64)] = rows["n"].dropna()
    smooth = counts + SMOOTHING
    column = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "rows": rows["rows"].iloc[:1], "column": [column.tobytes()]})


class Block:
    """Log probabilities of some languages: one row per bucket, one column per language."""

    def __init__(self, langs: list[str], table: np.ndarray, prior: np.ndarray):
        self.langs, self.table, self.prior = langs, table, prior

    def scores(self, texts: list[str]) -> np.ndarray:
        """Joint log probabilities up to a term that all languages share, a row per text."""
        out = np.tile(self.prior, (len(texts), 1))
        step = max(1, _LOOKUPS // len(self.langs))
        for bounds, buckets in grams(texts):
            for start in range(0, len(buckets), step):
                inside = np.clip(bounds, start, start + step) - start
                some = np.flatnonzero(np.diff(inside))
                out[some] += np.add.reduceat(self.table[buckets[start : start + step]], inside[:-1][some], axis=0, dtype=np.float64)
        return out


class Model:
    """What was learnt: a written table with one row (name, labelled rows, log probabilities) per language."""

    def __init__(self, columns: DataFrame):
        self.columns = columns

    @property
    def langs(self) -> list[str]:
        return [r[0] for r in self.columns.select("lang").orderBy("lang").collect()]

    def blocks(self) -> Iterator[Block]:
        """All languages by name, ``LANGUAGES_AT_ONCE`` together; one block at a time is on the driver."""
        names: list[str] = []
        table: list[np.ndarray] = []
        prior: list[int] = []
        for name, rows, column in self.columns.orderBy("lang").toLocalIterator():
            names.append(name)
            prior.append(rows)
            table.append(np.frombuffer(column, np.float32))
            if len(names) == LANGUAGES_AT_ONCE:
                yield Block(names, np.stack(table, axis=1), np.log(prior))
                names, table, prior = [], [], []
        if names:
            yield Block(names, np.stack(table, axis=1), np.log(prior))


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAINING_ROWS) -> Model:
    """Learn from rows with id, text and language that are not held out; whole texts.

    A language with more than ``rows`` rows is learnt from about ``rows`` of them, any other from all, so every labelled language is
    learnt at every size of the table. Priors count all labelled rows. Repeated rows count as often as they occur; a text may be
    empty or of any length. Without labelled rows the model has no language. Counting and smoothing run on the executors.
    """
    known = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    totals = durable(known.groupBy("lang").agg(F.count("*").alias("rows")), "languages")  # small and of known size when it is joined
    chosen = known.join(totals, "lang").where(F.pmod(F.xxhash64(F.lit("language"), "id"), "rows") < rows)
    counts = chosen.select("text", "lang").mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    columns = totals.join(counts, "lang", "left").groupBy("lang").applyInPandas(_column, "lang string, rows long, column binary")
    return Model(durable(columns, "log-probabilities"))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior probability) added, replacing columns of these names.

    Null texts, texts without a letter, and everything under a model without languages are ``und`` with score 0. Ties go to the
    first language by name. Texts of any length are read whole, repeated rows judged alike.

    Every ``LANGUAGES_AT_ONCE`` languages are one pass over the documents; the best language so far, its log probability and
    the sum of all probabilities relative to it are handed on.
    """
    docs = docs.drop("lang_pred", "score")
    out = docs
    for number, block in enumerate(model.blocks()):
        if number:
            out = durable(out, "language")
        shared = docs.sparkSession.sparkContext.broadcast(block)
        kind = T.StructType([*docs.schema.fields, *_SO_FAR.fields])
        out = out.mapInArrow(_scorer(shared, text, docs.columns, number == 0), kind)
    if out is docs:
        out = docs.withColumns({"_lang": F.lit(None).cast("string"), "_mass": F.lit(None).cast("double")})
    known = F.col("_lang").isNotNull()
    return out.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.when(known, F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, 1 / F.col("_mass")).otherwise(0.0).alias("score"),
    )


_SO_FAR = T.StructType().add("_lang", T.StringType()).add("_best", T.DoubleType()).add("_mass", T.DoubleType())


def _scorer(shared, text: str, names: list[str], first_pass: bool):
    def run(batches):
        block = shared.value
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(text)).to_pylist()
            if first_pass:
                langs, best, mass = [None] * len(values), np.full(len(values), -np.inf), np.zeros(len(values))
            else:
                langs, best, mass = (batch.column(len(names) + k).to_pylist() for k in range(3))
                best, mass = np.array(best), np.array(mass)
            lettered = np.array([k for k, t in enumerate(values) if t and any(map(str.isalpha, t))], np.int64)
            for first, texts in _chunked([values[k].lower() for k in lettered]):
                at = lettered[first : first + len(texts)]
                joint = block.scores(texts)
                top = joint.max(axis=1)
                for k in np.flatnonzero(top > best[at]):
                    langs[at[k]] = block.langs[joint[k].argmax()]
                most = np.maximum(top, best[at])
                mass[at] = mass[at] * np.exp(best[at] - most) + np.exp(joint - most[:, None]).sum(axis=1)
                best[at] = most
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(langs, pa.string()), pa.array(best), pa.array(mass)], [*names, *_SO_FAR.names]
            )

    return run
