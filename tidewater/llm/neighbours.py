"""Approximate nearest neighbours by inner product over several shifted Hilbert curves.

Each curve projects the vectors on a few random directions, shifts them, and orders the cells along a Hilbert curve. Spark
sorts every order by range; a query meets the rows whose rank is within a window of its own on any curve, and the best
of all curves are reranked by their inner products. The window is measured: a bounded sample of queries is
searched exhaustively, and the window is the least that would have found the wanted share of their neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import durable

NEIGHBOURS = 20
CURVES = 16
#: Directions and bits of each; their product is the length of a key and must stay below 63.
DIRECTIONS, BITS = 12, 5
#: Rows that tell means and spreads, queries that tell the window, and the share of neighbours it must reach.
FIT_ROWS = 4_000
PROBES = 100
REACHED = 0.96
#: Ranks that are scored in one task.
SEGMENT = 4096
#: Queries of a segment that are scored in one task, about.
BLOCK = 16_384
_QUERIES_AT_ONCE = 256
_SEED = 7


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of points with ``bits`` bits in every dimension (a row per point)."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations from the coarsest level on
        below = (1 << level) - 1
        for d in range(dims):
            set_here = (x[d] >> level) & 1 == 1
            exchange = np.where(set_here, 0, (x[0] ^ x[d]) & below)
            x[0] = np.where(set_here, x[0] ^ below, x[0] ^ exchange)
            x[d] ^= exchange
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= parity
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> level) & 1)
    return key


class Curves:
    """Projections, shifts and scales of all curves."""

    def __init__(self, sample: np.ndarray):
        size = sample.shape[1]
        random = np.random.Generator(np.random.PCG64(_SEED))
        use = min(DIRECTIONS, size)
        self.turns = []
        for _ in range(CURVES):
            turn, _ = np.linalg.qr(random.standard_normal((size, use)))
            spot = sample @ turn
            spread = spot.std(axis=0)
            self.turns.append((turn, spot.mean(axis=0), np.where(spread > 0, spread, 1.0), random.normal(0, 0.25, use)))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One key per curve (row) and vector (column)."""
        out = []
        for turn, mean, spread, shift in self.turns:
            level = 1 / (1 + np.exp(-1.702 * np.clip((vectors @ turn - mean) / spread + shift, -40, 40)))
            out.append(hilbert(np.minimum((level * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)))
        return np.array(out).reshape(CURVES, len(vectors))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(table: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, v): non-null ids and vectors without null or non-finite components, not zero, of the commonest length.

    Components keep their type, so that floats are not shuffled as doubles; products are taken in double precision.
    """
    kind = table.schema[vector].dataType
    wanted = "array<float>" if kind == T.ArrayType(T.FloatType(), kind.containsNull) else "array<double>"
    rows = table.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast(wanted).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def _keyed(shared):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = shared.value.keys(_vectors(batch.column(1)))
                for curve in range(CURVES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(batch.num_rows, curve, np.int32)), pa.array(keys[curve]), *batch.columns], ["curve", "key", "vec_id", "v"]
                    )

    return run


def _numbered(batches):
    part, seen = TaskContext.get().partitionId(), np.zeros(CURVES, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        curve = batch.column(0).to_numpy()
        local = np.zeros(len(curve), np.int64)
        for c in np.unique(curve):
            mine = np.flatnonzero(curve == c)
            local[mine] = seen[c] + np.arange(len(mine))
            seen[c] += len(mine)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array(np.full(len(curve), part)), pa.array(local)],
            ["curve", "vec_id", "v", "part", "local"],
        )


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest finite scores, ties to the smaller id."""
    places = np.flatnonzero(scores > -np.inf)
    if len(places) > k:
        least = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= least]
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def best_exact(scores: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, longest: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the ``k`` rows with the largest inner products.

    ``scores`` come from a matrix product, whose sums may be added up in another order: rows within the rounding error of the ``k``-th,
    relative to the lengths of the query and the ``longest`` row, are summed up again, each in the order of its own components.
    """
    places = np.flatnonzero(scores > -np.inf)
    if len(places) > k:
        least = np.partition(scores[places], len(places) - k)[len(places) - k]
        error = 4 * len(query) * np.finfo(float).eps * np.linalg.norm(query) * longest
        places = places[scores[places] >= least - error]
    exact = (vectors[places] * query).sum(axis=1)
    chosen = best(exact, ids[places], k)
    return places[chosen], exact[chosen]


def _exact(shared, k: int):
    """Best rows of each probe among a task's rows."""

    def run(batches):
        ids, probes = shared.value
        kept_ids = [np.zeros(0, np.int64)] * len(ids)
        kept = [np.zeros(0)] * len(ids)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            vectors = _vectors(batch.column(1))
            longest = np.linalg.norm(vectors, axis=1).max()
            scores = probes @ vectors.T
            for q in range(len(ids)):
                s = np.where(own == ids[q], -np.inf, scores[q])
                chosen, exact = best_exact(s, own, vectors, probes[q], longest, k)
                all_ids, all_scores = np.append(kept_ids[q], own[chosen]), np.append(kept[q], exact)
                again = best(all_scores, all_ids, k)
                kept_ids[q], kept[q] = all_ids[again], all_scores[again]
        sizes = [len(x) for x in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate(kept_ids)), pa.array(np.concatenate(kept))], ["query_id", "vec_id", "score"]
        )

    return run


def _scored(window: int, k: int):
    empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return pa.table(empty)
        take = lambda table, name: table.column(name).combine_chunks()
        ids, ranks = take(rows, "vec_id").to_numpy(), take(rows, "rank").to_numpy()
        vectors = _vectors(take(rows, "v"))
        query_ids, query_ranks = take(queries, "vec_id").to_numpy(), take(queries, "rank").to_numpy()
        query_vectors = _vectors(take(queries, "v"))
        longest = np.linalg.norm(vectors, axis=1).max()
        out = []
        for a in range(0, len(query_ids), _QUERIES_AT_ONCE):
            z = slice(a, a + _QUERIES_AT_ONCE)
            scores = query_vectors[z] @ vectors.T
            outside = np.abs(ranks[None, :] - query_ranks[z, None]) > window
            scores[outside | (ids[None, :] == query_ids[z, None])] = -np.inf
            for q, row in enumerate(scores):
                chosen, exact = best_exact(row, ids, vectors, query_vectors[a + q], longest, k)
                out.append((np.full(len(chosen), query_ids[a + q]), ids[chosen], exact))
        return pa.table({name: pa.array(np.concatenate(x)) for name, x in zip(empty, zip(*out))})

    return run


def nearest(table: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest rows found, from rank 1.

    Queries are the rows whose id is divisible by ``every``; all other rows with usable vectors are candidates. The score
    is the inner product of the original vectors in double precision; ties go to the smaller id. Null ids and null, zero,
    non-finite or odd-sized vectors take no part. Rows that share an id count once, with the greatest vector. With
    fewer candidates than ``k`` all are returned; an empty table gives an empty table.

    Equal vectors are searched once: of a vector's ids only the ``k + 1`` smallest can be among anyone's nearest.
    """
    spark = table.sparkSession
    unique = durable(usable(table, id, vector).groupBy("vec_id").agg(F.max("v").alias("v")), "vectors")
    kind = unique.schema["v"].dataType.simpleString()
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    listed = unique.withColumn("n", smallest).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    rows = durable(listed.select(F.col("ids")[0].alias("vec_id"), "v", "ids"), "distinct-vectors")
    asking = unique.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    asking = durable(asking.join(rows.select(F.col("vec_id").alias("own"), "v"), "v").select("query_id", "own"), "queries")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.where(F.pmod(F.xxhash64(F.lit("fit"), "vec_id"), F.lit(total)) < FIT_ROWS).limit(2 * FIT_ROWS)
    fit = [r[0] for r in sample.select("v").collect()] or [rows.first()["v"]]
    curves = spark.sparkContext.broadcast(Curves(np.array(fit, float)))
    keyed = rows.select("vec_id", "v").mapInArrow(_keyed(curves), f"curve int, key long, vec_id long, v {kind}")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = durable(
        keyed.repartitionByRange(parts, "curve", "key", "vec_id")
        .sortWithinPartitions("curve", "key", "vec_id")
        .mapInArrow(_numbered, f"curve int, vec_id long, v {kind}, part long, local long"),
        "curves",
    )
    # A range part holds a stretch of the curves one after the other, so there are at most ``parts + CURVES`` counts.
    counts = numbered.groupBy("curve", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = numbered.join(F.broadcast(offsets), ["curve", "part"]).select("curve", "vec_id", "v", (F.col("local") + F.col("earlier")).alias("rank"))

    searching = durable(asking.select(F.col("own").alias("vec_id")).distinct(), "searching")
    window = _window(spark, rows, searching, ranked, k, total)
    last = F.lit((total - 1) // SEGMENT)
    reach = F.sequence(F.greatest(F.floor((F.col("rank") - window) / SEGMENT), F.lit(0)), F.least(F.floor((F.col("rank") + window) / SEGMENT), last))
    asked = ranked.join(searching, "vec_id", "left_semi").withColumn("segment", F.explode(reach))
    held = ranked.select(*(F.col(c).alias(c) for c in ("curve", "vec_id", "v", "rank"))).withColumn("segment", F.floor(F.col("rank") / SEGMENT))
    # A window that is a share of the rows brings ever more queries to a segment: they are dealt over blocks, each with the segment's rows.
    blocks = max(1, -(-(2 * window + SEGMENT) * searching.count() // (total * BLOCK)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)).cast("int"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        asked.alias("asked").groupBy("curve", "segment", "block")
        .cogroup(held.alias("held").groupBy("curve", "segment", "block"))
        .applyInArrow(_scored(window, k), "query_id long, vec_id long, score double")
    )
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    merged = merged.withColumn("place", _place("query_id")).where(F.col("place") <= k).drop("place")
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    itself = rows.join(searching, "vec_id", "left_semi").where(F.size("ids") > 1).select(F.col("vec_id").alias("query_id"), "vec_id", square.alias("score"))
    copies = rows.select("vec_id", F.explode("ids").alias("id"))
    expanded = merged.union(itself).join(copies, "vec_id").select(F.col("query_id").alias("own"), F.col("id").alias("vec_id"), "score")
    expanded = durable(expanded.withColumn("place", _place("own")).where(F.col("place") <= k + 1).drop("place"), "found")
    answers = asking.join(expanded, "own").where("vec_id != query_id").withColumn("rank", _place("query_id"))
    return answers.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _place(group: str):
    return F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), "vec_id"))


def _window(spark, rows: DataFrame, searching: DataFrame, ranked: DataFrame, k: int, total: int) -> int:
    """The ranks to look at on either side, from the exact neighbours of at most ``PROBES`` queries."""
    chosen = searching.orderBy(F.xxhash64(F.lit("probe"), "vec_id"), "vec_id").limit(PROBES)
    probes = rows.join(F.broadcast(chosen), "vec_id").select("vec_id", "v").collect()
    if not probes:
        return 0
    shared = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in probes]), np.array([r["v"] for r in probes], float)))
    truth = rows.select("vec_id", "v").mapInArrow(_exact(shared, k), "query_id long, vec_id long, score double")
    truth = durable(truth.withColumn("place", _place("query_id")).where(F.col("place") <= k).select("query_id", "vec_id"), "truth")
    wanted = truth.select("vec_id").union(truth.select("query_id")).distinct()  # at most PROBES * (k + 1) ids
    spots = durable(ranked.select("curve", "vec_id", "rank").join(F.broadcast(wanted), "vec_id"), "spots")
    own = spots.select(F.col("vec_id").alias("query_id"), "curve", F.col("rank").alias("own"))
    gaps = (
        truth.join(spots, "vec_id").join(own, ["query_id", "curve"])
        .groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("rank") - F.col("own"))).alias("gap"))
    )
    distances = sorted(r["gap"] for r in gaps.select("gap").collect())  # at most PROBES * k numbers
    if not distances:
        return total
    return int(distances[min(len(distances) - 1, int(REACHED * len(distances)))] * 1.1) + 1
