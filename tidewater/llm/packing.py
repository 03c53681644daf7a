"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents of equal length tie in a best fit, so documents and gaps are handled as classes of equal size: at most
``SEQUENCE`` of them, whatever the input. A superstep takes the longest class not yet placed, sweeps the gaps upwards from its
length (the successor first), lets ranks decide which document takes which gap of a class, updates the gaps and goes on.
Ranks within a class are counted in two levels over all partitions; placing the documents by rank is one map.
"""

from __future__ import annotations

import base64
import functools
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import durable

SEQUENCE = 2048
SEPARATOR = 0
END_OF_TEXT = "<|endoftext|>"


@functools.cache
def encoder(vocabulary: str | None = None):
    """A function from text to ids, equal to ``tokenizers`` with the byte-level vocabulary and without added tokens.

    The ranks of the same vocabulary are encoded by tiktoken, which is several times faster; texts that contain the name
    of the special token go to ``tokenizers`` itself. ``vocabulary``: path without ending; None: the installed files.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    place = (lambda ending: f"{vocabulary}{ending}") if vocabulary else (lambda ending: public_tokenizers.path(f"byte_bpe_50k{ending}"))
    with open(place(".tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(place(".json"))

    def encode(text: str) -> list[int]:
        if END_OF_TEXT in text:
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def _pieces(length: int, vocabulary: str | None):
    def run(batches):
        encode, seen = encoder(vocabulary), Counter()
        part = TaskContext.get().partitionId()
        for batch in batches:
            owner, rows = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), SEPARATOR], np.uint32)
                begin, end = 0, len(ids) % length or length
                while begin < len(ids):
                    size = end - begin
                    owner.append(k)
                    rows.append((len(rows), begin, size, zlib.crc32(ids[begin:end].astype("<u4").tobytes()), seen[size]))
                    seen[size] += 1
                    begin, end = end, end + length
            owner = np.array(owner, np.int64)
            table = np.array(rows, np.int64).reshape(-1, 5)
            first = np.searchsorted(owner, owner, "left")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array((np.arange(len(owner)) - first).astype(np.int32))]
                + [pa.array(table[:, k]) for k in range(1, 5)]
                + [pa.array(np.full(len(owner), part))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "local", "part"],
            )

    return run


def best_fit(counts: dict[int, int], length: int = SEQUENCE) -> dict[int, np.ndarray]:
    """For each class the rows (first rank, first sequence, offset, documents per sequence), in order of rank.

    The document of rank r in a class takes place (r - first rank) of its row: sequences fill one after the other.
    ``gaps`` maps a gap to blocks of consecutive sequences that have it; a class splits at most one block and opens two, so
    blocks stay below three for each class.
    """
    plan: dict[int, list[tuple]] = defaultdict(list)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    sizes: list[int] = []
    sequences = 0

    def offer(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((first, n))

    def place(size: int, rank: int, left: int, gap: int, first: int, n: int) -> int:
        """Put up to ``left`` documents into ``n`` sequences with this gap; returns how many."""
        each = gap // size
        taken = min(left, n * each)
        plan[size].append((rank, first, length - gap, each))
        full, rest = divmod(taken, each)
        offer(gap - each * size, first, full)
        if rest:
            offer(gap - rest * size, first + full, 1)
        used = full + bool(rest)
        offer(gap, first + used, n - used)
        return taken

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(sizes, size)
            if at == len(sizes):
                break
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                sizes.pop(at)
            taken = place(size, rank, left, gap, first, n)
            rank, left = rank + taken, left - taken
        if left:
            opened = -(-left // (length // size))
            place(size, rank, left, length, sequences, opened)
            sequences += opened
    return {size: np.array(rows, np.int64) for size, rows in plan.items()}


def _placed(shared):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            size, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for value in np.unique(size):
                rows, of = shared.value[int(value)], size == value
                row = rows[np.searchsorted(rows[:, 0], rank[of], "right") - 1]
                step, place = np.divmod(rank[of] - row[:, 0], row[:, 3])
                sequence[of], offset[of] = row[:, 1] + step, row[:, 2] + place * value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    return run


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = SEQUENCE, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A document is its ids and a closing 0; a null or empty text is the 0 alone. Longer documents than ``length`` are cut so
    that only the first piece may be shorter. Repeated rows are packed as often as they occur. Sequences are numbered from 0 and
    filled without holes; an empty table gives an empty table.
    """
    kind = T.StructType().add("doc_id", docs.schema[id].dataType).add("piece", T.IntegerType())
    for name in ("start", "length", "ids_crc32", "local", "part"):
        kind = kind.add(name, T.LongType())
    pieces = durable(docs.select(F.col(id), F.col(text)).mapInArrow(_pieces(length, vocabulary), kind), "pieces")
    counts = durable(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``length`` rows
    shared = docs.sparkSession.sparkContext.broadcast(best_fit(histogram, length))
    ranked = pieces.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("local") + F.col("earlier")).alias("rank")
    )
    out = T.StructType(kind.fields[:5]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    return ranked.mapInArrow(_placed(shared), out)
