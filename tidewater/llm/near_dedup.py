"""Near-duplicate groups with SetSketch registers.

Every text becomes a set of word shingles and a SetSketch of it: for each register the least of exponentially
distributed values of the shingles, kept as a truncated logarithm. Sketches merge by the larger register and agree
register by register with about the similarity of the sets. Bands of registers propose pairs, the joint likelihood of the
registers given both set sizes drops the hopeless ones, and the full sets decide.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import VISIBLE, Words, byte_column, chunks, combined, discard, durable, owners, spread
from tidewater.llm.graph import components

#: A prime, so that steps through the registers visit each once.
REGISTERS = 151
BANDS, ROWS = 30, 5
RATE = 20.0
LOG_BASE = float(np.log(1.001))
BASE = 1.001
TOP = 65534
#: A pair is dropped unseen if its registers are e**8 times likelier at some similarity below the bound.
EVIDENCE = 8.0
#: Leaders of a bucket in each of the later rounds, and how many of these there are.
LEADERS, ROUNDS = 4, 1
#: Members and shingles of a block of a bucket (a tile is two blocks), and members compared with one copy of a bucket's leader.
TILE = 2048
TILE_SHINGLES = 2_000_000
PART = 128
_COLUMNS = 4096

_STEPS = -np.log1p(-np.arange(REGISTERS) / REGISTERS) / RATE
_WIDTHS = -np.expm1(-RATE * np.diff(np.append(_STEPS, np.inf)))


def sketches(first: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Registers (uint16) of several sets of 64-bit hashes; ``items[first[i]:first[i + 1]]`` is set ``i``.

    An element's values come in rising order, each for another register; an element rests once its next value cannot
    be below any register of its set, which leaves little more than one step for elements of large sets.
    """
    least = np.full((len(first) - 1, REGISTERS), np.inf)
    owner = owners(first)
    start = (spread(items ^ np.uint64(0xA5A5A5A55A5A5A5A)) % np.uint64(REGISTERS)).astype(np.int64)
    stride = 1 + (spread(items + np.uint64(0x1234567)) % np.uint64(REGISTERS - 1)).astype(np.int64)
    alive = np.arange(len(items))
    flat = least.reshape(-1)
    for step in range(REGISTERS):
        chosen = items[alive]
        unit = (spread(chosen + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)) * 2.0**-53
        value = _STEPS[step] - np.log1p(-unit * _WIDTHS[step]) / RATE
        np.minimum.at(flat, owner[alive] * REGISTERS + (start[alive] + step * stride[alive]) % REGISTERS, value)
        if step + 1 < REGISTERS:
            worst = least.max(axis=1)
            alive = alive[_STEPS[step + 1] < worst[owner[alive]]]
            if not len(alive):
                break
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(least) / LOG_BASE)
    return np.clip(level, 0, TOP).astype(np.uint16)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text; with fewer words than ``width``, the whole sequence is one."""
    counts = np.diff(words.first)
    runs = combined(words.hashes, width)
    usable = np.maximum(counts - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), usable)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(usable) - usable, usable) + words.first[owner]
    found, texts = [runs[place]], [owner]
    for length in range(1, width):
        short = np.flatnonzero(counts == length)
        found.append(combined(words.hashes, length)[words.first[short]] if len(short) else np.zeros(0, np.uint64))
        texts.append(short)
    hashes, owner = np.concatenate(found), np.concatenate(texts)
    salted = hashes ^ spread(owner.astype(np.uint64) + np.uint64(1))
    _, keep = np.unique(salted, return_index=True)
    keep = keep[np.argsort(owner[keep], kind="stable")]
    return np.searchsorted(owner[keep], np.arange(len(counts) + 1)), hashes[keep]


def _sets(column: pa.Array, width: int):
    """(first row, bounds, hashes) of the shingle sets, a chunk of rows at a time."""
    data, bounds = byte_column(column)
    for a, z in chunks(bounds):
        yield a, *shingles(Words(data[bounds[a] : bounds[z]], bounds[a : z + 1] - bounds[a], VISIBLE), width)


def _described(width: int):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            keys, counts, registers = [None] * n, np.zeros(n, np.int64), [None] * n
            for a, first, hashes in _sets(batch.column(1), width):
                sizes = np.diff(first)
                counts[a : a + len(sizes)] = sizes
                rows = sketches(first, hashes)
                for k in np.flatnonzero(sizes):
                    members = np.sort(hashes[first[k] : first[k + 1]])
                    keys[a + k] = hashlib.blake2b(members.tobytes(), digest_size=16).digest()
                    registers[a + k] = rows[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(counts), pa.array(registers, pa.binary())],
                ["doc_id", "text_key", "key", "n_shingles", "registers"],
            )

    return run


def _band_keys(batches):
    """One row per class and band, without the registers."""
    for batch in batches:
        rows = np.frombuffer(byte_column(batch.column(1))[0], np.uint16).reshape(-1, REGISTERS)[:, : BANDS * ROWS]
        cells = rows.reshape(len(rows), BANDS, ROWS).astype(np.uint64)
        total = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        total = np.broadcast_to(total, cells.shape[:2]).copy()
        for k in range(ROWS):
            total = spread(total ^ cells[:, :, k]) + np.uint64(k + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(total.reshape(-1).view(np.int64)), batch.column(0).take(pa.array(np.repeat(np.arange(len(rows)), BANDS)))],
            ["band", "key"],
        )


def plausible(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether pairs of sketches may belong to sets of at least the given similarity, by joint likelihood.

    The signs of register differences are counted; given both sizes and a similarity, each sign has a known
    probability. A pair stays unless the best similarity explains the counts far better than any at or above the threshold.
    """
    possible = np.minimum(size_a, size_b) >= threshold * np.maximum(size_a, size_b)
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    share = (size_a / (size_a + size_b))[:, None]
    limit = np.minimum(share, 1 - share) / np.maximum(share, 1 - share)
    grid = np.linspace(0, 1, 101)[None, :] * limit

    def log_probability(x):
        return -np.log1p(-np.clip(x, 1e-12, None) * (BASE - 1) / BASE) / LOG_BASE

    first = log_probability(share - (1 - share) * grid)
    second = log_probability(1 - share - share * grid)
    third = np.clip(1 - first - second, 1e-12, None)
    likelihood = more * np.log(first) + less * np.log(second) + same * np.log(third)
    high = np.where(grid >= threshold - 1e-9, likelihood, -np.inf).max(axis=1)
    high = np.where(np.isfinite(high), high, likelihood[:, -1])
    return possible & (likelihood.max(axis=1) - high <= EVIDENCE)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(byte_column(column)[0], np.uint16).reshape(-1, REGISTERS)


def _filter_pairs(threshold: float):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b, n, m = (batch.column(batch.schema.get_field_index(c)) for c in ("ra", "rb", "na", "nb"))
                good = plausible(_matrix(a), _matrix(b), n.to_numpy(), m.to_numpy(), threshold)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


PAIR = T.StructType().add("a", T.BinaryType()).add("b", T.BinaryType())


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    side = lambda x: classes.select(F.col("key").alias(x), F.col("registers").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_filter_pairs(threshold), PAIR)


def _verify(width: int, percent: int):
    """Links among pairs: rows come sorted by (a, part), the leader's own text first, then its partners' texts."""

    def run(batches):
        group, leader = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, part = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            b = batch.column(2).to_pylist()
            left, right = [], []
            for start, first, hashes in _sets(batch.column(3), width):
                for k in range(len(first) - 1):
                    row, own = start + k, hashes[first[k] : first[k + 1]]
                    if b[row] is None:
                        group, leader = (a[row], part[row]), own
                    elif group == (a[row], part[row]):
                        both = len(np.intersect1d(leader, own, assume_unique=True))
                        if 100 * both >= percent * (len(leader) + len(own) - both):
                            left.append(a[row])
                            right.append(b[row])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough. A leader's partners are spread over parts of about ``PART``."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    members = (
        pairs.join(counts, "a")
        .withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
        .join(texts.withColumnRenamed("key", "b"), "b")
        .select("a", "part", "b", "text")
    )
    leaders = (
        counts.join(texts.withColumnRenamed("key", "a"), "a")
        .select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("binary").alias("b"), "text")
    )
    dealt = leaders.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(_verify(width, percent), PAIR)


def _promising(threshold: float):
    """Members of a tile that may be similar to a member of another component, by their sketches."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("key").reset_index(drop=True)
        rows = np.frombuffer(b"".join(frame["registers"]), np.uint16).reshape(-1, REGISTERS)
        sizes, code = frame["n_shingles"].to_numpy(), pd.factorize(frame["root"])[0]
        flagged = np.zeros(len(frame), bool)
        for i in range(len(frame)):
            j = np.arange(i + 1, len(frame))
            j = j[(code[j] != code[i]) & ~(flagged[j] & flagged[i])]
            j = j[(rows[j] == rows[i]).sum(axis=1) >= threshold * REGISTERS - 5 * np.sqrt(REGISTERS * threshold * (1 - threshold))]
            if len(j):
                own = np.broadcast_to(rows[i], (len(j), REGISTERS))
                good = j[plausible(own, rows[j], np.full(len(j), sizes[i]), sizes[j], threshold)]
                flagged[good] = True
                flagged[i] |= len(good) > 0
        return frame.loc[flagged, ["band", "i", "j", "across", "key", "root"]]

    return run


def _linked(width: int, percent: int):
    """Links that join the components within a tile, from the full sets; one link for each two components joined."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("key").reset_index(drop=True)
        n = len(frame)
        found, texts = [], []
        for start, first, hashes in _sets(pa.array(frame["text"], pa.string()), width):
            found.append(hashes)
            texts.append(owners(first) + start)
        text = np.concatenate(texts)
        _, column, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        sizes = np.bincount(text, minlength=n)
        shared = times[column] > 1
        text, column = text[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        text, column = text[order], column[order]
        both = np.zeros((n, n), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            part = slice(*np.searchsorted(column, (low, low + _COLUMNS)))
            incidence = np.zeros((n, _COLUMNS), np.float32)
            incidence[text[part], column[part] - low] = 1
            both += incidence @ incidence.T
        code = pd.factorize(frame["root"])[0]
        left, right = [], []
        for i in range(n):
            near = 100 * both[i] >= percent * (sizes[i] + sizes - both[i])
            for j in np.flatnonzero(near & (code != code[i])):
                if code[j] != code[i]:
                    left.append(frame["key"][i])
                    right.append(frame["key"][j])
                    code[code == code[j]] = code[i]
        return pd.DataFrame({"a": left, "b": right})

    return run


def _unsettled(buckets: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets with several components: ``band, key, root``, the largest one's root ``top``, members ``n`` and ``shingles``,
    and of these ``rest`` and ``rest_shingles`` outside the largest component.
    """
    located = buckets.select("band", "key").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    sized = durable(located.join(classes.select("key", "n_shingles"), "key"), "located")
    per_root = sized.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    largest = F.max_by(F.struct("root", "n", "shingles"), F.struct("n", "root")).alias("largest")
    mixed = durable(
        per_root.groupBy("band")
        .agg(F.sum("n").alias("n"), F.sum("shingles").alias("shingles"), F.count("*").alias("roots"), largest)
        .where("roots > 1")
        .select(
            "band", "n", "shingles", F.col("largest.root").alias("top"), (F.col("n") - F.col("largest.n")).alias("rest"),
            (F.col("shingles") - F.col("largest.shingles")).alias("rest_shingles"),
        ),
        "mixed",
    )
    out = durable(sized.drop("n_shingles").join(mixed, "band"), "unsettled")
    discard(sized, mixed)
    return out


def _merged(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The roots after more links; only components are joined, so the graph of their roots is small."""
    if not links.take(1):
        discard(links)
        return roots
    above = components(_between_roots(links, roots))
    renamed = above.select(F.col("node").alias("root"), F.col("root").alias("top"))
    joined = roots.join(renamed, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    fresh = above.join(roots, "node", "left_anti")
    out = durable(joined.unionByName(fresh), "roots")
    discard(links, above, roots)
    return out


def _between_roots(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The links with every end replaced by the root of its component, where it has one."""
    for end in ("a", "b"):
        own = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
        links = links.join(own, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    return links


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are lower-cased (A-Z) and split at white space; the set holds the distinct runs of ``width`` words. Texts are
    linked if 100 * intersection >= percent * union. ``component_id`` is the least id reachable over links, ``kept``
    whether it is the row's own id. Null, empty and blank texts have no set and are linked with nothing: the row is its own
    component. Rows with equal sets form one class from the start and are compared once. A null id is never a
    component's id unless all ids of the component are null; an empty table gives an empty table.

    Pairs come from buckets of equal bands. First every member meets the leader of its bucket, which connects most members of
    large groups. In the next rounds the members outside a bucket's largest component meet about ``LEADERS`` others, which are all
    others in a small bucket. Where a larger bucket still holds several components, those few members are cut into blocks and meet
    all others in tiles of bounded size: sketches tell which members may have a partner in another component, and the full sets of
    those are compared inside the tile. Only links that join components leave it, so neither pairs of a group nor
    links within a component are ever written, and no component depends on the choice of the leaders.
    """
    threshold = percent / 100
    source = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.unhex(F.md5(text)).alias("text_key"))
    described = durable(
        source.mapInArrow(
            _described(width),
            T.StructType()
            .add("doc_id", docs.schema[id].dataType)
            .add("text_key", T.BinaryType())
            .add("key", T.BinaryType())
            .add("n_shingles", T.LongType())
            .add("registers", T.BinaryType()),
        ),
        "sets",
    )
    classes = durable(
        described.where("key is not null")
        .groupBy("key")
        .agg(F.min("text_key").alias("text_key"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")),
        "classes",
    )
    bands = classes.select("key", "registers").mapInArrow(_band_keys, "band long, key binary")
    leader = F.min_by("key", F.struct(F.xxhash64("key"), "key")).alias("leader")
    # Results of aggregations are written before they are joined: the joins then have two plain exchanges, whose hot partitions can be split.
    leaders = durable(bands.groupBy("band").agg(F.count("*").alias("n"), leader).where("n > 1"), "leaders")
    buckets = durable(bands.join(leaders, "band"), "buckets")
    pairs = buckets.select(F.col("leader").alias("a"), F.col("key").alias("b")).where("a != b").distinct()
    likely = durable(_likely(pairs, classes, threshold), "pairs")
    wanted = buckets.select("key").distinct().join(classes.select("key", "text_key"), "key")
    texts = durable(
        source.select("text_key", "text").join(wanted, "text_key").groupBy("key").agg(F.first("text").alias("text")), "texts"
    )
    discard(leaders)
    links = durable(_confirmed(likely, texts, width, percent), "links")
    roots = components(links)
    discard(likely, links)

    for turn in range(ROUNDS):  # buckets of up to LEADERS members are settled by the first
        members = _unsettled(buckets.where(F.col("n") > (LEADERS if turn else 2)), roots, classes)
        chosen = members.where(F.pmod(F.xxhash64("key", F.lit(turn)), F.ceil(F.col("n") / LEADERS)) == 0)
        chosen = chosen.select("band", F.col("key").alias("a"), F.col("root").alias("root_a"))
        pairs = members.where("root != top").withColumnRenamed("key", "b").join(chosen, "band").where("root != root_a")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        likely = durable(_likely(pairs, classes, threshold), "pairs")
        roots = _merged(durable(_confirmed(likely, texts, width, percent), "links"), roots)
        discard(members, likely)

    members = _unsettled(buckets.where(F.col("n") > LEADERS), roots, classes)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.greatest(F.ceil(F.col("rest") / TILE), F.ceil(F.col("rest_shingles") / TILE_SHINGLES)).cast("int")
    minor = F.col("root") != F.col("top")
    cuts = F.greatest(F.ceil((F.col("n") - F.col("rest")) / TILE), F.ceil((F.col("shingles") - F.col("rest_shingles")) / TILE_SHINGLES)).cast("int")
    own, slot = F.pmod(F.xxhash64("key", F.lit(7)), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("key", F.lit(11)), F.col("cuts")).cast("int")
    # Members of the largest component stay in their own cut and meet every block of the others; those meet one another, too.
    rest = members.where(minor).withColumns({"blocks": blocks, "cuts": cuts}).withColumn("block", own)
    rest = rest.withColumn("tile", F.explode(F.concat(F.sequence(F.lit(0), F.col("cuts") - 1), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: -1 - b))))
    met = F.when(F.col("tile") < 0, F.greatest("block", -1 - F.col("tile"))).otherwise(F.col("tile"))
    rest = rest.select("band", F.when(F.col("tile") < 0, F.least("block", -1 - F.col("tile"))).otherwise(F.col("block")).alias("i"), met.alias("j"), (F.col("tile") >= 0).alias("across"), "key", "root")
    main = members.where(~minor).withColumns({"blocks": blocks, "cuts": cuts}).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = rest.unionByName(main.select("band", "i", slot.alias("j"), F.lit(True).alias("across"), "key", "root"))
    flagged = durable(
        tiles.join(classes.select("key", "registers", "n_shingles"), "key")
        .repartition(parts, "band", "i", "j", "across")
        .groupBy("band", "i", "j", "across")
        .applyInPandas(_promising(threshold), "band long, i int, j int, across boolean, key binary, root binary"),
        "tiles",
    )
    more = durable(
        flagged.join(texts, "key")
        .repartition(parts, "band", "i", "j", "across")
        .groupBy("band", "i", "j", "across")
        .applyInPandas(_linked(width, percent), PAIR),
        "links",
    )
    roots = _merged(more, roots)
    discard(classes, buckets, members, texts, flagged)

    rows = described.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    heads = durable(rows.where("key is not null").groupBy("root").agg(F.min("doc_id").alias("head")), "heads")
    return (
        rows.join(heads, "root", "left")
        .select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("head")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
