"""Minimax shards against a plain binary search over prefix sums."""

import bisect
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidewater.llm import sharding
from tidewater.llm.queries import QUERIES


def least_capacity(sizes, shards):
    ends = [0]
    for size in sizes:
        ends.append(ends[-1] + size)
    if not sizes:
        return 0

    def fits(capacity):
        at = 0
        for _ in range(shards):
            at = ends[bisect.bisect_right(ends, at + capacity) - 1]
        return at == ends[-1]

    return next(c for c in range(max(1, -(-ends[-1] // shards)), ends[-1] + 1) if fits(c)) if ends[-1] < 10**6 else None


def judge(rows, key_of, shards):
    """Rows (key, size, shard, slot) hold: groups whole, slots gapless, the largest shard as small as the order allows."""
    home, total, slots = {}, {}, {}
    groups = {}
    for key, size, shard, slot in rows:
        assert home.setdefault(key, shard) == shard and 0 <= shard < shards
        total[shard] = total.get(shard, 0) + size
        slots.setdefault(shard, []).append(slot)
        groups[key] = groups.get(key, 0) + size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    left, alone = sum(groups.values()), []
    for key in sorted(groups, key=lambda k: (-groups[k], key_of[k])):
        if len(alone) == shards or not left or groups[key] * (shards - len(alone)) < left:
            break
        alone.append(key)
        left -= groups[key]
    rest = sorted((k for k in groups if k not in alone), key=key_of.get)
    want = max([least_capacity([groups[k] for k in rest], shards - len(alone)) if shards > len(alone) else 0, *[groups[k] for k in alone]])
    assert max(total.values()) == want
    order = [home[k] for k in rest]
    assert order == sorted(order)


def hashes(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string").distinct()
    return {r[0]: r[1] for r in frame.select("text", F.xxhash64("text")).collect()}


@pytest.mark.parametrize("cells, shards", [(64, 1), (4, 3), (256, 16)])
def test_awkward_rows(spark, monkeypatch, cells, shards):
    monkeypatch.setattr(sharding, "CELLS", cells)
    draw = random.Random(shards)
    texts = [None, None, "", "", "é漢😀", "x" * 3000, *["hot text"] * 60]
    texts += ["".join(draw.choice("ab é") for _ in range(int(draw.expovariate(1 / 40)))) for _ in range(120)]
    docs = [(k % 150 or None, t, "clash", 7, -1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([*docs, docs[3]], "doc_id long, text string, key string, part int, size int").drop("size")
    rows = sharding.shard_texts(docs, ["doc_id"], shards=shards).collect()
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (k or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, *_ in docs.collect()
    )
    key_of = hashes(spark, texts)
    joined = sharding.shard_texts(docs.select(F.col("text").alias("id"), "text"), ["id"], shards=shards).collect()
    judge([(r["id"], r["size"], r["shard"], r["slot"]) for r in joined], key_of, shards)


def test_empty_table_and_one_group(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_texts(docs, ["doc_id"]).collect() == []
    one = spark.createDataFrame([(k, "same") for k in range(9)], "doc_id long, text string")
    assert sorted(r["slot"] for r in sharding.shard_texts(one, ["doc_id"]).collect()) == list(range(9))
    with pytest.raises(ValueError):
        sharding.shard_texts(one.withColumnRenamed("doc_id", "slot"), ["slot"])


def test_query(spark):
    rows = QUERIES["op11_sharding"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(docs) and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    judge([(docs[r["doc_id"]], r["size"], r["shard"], r["slot"]) for r in rows], hashes(spark, docs.values()), 16)
