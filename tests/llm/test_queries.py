"""The registered queries over whole small tables, against plain versions; those with SQL are also in tests/test_queries.py."""

import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.conftest import SF
from tests.llm import brute
from tidewater.llm import language, licenses, token_counts
from tidewater.llm.queries import QUERIES


def table(name, *columns):
    rows = pq.read_table(f"{SF}/{name}.parquet", columns=list(columns)).to_pylist()
    return [tuple(r[c] for c in columns) for r in rows]


def run(spark, name):
    return QUERIES[name](spark, SF)


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == [*range(1, 14)]


def test_op1(spark):
    got = {r["page_id"]: r for r in run(spark, "op1_html").collect()}
    pages = table("pages", "page_id", "html")
    assert len(got) == len(pages)
    for id, html in pages:
        inside = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)[1]
        import html as entities

        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert got[id]["text"] == "\n".join(b for b in blocks if b)
        assert got[id]["n_chars"] == len(got[id]["text"])


def test_op2(spark):
    want = brute.decontamination(table("documents", "doc_id", "text"), table("benchmark", "item_id", "text"))
    assert sorted(map(tuple, run(spark, "op2_decontamination").collect())) == sorted(want)
    assert any(r[-1] for r in want)


def test_op3(spark):
    want = brute.nearest(table("embeddings", "vec_id", "embedding"))
    got = {}
    for r in run(spark, "op3_neighbours").collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(want)
    exact = {q: dict(found) for q, found in want.items()}
    hits = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, len(want[q]) + 1))
        ranked = [found[k] for k in sorted(found)]
        assert ranked == sorted(ranked, key=lambda x: (-x[1], x[0]))
        hits += sum(id in exact[q] for id, _ in ranked)
        assert all(score == exact[q].get(id, score) for id, score in ranked)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_op4(spark):
    first, later = token_counts.sentencepiece_vocabulary()
    want = [(id, *brute.longest_match(text, first, later)) for id, text in table("documents", "doc_id", "text")[:60]]
    got = {r[0]: tuple(r) for r in run(spark, "op4_token_counts").collect()}
    assert [got[w[0]] for w in want] == want


def test_op5(spark):
    want = brute.repeats(table("documents", "doc_id", "text"))
    assert sorted(map(tuple, run(spark, "op5_repeats").collect())) == sorted(want)


def test_op6(spark):
    rows = run(spark, "op6_packing").collect()
    want = brute.pieces(table("documents", "doc_id", "text"))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(inside)]).tolist()]
        assert [o for o, _ in sorted(inside)] == ends[:-1] and ends[-1] <= 2048
    assert len(places) <= -(-sum(w[3] for w in want) // 2048) * 1.01 + 1


def test_op7(spark):
    want = brute.near_duplicates(table("documents", "doc_id", "text"))
    assert sorted(map(tuple, run(spark, "op7_near_dedup").collect())) == sorted(want)


def test_op9(spark):
    want = []
    for id, text in table("documents", "doc_id", "text"):
        found = []
        for line in (text or "").split("\n"):
            if re.search(licenses.CUE, line):
                fits = [(sum(d), -len(t), name) for name, t in licenses.TEMPLATES.items() if (d := licenses.differences(name, line))]
                found += [min(fits)] if fits else []
        names = {name.removesuffix("-short") for _, _, name in found}
        want.append((id, len(found), sum(d == 0 for d, _, _ in found), ",".join(sorted(names))))
    assert sorted(map(tuple, run(spark, "op9_licenses").collect())) == sorted(want)


def test_op10(spark):
    import zlib

    lang = dict(table("documents", "doc_id", "lang"))
    rows = run(spark, "op10_language").collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert held and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.98


@pytest.mark.parametrize("seed", [1, 2])
def test_hashed_grams_are_those_of_each_text(seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choice("abé😀 ") for _ in range(draw.randrange(6))) for _ in range(20)]
    for (bounds, buckets), (alone) in zip(language.grams(texts), zip(*[language.grams([t]) for t in texts])):
        for k, (_, own) in enumerate(alone):
            assert (buckets[bounds[k] : bounds[k + 1]] == own).all()
