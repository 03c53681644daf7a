"""Token alignment against a plain version that marks bytes."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF
from tidewater.llm import alignment
from tidewater.llm.queries import QUERIES


@pytest.fixture(scope="module")
def both():
    return alignment.tokenizers()


def byte_characters():
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def test_ids_and_bytes_are_those_of_the_vocabulary_file(spark, both):
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    texts = [t for t in TEXTS if t] + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for text in texts:
        assert slow.encode(" " + text, add_special_tokens=False).ids == both.a.encode_to_numpy(" " + text, disallowed_special=()).tolist()
    back = byte_characters()
    for piece, id in slow.get_vocab().items():
        if id < len(both.a_bytes):
            assert bytes(back[c] for c in piece) == both.a_bytes[id]


def plain(texts, both):
    """Rows as the query gives them, without the id: bytes of every token, ends as sets, overlaps by comparing ranges."""
    docs, total = [], Counter()
    for text in texts:
        (a,), (b,) = both.encode([text])
        spans = []
        for ids, pieces in ((a, both.a_bytes), (b, both.b_bytes)):
            at, out = 0, []
            for id in ids:
                out.append((at, at + len(pieces[id]), int(id)))
                at += len(pieces[id])
            spans.append(out)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= end) for side in spans))
            start = end
        links, low = Counter(), 0
        for s, e, i in spans[0]:
            while low < len(spans[1]) and spans[1][low][1] <= s:
                low += 1
            k = low
            while k < len(spans[1]) and spans[1][k][0] < e:
                links[i, spans[1][k][2]] += 1
                k += 1
        total.update(links)
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = Counter()
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    return [
        (na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if total[p] == best[p[1]]), sum(n * total[p] for p, n in links.items()), sha)
        for na, nb, ng, links, sha in docs
    ]


TEXTS = [
    None,
    "",
    " ",
    "\n\t ",
    "a",
    "Hello world, it's 12 o'clock!  Two  spaces",
    "<|endoftext|> <s> </s> <unk> <0x41> ▁under",
    "ünï cödé 漢字 😀🏳️‍🌈",
    "plain words without marks " * 40,
    "x" * 3000,
    "1234567890" * 50 + "\n" * 70,
    "Hello world, it's 12 o'clock!  Two  spaces",
    "\x00\x01 control",
    "ﬁ ligature ① ½",
]


def query(docs):
    aligned = alignment.durable(alignment.align_digests(docs), "test-alignment")
    out = alignment.score(aligned, alignment.pair_counts(aligned))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block, held, lane, chunk", [(4_000_000, 1_000_000, 32, 1 << 20), (150, 10, 1, 40), (90, 50, 7, 300)])
def test_awkward_texts(spark, both, monkeypatch, block, held, lane, chunk):
    monkeypatch.setattr(alignment, "BLOCK", block)
    for name, value in (("HELD", held), ("LANE", lane), ("CHUNK", chunk)):
        monkeypatch.setattr(alignment, name, value)
    rows = [(k, t, "x", 5) for k, t in enumerate(TEXTS)] + [(5, TEXTS[5], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, n_links int")
    want = sorted((k, *row) for (k, *_), row in zip(rows, plain([r[1] for r in rows], both)))
    assert sorted(map(tuple, query(docs).collect())) == want
    assert any(w[1] == 0 for w in want if w[0] > 1)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert query(docs).collect() == []


def test_operator_gives_tokens_and_groups(spark, both):
    docs = spark.createDataFrame([(1, "One two-three")], "doc_id long, text string")
    row = alignment.align(docs).first()
    assert b"".join(both.a_bytes[i] for i in row["a_ids"]) == b"".join(both.b_bytes[i] for i in row["b_ids"]) == b" One two-three"
    assert row["a_ends"][-1] == len(row["a_ids"]) and row["b_ends"][-1] == len(row["b_ids"]) and len(row["a_ends"]) == len(row["b_ends"])


def test_lanes_do_not_matter(monkeypatch):
    draw = np.random.default_rng(3)
    driver, other, heads, bases, limits = [], [], [], [], []
    at = 0
    for n in (1, 5, 100, 3000):
        end = at + 4 * n
        mine = np.unique(np.append(draw.integers(at + 1, end + 1, n // 2), end))
        theirs = np.unique(np.append(draw.integers(at + 1, end + 1, n), end))
        heads.append(sum(map(len, driver)))
        bases.append(sum(map(len, other)))
        driver.append(mine)
        other.append(theirs)
        limits.append(sum(map(len, other)))
        at = end
    driver, other = np.concatenate(driver), np.concatenate(other)
    for lane in (1, 3, 32, 10_000):
        monkeypatch.setattr(alignment, "LANE", lane)
        found = alignment.gallop(driver, other, np.array(heads), np.array(bases), np.array(limits))
        assert (found == np.searchsorted(other, driver)).all()


def test_query(spark, both):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((id, *row) for (id, _), row in zip(rows, plain([t for _, t in rows], both)))
    assert sorted(map(tuple, QUERIES["op12_alignment"](spark, SF).collect())) == want
