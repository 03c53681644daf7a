"""The pipeline against a plain version of every stage, on rows that need all of them."""

import random

import pytest

import corpus_pipeline
from tests.llm import brute
from tidewater.llm import lines

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, _row int"


def prose(n, seed, letters):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 9))) for _ in range(n))


def rows():
    menu = "home about contact imprint"
    out = []
    for k in range(60):
        lang, letters = (("en", "etaoinshr"), ("de", "äenirstüg"))[k % 2]
        out.append((k, f"{menu}\n{prose(40 + 5 * k, k, letters)}", lang, f"site{k % 15}"))
    base = prose(200, 100, "etaoinshr").split()
    out.append((70, " ".join(base), "en", "site1"))
    out.append((71, " ".join(base[:90] + ["changed"] + base[91:]), "en", "site2"))
    out.append((71, " ".join(base), "en", "site2"))
    out += [(80, None, "en", "site1"), (81, "", None, None), (82, "12345 !?", "en", "site3"), (83, menu, "en", "site4")]
    out.append((84, prose(30, 101, "etaoinshr") + " " + ITEM + " " + prose(30, 102, "etaoinshr"), "en", "site5"))
    out.append((85, prose(5000, 103, "etaoinshr"), "en", "site6"))
    out.append((None, prose(50, 104, "äenirstüg"), "de", "site7"))
    return [(id, text, lang, source, 0, "x", 1) for id, text, lang, source in out]


ITEM = prose(25, 200, "etaoinshr")


def plain(documents, benchmark):
    docs = [(r[0], r[1], r[3]) for r in documents if r[1] and any(map(str.isalpha, r[1]))]
    cleaned = brute.boilerplate([(id, site, text) for id, text, site in docs], lines.SITES)
    docs = [(id, text) for id, _, _, text in cleaned]
    # One row stays of every group: number the rows by id, null first, then in their order.
    numbered = sorted(range(len(docs)), key=lambda k: (docs[k][0] is not None, docs[k][0] or 0, k))
    groups = brute.near_duplicates([(n, docs[k][1]) for n, k in enumerate(numbered)], width=5)
    docs = [docs[k] for n, k in enumerate(numbered) if groups[n][3]]
    hit = brute.decontamination(docs, benchmark)
    return brute.pieces([d for d, h in zip(docs, hit) if not h[5]])


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(rows(), COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    want = plain(rows(), [(1, ITEM)])
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert {70, 71}.isdisjoint({84}) and not any(r["doc_id"] == 84 for r in got)


def test_stages_keep_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, docs, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert done.columns == docs.columns, name
            done.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    assert {r["n_chars"] == len(r["text"]) for r in docs.collect()} == {True}


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_of_many_copies_stays_whole(spark, tmp_path):
    menu = "home about contact imprint"
    out = [(k, f"{menu}\n{prose(60, k, 'etaoinshr')}", "en", f"site{k}", 0, "x", 1) for k in range(20)]
    exact = [prose(30, 300 + k, "etaoinshr") for k in range(6)]
    near = [prose(30, 320 + k, "etaoinshr") for k in range(8)]
    out += [(100 + k, "\n".join([menu, *exact]), "en", f"site{k}", 0, "x", 1) for k in range(15)]
    for k in range(15):
        # The third line of every copy has a word of its own.
        edited = [*near[:2], near[2] + " " + prose(1, 400 + k, "etaoinshr"), *near[3:]]
        out.append((200 + k, "\n".join(edited), "en", f"site{k}", 0, "x", 1))
    docs = spark.createDataFrame(out, COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == [*range(20), 100, 200]
    want = [(k, text.split("\n", 1)[1]) for k, text, *_ in out[:20]] + [(100, "\n".join(exact)), (200, out[35][1])]
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute.pieces(want))
