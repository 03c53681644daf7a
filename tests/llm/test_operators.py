"""Each operator against a plain version on awkward rows: nulls, empty and long texts, ties, repeated rows, empty tables,
and extra columns with clashing names."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidewater.llm.common import combined
from tidewater.llm import decontamination, language, licenses, lines, near_dedup, neighbours, packing, pages, repeats, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def awkward_texts():
    base = words(120, 1)
    near = base[:60] + ["other"] + base[61:]
    far = base[:60] + words(60, 2)
    passage = " ".join(words(70, 3))
    return [
        " ".join(base),
        " ".join(base),
        " ".join(near).upper(),
        " ".join(far),
        None,
        "",
        "   \n\t ",
        "one",
        "one two",
        "One\ttwo",
        "ünï cödé 漢字 ünï",
        f"start {passage} end",
        f"{passage}{passage}",
        "x" * 500,
        " ".join(words(9000, 4, 5000)),
        " ".join(words(9000, 4, 5000)) + " tail",
        "All rights reserved.\nLicensed under CC BY-NC 4.0.\nplain",
        "<|endoftext|> it's 12 o'clock  <|endoftext|>",
        "1234 !!! ²",
    ]


def documents(spark, texts=None):
    rows = [(k, t, "en", f"s{k % 3}", None) for k, t in enumerate(texts if texts is not None else awkward_texts())]
    return spark.createDataFrame([*rows, rows[0], (None, "one two", None, None, 3), (None, None, None, None, None)] if rows else [], DOCS)


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def collected(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_decontamination(spark):
    docs = documents(spark).withColumn("n_hit", F.lit("clash")).withColumn("spans", F.lit(1))
    text = awkward_texts()[0].split()
    bench = [(1, " ".join(text[5:25])), (2, " ".join(text[10:21])), (3, "two"), (4, None), (5, ""), (6, "ünï cödé 漢字"), (7, "w1 w1 never"), (2, "one"), (None, "tail")]
    table = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, n_words string")
    found = decontamination.mark_hits(docs, table)
    assert set(docs.columns) <= set(found.columns)
    got = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("item_list", 256), F.col("n_hit") > 0)
    assert collected(got) == sorted(brute.decontamination(pairs(docs), bench), key=repr)


def test_decontamination_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "TABLE_WINDOWS", 12)
    docs = documents(spark)
    text = awkward_texts()[0].split()
    bench = [(k, " ".join(text[k : k + 10 + k % 4])) for k in range(0, 60, 3)]
    found = decontamination.mark_hits(docs, spark.createDataFrame(bench, "item_id long, text string"))
    got = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("item_list", 256), F.col("n_hit") > 0)
    assert collected(got) == sorted(brute.decontamination(pairs(docs), bench), key=repr)


def test_decontamination_by_long_items(spark, monkeypatch):
    """Items of very many words, joined by commas, and of very long words are cut into tables of bounded size."""
    monkeypatch.setattr(decontamination, "TABLE_WINDOWS", 700)
    monkeypatch.setattr(decontamination, "TABLE_BYTES", 30_000)
    long = words(3000, 8, 10**6)
    wide = ["y" * 20_000 + str(k) for k in range(14)]
    docs = spark.createDataFrame([(1, " ".join(long[40:60])), (2, " ".join(long[2985:])), (3, " ".join(wide)), (4, " ".join(long[:9])), (5, "a b")], "doc_id long, text string")
    bench = [("i,1", ",".join(long)), ("i2", ";".join(wide)), ("i3", " ".join(long[45:55]))]
    table = spark.createDataFrame(bench, "item_id string, text string")
    sizes = [[len(t.order) for t in tables] for tables in decontamination._groups(table.withColumnRenamed("item_id", "item"))]
    assert sum(map(sum, sizes)) == 2991 + 5 + 1 and max(map(sum, sizes)) <= 700
    got = decontamination.mark_hits(docs, table).select("doc_id", "n_words", "n_hit", "n_items", F.sha2("item_list", 256), F.col("n_hit") > 0)
    assert collected(got) == sorted(brute.decontamination(pairs(docs), bench), key=repr)


def test_near_duplicates(spark):
    docs = documents(spark).withColumn("key", F.lit("clash")).withColumn("root", F.lit(0))
    assert collected(near_dedup.near_duplicates(docs, width=4)) == sorted(brute.near_duplicates(pairs(docs)), key=repr)


@pytest.mark.parametrize("leaders, rounds", [(16, 2), (2, 1), (1, 0)])
def test_near_duplicate_groups_that_leaders_do_not_join(spark, monkeypatch, leaders, rounds):
    """Chains of copies of copies: neighbours are linked, distant members are not; tiny tiles, also without later rounds."""
    monkeypatch.setattr(near_dedup, "LEADERS", leaders)
    monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
    monkeypatch.setattr(near_dedup, "TILE", 3)
    monkeypatch.setattr(near_dedup, "PART", 2)
    texts, now, draw = [], words(200, 5, 10**6), random.Random(6)
    for step in range(60):
        texts.append(" ".join(now))
        if step % 15 == 14:
            now = words(200, step, 10**6)
        for _ in range(draw.choice((3, 4, 5))):
            now[draw.randrange(200)] = f"n{draw.random()}"
    docs = documents(spark, texts)
    assert collected(near_dedup.near_duplicates(docs, width=4)) == sorted(brute.near_duplicates(pairs(docs)), key=repr)


def test_orders_of_the_same_words_differ():
    import itertools

    draw = np.random.default_rng(3).integers(0, 2**63, 3, dtype=np.uint64)
    for width in (2, 3, 4, 5):
        runs = list(itertools.product(range(3), repeat=width))
        assert len({int(combined(draw[list(r)], width)[0]) for r in runs}) == len(runs)


def test_sketches_merge_and_estimate():
    draw = np.random.default_rng(8)
    a, b = draw.integers(0, 2**63, (2, 3000), dtype=np.uint64)
    b[:2000] = a[:2000]
    one = lambda x: near_dedup.sketches(np.array([0, len(x)]), x)[0]
    assert (np.maximum(one(a), one(b)) == one(np.union1d(a, b))).all()
    assert abs((one(a) == one(b)).mean() - 0.5) < 0.15
    small = near_dedup.sketches(np.array([0, 1, 1, 3]), a[:3])
    assert (small[1] == 0).all() and (small[0] > 0).all()


@pytest.mark.parametrize("group", [repeats.GROUP, 1])
def test_repeats(spark, group):
    docs = documents(spark).withColumn("key", F.lit("clash")).withColumn("anchor", F.lit(0))
    got = repeats.remove_repeats(docs, group=group).drop("spans")
    assert collected(got) == sorted(brute.repeats(pairs(docs)), key=repr)


@pytest.mark.parametrize("group", [repeats.GROUP, 2])
def test_repeats_with_short_strings(spark, group):
    draw = random.Random(9)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randrange(60))) for _ in range(80)]
    texts += ["".join(draw.choice("abcdefgh") for _ in range(300))] * 2
    docs = documents(spark, texts)
    got = repeats.remove_repeats(docs, length=12, group=group).drop("spans")
    assert collected(got) == sorted(brute.repeats(pairs(docs), 12), key=repr)


def test_packing(spark):
    docs = documents(spark).withColumn("length", F.lit("clash")).withColumn("part", F.lit(0))
    rows = packing.pack(docs).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(brute.pieces(pairs(docs)), key=repr)
    filled(rows, 2048)


def filled(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def test_best_fit_fills_sequences():
    draw = np.random.default_rng(10)
    sizes = np.minimum(draw.geometric(0.004, 5000), 2048)
    values, counts = np.unique(sizes, return_counts=True)
    plan = packing.best_fit(dict(zip(values.tolist(), counts.tolist())))
    used, places = {}, set()
    for size, n in zip(values.tolist(), counts.tolist()):
        rows = plan[size]
        for rank in range(n):
            row = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
            step, k = divmod(rank - int(row[0]), int(row[3]))
            place = (int(row[1]) + step, int(row[2]) + k * size)
            assert place not in places
            places.add(place)
            used[place[0]] = used.get(place[0], 0) + size
    assert max(used.values()) <= 2048
    assert len(used) <= -(-int(sizes.sum()) // 2048) + 1


def test_language(spark):
    texts = [("the cat and the dog " * 5, "en"), ("der hund und die katze " * 5, "de")] * 30
    rows = [(k, t + str(k), lang, "s", None) for k, (t, lang) in enumerate(texts)]
    rows += [(900, None, "en", "s", 1), (901, "", "de", "s", 1), (902, "123 !? ²", None, "s", 1), (903, "Die Katze", None, "s", 1), (None, "the dog", "en", "s", 1)]
    docs = spark.createDataFrame([*rows, rows[0]], DOCS).withColumn("score", F.lit("clash"))
    model = language.train(docs)
    assert model.langs == ["de", "en"]
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    for k, t, lang, _, _ in rows:
        predicted, score = got[k, t]
        if k in (900, 901, 902):
            assert (predicted, score) == ("und", 0.0)
        else:
            assert predicted == (lang or "de") and 0.5 < score <= 1


def test_language_bound_and_no_labels(spark):
    docs = spark.createDataFrame([(k, "abc", None, "s", 1) for k in range(20)], DOCS)
    assert {tuple(r) for r in language.identify(docs, language.train(docs)).select("lang_pred", "score").collect()} == {("und", 0.0)}
    many = spark.createDataFrame([(k, "abc", "xx", "s", 1) for k in range(2000)], DOCS)
    assert language.train(many, rows=100).langs == ["xx"]


def plain_language(rows, texts):
    """Naive Bayes without batches: the posterior of every text, a dict by language."""
    from collections import Counter
    from math import exp, log

    def counted(text):
        (_, own), *more = language.grams([text.lower()])
        return Counter(np.concatenate([own, *(b for _, b in more)]).tolist())

    counts, prior = {}, Counter()
    for id, text, lang in rows:
        if id is not None and text is not None and lang is not None and zlib.crc32(str(id).encode()) % 5:
            counts.setdefault(lang, Counter()).update(counted(text))
            prior[lang] += 1
    size = 1 << language.BUCKET_BITS
    totals = {lang: Counter() for lang in counts}
    for lang, own in counts.items():
        for bucket, n in own.items():
            totals[lang][bucket // size] += n
    for text in texts:
        joint = {
            lang: log(prior[lang])
            + sum(
                n * log((own[bucket] + language.SMOOTHING) / (totals[lang][bucket // size] + language.SMOOTHING * size))
                for bucket, n in counted(text).items()
            )
            for lang, own in counts.items()
        }
        top = max(joint.values())
        mass = sum(exp(v - top) for v in joint.values())
        yield {lang: exp(v - top) / mass for lang, v in joint.items()}


@pytest.mark.parametrize("together", [400, 3])
def test_language_against_a_plain_version(spark, monkeypatch, together):
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", together)
    monkeypatch.setattr(language, "_LOOKUPS", 50 if together == 3 else 1 << 22)
    draw = random.Random(5)
    rows = [(k, "".join(draw.choice("aàbcdefé "[k % 8 :] + "xy") for _ in range(draw.randrange(60))), f"l{k % 8}", "s", 1) for k in range(400)]
    docs = spark.createDataFrame([*rows, (7, None, "l1", "s", 1), (None, "abc", "l9", "s", 1)], DOCS)
    found = {r["doc_id"]: r for r in language.identify(docs.where("text is not null and doc_id is not null"), language.train(docs)).collect()}
    want = plain_language([r[:3] for r in rows], [r[1] for r in rows])
    for (id, text, *_), shares in zip(rows, want, strict=True):
        if not any(map(str.isalpha, text)):
            assert tuple(found[id])[-2:] == ("und", 0.0)
            continue
        assert found[id]["score"] == pytest.approx(max(shares.values()), rel=1e-4)
        assert shares[found[id]["lang_pred"]] == pytest.approx(max(shares.values()), rel=1e-4)


def test_a_thousand_languages(spark):
    """One rare letter each; the rows of a small language are learnt beside a large one."""
    rows = [(k, f"{chr(0x4E00 + k % 1000)} abc " * 3, f"l{k % 1000:03d}", "s", 1) for k in range(4000)]
    rows += [(10_000 + k, "abc def", "large", "s", 1) for k in range(500)]
    model = language.train(spark.createDataFrame(rows, DOCS), rows=50)
    learnt = {lang for k, _, lang, *_ in rows if zlib.crc32(str(k).encode()) % 5}
    assert len(learnt) > 990 and model.langs == sorted(learnt)
    texts = spark.createDataFrame([(k, f"abc {chr(0x4E00 + k)} {chr(0x4E00 + k)} {chr(0x4E00 + k)}", None, "s", 1) for k in range(0, 1000, 50)], DOCS)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(texts, model).collect()}
    assert all(lang == f"l{k:03d}" for k, lang in got.items() if f"l{k:03d}" in learnt)


def test_token_counts(spark):
    docs = documents(spark).withColumn("n_tokens", F.lit("clash"))
    first, later = token_counts.sentencepiece_vocabulary()
    got = token_counts.count_tokens(docs).select("doc_id", "text", "n_words", "n_tokens", "n_unknown")
    want = [(id, text, *brute.longest_match(text, first, later)) for id, text in pairs(docs)]
    assert collected(got) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(12))
def test_automaton_on_random_vocabularies(seed):
    draw = random.Random(seed)
    piece = lambda: "".join(draw.choice("abc") for _ in range(draw.randrange(1, 6))).encode()
    first, later = {piece() for _ in range(8)}, {piece() for _ in range(8)}
    if seed % 2:
        first.add(b"")
    texts = [" ".join("".join(draw.choice("abcd") for _ in range(draw.randrange(1, 12))) for _ in range(40))]
    machine = token_counts.Automaton(first, later)
    data = np.frombuffer(texts[0].encode(), np.uint8)
    found = token_counts.Words(data, np.array([0, len(data)]), token_counts.VISIBLE, lower=False)
    counts = machine.count(found.data, found.starts, found.ends)
    assert (len(counts), int((counts + (counts == 0)).sum()), int((counts == 0).sum())) == brute.longest_match(texts[0], first, later)


def test_boilerplate_lines(spark):
    rows = [(k, "menu | home\n " + f"own {k}\n\nfooter" + (" \nrare" if k < 9 else "\nedge" if k < 19 else ""), "en", f"s{k}", 1) for k in range(25)]
    rows += [(30, None, "en", "s1", 1), (31, "", "en", "s2", 1), (32, "footer", None, None, 1), (33, "footer\nfooter", "en", "s3", 1), (None, "rare", "en", None, 1)]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_removed", F.lit("clash")).withColumn("line", F.lit(0))
    got = lines.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")
    assert collected(got) == sorted(brute.boilerplate([(r[0], r[3], r[1]) for r in rows], lines.SITES), key=repr)


def test_boilerplate_far_above_the_threshold(spark):
    rows = [(k, f"everywhere\nown {k}", "en", f"s{k}", 1) for k in range(400)]
    got = lines.remove_boilerplate(spark.createDataFrame(rows, DOCS))
    assert got.where("n_removed = 1").count() == 400


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies to track you all day long.</div>
%s<aside>Side text that is long enough to look like content on its own.</aside>
<form><label>Your mail</label><input name=q></form><section id="comments"><p>First! A long reader comment about this article, really long.</p></section>
<footer>&copy; all of us</footer></body></html>"""
ARTICLE = """<h1>Head&amp;line</h1><p>One   <b>bold</b>\n text &lt;here&gt; that goes on for a while and on.</p><div class="ad">Buy it now, cheap.</div>
<p>Second<br>line.<p>Third, unclosed, with a <a href=x>link</a> in it<p>End.<blockquote>Quoted words.</blockquote><ul><li>a</li><li>b</li></ul>"""
TEXT = "Head&line\nOne bold text <here> that goes on for a while and on.\nSecond line.\nThird, unclosed, with a link in it\nEnd.\nQuoted words.\na\nb"


@pytest.mark.parametrize("frame", ["<article>%s</article>", "<main><div>%s</div></main>", '<div id="content"><div class="post">%s</div></div>', "<main><article>%s</article></main>"])
def test_main_text(frame):
    assert pages.main_text(PAGE % (frame % ARTICLE)) == TEXT


@pytest.mark.parametrize("label", ["main-menu", "cookieBar", "ad-300x250", "site-header", "post-comments", "sidebar-content", "related"])
def test_labelled_furniture(label):
    assert pages.main_text(f'<body><div class="x {label}"><p>Furniture of the page, long enough to matter here.</p></div><div><p>Text.</p></div></body>') == "Text."


@pytest.mark.parametrize("label", ["content-with-sidebar", "no-ads", "post comments-open category-notices", "page"])
def test_labels_of_the_layout(label):
    assert pages.main_text(f'<body><article class="{label}"><div class="entry-header"><h1>Head</h1></div><p>Text.</p></article></body>') == "Head\nText."


MENU = '<div class="top"><a href=/>Home</a> <a href=/a>About</a></div><ul><li><a href=/b>News</a></li><li><a href=/c>Shop</a></li></ul>'
LONG = "A sentence of the article that is long enough to be content on its own, and it goes on and on. " * 4


@pytest.mark.parametrize(
    "body, want",
    [
        (f"<div class=post><h1>Title</h1><div class=entry><p>{LONG}</p><p>{LONG}</p></div></div>", ["Title", LONG, LONG]),
        (f"<div class=post><h2><a href=/t>Title</a></h2><div><div><p>{LONG}</p></div></div></div>", ["Title", LONG]),
        (f"<div><p>An introduction.</p><section><p>{LONG}</p><p>{LONG}</p></section></div>", ["An introduction.", LONG, LONG]),
        (f"<div><div>One line of prose ahead of the long table.</div><table><tr><td>{LONG}</td></tr></table></div>", ["One line of prose ahead of the long table.", LONG]),
        (f"<div><div><div><p>{LONG}</p></div><p>Short end.</p></div><h3>Notes</h3></div>", [LONG, "Short end.", "Notes"]),
        (f"<div><p>{LONG}</p><p><a href=/r>Smith 2020</a></p><p>{LONG}</p></div>", [LONG, "Smith 2020", LONG]),
        (f"<div><p>{LONG}</p><ul><li><a href=/r>A reference with quite a long title</a><li><a href=/s>Another reference with a long title</a></ul></div>", [LONG, "A reference with quite a long title", "Another reference with a long title"]),
        (f"<main><h1>Title</h1><article><p>{LONG}</p><p>{LONG}</p></article></main>", ["Title", LONG, LONG]),
    ],
)
def test_main_text_keeps_content_beside_the_heaviest_part(body, want):
    page = f"<html><body>{MENU}{body}<div><a href=/x>A linked headline of another page</a><a href=/y>One more headline of another page</a></div></body></html>"
    assert pages.main_text(page) == "\n".join(w.strip() for w in want)


def test_odd_pages(spark):
    cut = PAGE.split("</style>")[0]
    html = [None, "", "plain words", "<article><p>open", "<article><p>cut <b", cut, "<nav><ul><li>menu<article><p>in</article>", "<p>a</p>" * 3000, "<div>" * 3000 + "deep"]
    table = spark.createDataFrame([(k, None, h, 5, "x") for k, h in enumerate([*html, html[3]])], "page_id long, url string, html string, n_chars int, other string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.extract(table).collect()}
    texts = ["", "", "plain words", "open", "cut", "", "in", "\n".join("a" * 3000), "deep", "open"]
    assert [got[k] for k in range(len(texts))] == [(t, len(t)) for t in texts]


def test_licenses(spark):
    notices = [(name.removesuffix("-short"), text) for name, text in licenses.TEMPLATES.items()]
    rows = [(k, f"Some words.\n{text}\nMore words.", name) for k, (name, text) in enumerate(notices)]
    rows += [
        (100, "This work is licensed under the GNU General Public License, version 4.", ""),
        (101, "  licensed UNDER cc by-nc-4.0", "CC-BY-NC-4.0"),
        (102, "We got a license to drive and the permission of the owner.", ""),
        (103, None, ""),
        (104, "", ""),
        (105, "Released under the MIT License. All rights reserved.", "MIT"),
        (106, "Licensed, as ever, under the Apache License, Version 2.0.", "Apache-2.0"),
    ]
    docs = spark.createDataFrame([(k, t, "clash") for k, t, _ in rows], "doc_id long, text string, n_blocks string")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for k, _, name in rows:
        assert name in got[k]["licenses"].split(","), (k, got[k])
        assert (got[k]["n_blocks"] > 0) == bool(name)
    assert got[0]["n_exact"] == 1 and got[106]["n_exact"] == 0


def test_licenses_in_wrapped_and_long_lines(spark):
    import textwrap

    cases = []
    for name, text in licenses.TEMPLATES.items():
        name = name.removesuffix("-short")
        for width in (25, 40, 72):
            wrapped = "\n".join(f" * {line}" for line in textwrap.wrap(text, width))
            cases.append((f"Some words.\n\n{wrapped}\n\nMore words.", 1, 1, name))
        cases.append((f"{words(3000, 1)} {text} {words(3000, 2)}", 1, 1, name))
    altered = licenses.TEMPLATES["MIT"].replace("obtaining a copy", "who obtains a copy")
    cases += [
        ("Released under the MIT License. All rights reserved.", 2, 2, "All-Rights-Reserved,MIT"),
        ("Code: " + licenses.TEMPLATES["Apache-2.0"] + " Texts: Licensed under CC BY 4.0.", 2, 2, "Apache-2.0,CC-BY-4.0"),
        ("\n".join(textwrap.wrap(altered, 30)) + "\nLicensed under CC BY-SA 4.0.", 2, 1, "CC-BY-SA-4.0,MIT"),
        ("All rights reserved.\n" * 3, 3, 3, "All-Rights-Reserved"),
        ("This work is licensed under the GNU General Public License, version 4.\n2 of them.", 0, 0, ""),
        ("license " * 2000, 0, 0, ""),
    ]
    docs = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[2:] for r in licenses.scan(docs).collect()}
    for k, case in enumerate(cases):
        assert got[k] == case[1:], case


def test_licenses_are_named_by_the_ranking(monkeypatch):
    short, long = licenses.TEMPLATES["Apache-2.0-short"], licenses.TEMPLATES["Apache-2.0"]
    altered = long.replace("this file", "this work")
    assert licenses.notices(long) == [("Apache-2.0", 0)]
    assert licenses.notices(altered) == [("Apache-2.0", 2)]  # and not the short one, which it begins with word for word
    assert sorted(d for _, d in licenses.notices(f"{short} Or: {altered} Or: {long}\n{short}")) == [0, 0, 0, 2]
    gpl, lesser = licenses.TEMPLATES["GPL-3.0"], licenses.TEMPLATES["LGPL-3.0"].replace("licensed", "placed")
    assert sorted(licenses.notices(f"{gpl} {lesser}")) == [("GPL-3.0", 0), ("LGPL-3.0", 2)]
    for n in range(130, 180, 6):  # the end of a stretch in the second notice
        text = f"All rights reserved. {words(n, n)} {licenses.TEMPLATES['BSD-3-Clause']} {words(200, 1)}"
        assert sorted(licenses.notices(text)) == [("All-Rights-Reserved", 0), ("BSD-3-Clause", 0)]
    assert licenses.notices(f"{altered}\n" * 300) == [("Apache-2.0", 2)] * 300

    asked, savings = [], licenses.savings
    monkeypatch.setattr(licenses, "savings", lambda block: asked.append(block) or savings(block))
    for name, text in licenses.TEMPLATES.items():
        asked.clear()
        licenses.notices(text)
        assert asked == [" ".join(licenses.words(text))]
        assert savings(asked[0])[0][1].removesuffix("-short") == name.removesuffix("-short")
    asked.clear()
    assert licenses.notices("We got a license to drive.") == [] and asked == ["we got a license to drive"]
    monkeypatch.setattr(licenses, "savings", lambda block: [(0, name) for name in licenses.TEMPLATES])
    assert licenses.notices(altered) == [("Apache-2.0", 0)]


def vectors(n, size=16, seed=11):
    draw = np.random.default_rng(seed)
    return [(k, [float(x) for x in draw.standard_normal(size).astype(np.float32)], 0) for k in range(n)]


def test_neighbours(spark):
    rows = vectors(300)
    same = rows[7][1]
    rows += [(k, same, 1) for k in range(300, 340)]
    rows += [(400, None, 0), (420, [0.0] * 16, 0), (440, [float("nan")] * 16, 0), (460, [1.0] * 15 + [None], 0), (480, [1.0, 2.0], 0), (None, same, 0), (500, [float("inf")] * 16, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    want = brute.nearest([r[:2] for r in rows])
    got = {}
    for r in sorted(neighbours.nearest(table).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found >= 0.9 * sum(map(len, want.values()))
    for q in want:
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0])) and len(got[q]) == 20


@pytest.mark.parametrize("scale, block", [(1e-7, neighbours.BLOCK), (1e7, 3), (None, neighbours.BLOCK)])
def test_neighbours_of_scaled_vectors(spark, monkeypatch, scale, block):
    """Recall and scores do not depend on the unit; ``None``: norms between 1e-9 and 1e9 in one table, queries dealt over blocks."""
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = vectors(400, 12, 5)
    factor = [scale] * 400 if scale else 10.0 ** np.random.default_rng(1).integers(-9, 10, 400)
    rows = [(id, [float(x) * float(f) for x in v]) for (id, v, _), f in zip(rows, factor)]
    want = brute.nearest(rows)
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    exact = {i: np.array(v) for i, v in rows}
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and len(found) == 20
        assert all(score == (exact[q] * exact[i]).sum() for i, score in found)


def test_many_equal_vectors(spark):
    """The nearest of a common vector are the smallest ids that hold it, whatever the window."""
    rows = vectors(200) + [(k, [1.0] * 16, 0) for k in range(1000, 3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = {}
    for r in neighbours.nearest(table).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(got) == 10 + 100
    for q in range(1000, 3000, 20):
        assert got[q] == [k for k in range(1000, 1021) if k != q][:20]


def test_few_neighbours(spark):
    table = spark.createDataFrame(vectors(6) + vectors(2), "vec_id long, embedding array<float>, label int")
    got = neighbours.nearest(table).collect()
    assert {(r["query_id"], r["vec_id"]) for r in got} == {(0, k) for k in range(1, 6)}
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5]
    alone = neighbours.nearest(spark.createDataFrame(vectors(1), "vec_id long, embedding array<float>, label int"))
    assert alone.count() == 0


def test_hilbert_steps_to_neighbouring_cells():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert(cells, 3)
    assert sorted(keys) == list(range(512))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_empty_tables(spark):
    docs = documents(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    empty = [
        decontamination.mark_hits(docs, bench),
        near_dedup.near_duplicates(docs),
        repeats.remove_repeats(docs),
        packing.pack(docs),
        language.identify(docs, language.train(docs)),
        token_counts.count_tokens(docs),
        lines.remove_boilerplate(docs),
        licenses.scan(docs),
        pages.extract(spark.createDataFrame([], "page_id long, url string, html string")),
        neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ]
    for frame in empty:
        assert frame.columns and frame.count() == 0
    nothing = decontamination.mark_hits(documents(spark), bench)
    assert nothing.where("n_hit > 0").count() == 0
