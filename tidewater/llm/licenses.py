"""License notices, found by conditional compression.

Paragraphs are read as words, so that line breaks and comment signs do not matter, in overlapping stretches around cue words.
A stretch is compressed by zstandard alone and with every template as a raw dictionary, and the templates are ranked by the
bytes they save. The first of the ranking that the stretch states, compared word by word, is its notice; the words it shares with
the template are taken out, and what is left is compressed and ranked again until it states none.
"""

from __future__ import annotations

import difflib
import functools
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate, groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Short notices of public licenses, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    "MIT-short": "Released under the MIT License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All-Rights-Reserved": "All rights reserved.",
}
#: Notices are looked for around these.
CUE = r"(?i)licen[cs]|copyright|permission|permitted|rights reserved|public domain|creative commons|\bcc[ 0-]|redistribution|endorse or promote|waived"
#: Words that tell licenses of one family apart: a block and its license agree in them.
TELLING = frozenset("affero apache by cc cc0 gnu lesser mit mozilla nc nd sa".split())
#: Share of a template's words that a block has, in order.
COVERED = 0.8
LEVEL = 9


def words(text: str) -> list[str]:
    return re.findall(r"[a-z]+|\d+(?:\.\d+)*", text.lower())


_WANTED = {name: words(template) for name, template in TEMPLATES.items()}
_COUNTS = {name: Counter(wanted) for name, wanted in _WANTED.items()}
#: Longer words are in no template; the compressor sees no more of them than tells so.
_LONGEST_WORD = max(len(w) for wanted in _WANTED.values() for w in wanted)
#: Words of a stretch and words on either side of a cue: a notice of up to half a stretch lies whole in one.
REACH = 3 * max(map(len, _WANTED.values()))
STRETCH = 2 * REACH


@functools.cache
def _compressors():
    import zstandard

    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    tuned = {}
    for name, wanted in _WANTED.items():
        raw = zstandard.ZstdCompressionDict((" ".join(wanted) + " ").encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        tuned[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)
    return plain, tuned


@functools.lru_cache(maxsize=1024)
def savings(block: str) -> list[tuple[int, str]]:
    """(bytes that the words of the template as a dictionary save, template), best first; ties by name. ``block``: joined words."""
    plain, tuned = _compressors()
    raw = block.encode()
    alone = len(plain.compress(raw))
    return sorted(((alone - len(c.compress(raw)), name) for name, c in tuned.items()), key=lambda x: (-x[0], x[1]))


def differences(template: str, block: str) -> tuple[int, int] | None:
    """(template words missing, other words in between) where the block states the license; None where it does not."""
    wanted, found = words(TEMPLATES[template]), words(block)
    matched = [m for m in difflib.SequenceMatcher(None, wanted, found, autojunk=False).get_matching_blocks() if m.size]
    covered = sum(m.size for m in matched)
    if not covered or covered < COVERED * len(wanted):
        return None
    inside = found[matched[0].b : matched[-1].b + matched[-1].size]
    telling = lambda ws: {w for w in ws if w in TELLING or w[0].isdigit()}
    if telling(wanted) - telling(inside) or (telling(inside) & TELLING) - telling(wanted):
        return None
    return len(wanted) - covered, len(inside) - covered


def _telling(found: list[str]) -> set[str]:
    return {w for w in found if w in TELLING or w[0].isdigit()}


def _matches(wanted: list[str], found: list[str], low: int, high: int) -> list[difflib.Match]:
    """Runs of words that ``wanted`` and ``found[low:high]`` share in order; ``b`` counts from the start of ``found``."""
    matcher = difflib.SequenceMatcher(None, wanted, found[low:high], autojunk=False)
    return [difflib.Match(m.a, low + m.b, m.size) for m in matcher.get_matching_blocks() if m.size]


def _compact(matched: list[difflib.Match], reach: int) -> list[list[difflib.Match]]:
    """The runs at most ``reach`` words from each other around the longest one, and these without outer runs of other notices."""
    gaps = [b.b - a.b - a.size for a, b in zip(matched, matched[1:])]
    first = last = max(range(len(matched)), key=lambda k: matched[k].size)
    while first > 0 and gaps[first - 1] <= reach:
        first -= 1
    while last < len(gaps) and gaps[last] <= reach:
        last += 1
    near = matched[first : last + 1]
    # An outer run that brings more other words in between than it has.
    while first < last and gaps[first] > matched[first].size:
        first += 1
    while first < last and gaps[last - 1] > matched[last].size:
        last -= 1
    return [near, matched[first : last + 1]]


def _located(template: str, found: list[str], line: list[int], counts: Counter[str]) -> tuple[bool, int, list[tuple[int, int]]] | None:
    """(scattered, words that differ, runs of words shared with the template) of the notice in ``found``; None if there is none.

    The words of ``found``, which are ``counts``, stand in the lines ``line``. A scattered notice has words far from its others.
    """
    wanted = _WANTED[template]
    if (_COUNTS[template] & counts).total() < COVERED * len(wanted):
        return None
    everything = _matches(wanted, found, 0, len(found))
    reach = len(wanted) // 2
    heart = max(everything, key=lambda m: m.size)
    # The longest runs may be those of another notice, so words around the longest one are aligned by themselves, too.
    start, spare = heart.b - heart.a, len(wanted) // 4
    around = _matches(wanted, found, max(0, start - spare), start + len(wanted) + spare)
    fits = []
    for scattered, matched in [(False, m) for m in (*_compact(everything, reach), *_compact(around, reach))] + [(True, everything)]:
        covered = sum(m.size for m in matched)
        if covered < COVERED * len(wanted):
            continue
        start, end = matched[0].b, matched[-1].b + matched[-1].size
        inside = found[start:end]
        if _telling(wanted) - _telling(inside) or (_telling(inside) & TELLING) - _telling(wanted):
            continue
        if line[start] != line[end - 1] and _telling(inside) != _telling(wanted):
            continue  # a number of the next line
        fits.append((scattered, len(wanted) + len(inside) - 2 * covered, [(m.b, m.b + m.size) for m in matched]))
    return min(fits, default=None)


def _best(found: list[str], line: list[int], first: int, last: int) -> tuple[int, str, list[tuple[int, int]]] | None:
    """(words that differ, template, runs of its words): of the templates that the stretch states, the one that saves most.

    Ties go to the fewest differences, then to the longest template; scattered notices, whose words may be those of others, come
    after all others. Three words may save nothing in a long stretch, so the whole ranking is gone through.
    """
    rest = None
    stretch, lines = found[first:last], line[first:last]
    counts = Counter(stretch)
    for _, alike in groupby(savings(" ".join(w[: _LONGEST_WORD + 1] for w in stretch)), key=lambda x: x[0]):
        fits = []
        for _, name in alike:
            if located := _located(name, stretch, lines, counts):
                scattered, differ, shared = located
                fits.append((scattered, differ, -len(TEMPLATES[name]), name, [(first + start, first + end) for start, end in shared]))
        if fits:
            scattered, differ, _, name, shared = min(fits)
            if not scattered:
                return differ, name, shared
            rest = rest or (differ, name, shared)
    return rest


def _cues(found: list[str]) -> list[int]:
    """Places of the words at which a cue begins."""
    starts = [0, *accumulate(len(w) + 1 for w in found)]
    return [bisect_right(starts, m.start()) - 1 for m in re.finditer(CUE, " ".join(found))]


def _runs(free: list[bool], breaks: list[int]) -> list[tuple[int, int]]:
    """Longest runs of free words that have one value of ``breaks``."""
    out, start = [], 0
    for k in range(1, len(free) + 1):
        if k == len(free) or free[k] != free[start] or breaks[k] != breaks[start]:
            if free[start]:
                out.append((start, k))
            start = k
    return out


def notices(text: str) -> list[tuple[str, int]]:
    """(license, words that differ) of every notice in ``text``. Lines without any word part paragraphs."""
    out = []
    found: list[str] = []
    line: list[int] = []
    for k, content in enumerate([*text.split("\n"), ""]):
        own = words(content)
        if own:
            found += own
            line += [k] * len(own)
        elif found:
            if re.search(CUE, " ".join(found)):
                out += _paragraph(found, line)
            found, line = [], []
    return out


def _paragraph(found: list[str], line: list[int]) -> list[tuple[str, int]]:
    out = []
    free = [True] * len(found)
    cues = _cues(found)
    # Once over whole runs of words, once line by line.
    for breaks in ([0] * len(found), line)[: 1 + (line[0] != line[-1])]:
        waiting = [(first, last) for first, last in _runs(free, breaks) if bisect_left(cues, first) < bisect_left(cues, last)]
        while waiting:
            first, last = waiting.pop()
            taken = _first_notice(found, line, cues, first, last)
            if taken:
                searched, differ, name, shared = taken
                out.append((name.removesuffix("-short"), differ))
                for start, end in shared:
                    free[start:end] = [False] * (end - start)
                # Stretches before this one state nothing; only its own and the words in reach of it have changed.
                edges = [max(first, searched - STRETCH), *(k for run in shared for k in run), last]
                waiting += [(a, z) for a, z in zip(edges[::2], edges[1::2]) if a < z]
    return out


def _first_notice(found: list[str], line: list[int], cues: list[int], begin: int, stop: int) -> tuple[int, int, str, list[tuple[int, int]]] | None:
    """(start of the stretch, words that differ, template, runs of its words) of the first stretch of ``begin`` to ``stop`` that states a license.

    Stretches lie around cues in it and in reach of it.
    """
    done = begin
    for k in range(bisect_left(cues, begin - REACH), len(cues)):
        if cues[k] >= stop + REACH:
            break
        cue = min(max(cues[k], begin), stop - 1)
        first = max(begin, cue - REACH, done - REACH)
        while first <= cue:
            last = min(first + STRETCH, stop)
            best = _best(found, line, first, last)
            if best and best[0]:
                # The ends of the stretch may have cut it: read again with the notice in the middle.
                again = max(begin, (best[2][0][0] + best[2][-1][1]) // 2 - REACH)
                whole = _best(found, line, again, min(again + STRETCH, stop))
                if whole:
                    best, first = whole, min(first, again)
            if best:
                return first, *best
            done = last
            if last == stop:
                return None
            first += REACH
    return None


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_blocks``, ``n_exact`` and ``licenses`` added, replacing columns of these names.

    ``n_blocks`` counts notices, several in one line too and one that is wrapped over lines once, ``n_exact`` those without any
    different word, ``licenses`` is the sorted list of distinct licenses, comma-joined. Null and empty texts, and texts without
    a notice, give 0, 0 and the empty string.
    """
    docs = docs.drop("n_blocks", "n_exact", "licenses")

    @F.pandas_udf("n_blocks long, n_exact long, licenses string")
    def judge(candidates: pd.Series) -> pd.DataFrame:
        rows = []
        for candidate in candidates:
            found = notices(candidate) if candidate is not None else []
            rows.append((len(found), sum(d == 0 for _, d in found), ",".join(sorted({n for n, _ in found}))))
        return pd.DataFrame(rows, columns=["n_blocks", "n_exact", "licenses"])

    # Cue words may be parted by a line break and comment signs.
    cued = F.regexp_replace(text, "[^A-Za-z0-9]+", " ").rlike(CUE)
    return docs.withColumn("_found", judge(F.when(cued, F.col(text)))).select(*(F.col(f"`{c}`") for c in docs.columns), "_found.*")
