"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def lower(text: str | None) -> bytes:
    return (text or "").encode().lower()


def decontamination(docs, bench):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in bench:
        words = word.findall(lower(text))
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            if item is not None:
                windows[tuple(words[k : k + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for id, text in docs:
        words, hit, items = word.findall(lower(text)), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    items |= windows[tuple(words[k : k + size])]
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((id, len(words), len(hit), len(items), digest, bool(hit)))
    return out


def near_duplicates(docs, width=4, percent=80):
    """Rows (id, set size, component, kept); nodes are rows, so ids may repeat or be null."""
    sets = []
    for _, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    shared = Counter(pair for rows in where.values() for pair in itertools.combinations(rows, 2))
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[find(b)] = find(a)
    least = {}
    for k, (id, _) in enumerate(docs):
        if id is not None:
            least[find(k)] = min(least.get(find(k), id), id)
    rows = [(id, len(sets[k]), least.get(find(k)) if sets[k] else id) for k, (id, _) in enumerate(docs)]
    return [(*r, r[0] == r[2]) for r in rows]


def repeats(docs, length=200):
    raw = [(text or "").encode() for _, text in docs]
    times = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for (id, _), b in zip(docs, raw):
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if times[b[k : k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = sum(1 for flag, _ in itertools.groupby(gone) if flag)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((id, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def pieces(docs, length=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            out.append((id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def longest_match(text, first: set[bytes], later: set[bytes]):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    total = unknown = 0
    for word in words:
        rest, vocabulary, n = b"\0" + word, {b"\0" + p for p in first}, 0
        while rest:
            size = next((k for k in range(len(rest), 0, -1) if rest[:k] in vocabulary), 0)
            if not size:
                n = 0
                break
            rest, vocabulary, n = rest[size:], later, n + 1
        total, unknown = total + (n or 1), unknown + (n == 0)
    return len(words), total, unknown


def boilerplate(docs, sites):
    """Rows (id, site, text) to rows (id, lines, removed, text)."""
    seen = defaultdict(set)
    for _, site, text in docs:
        for line in (text or "").split("\n"):
            if site is not None and line.strip(" "):
                seen[line.strip(" ")].add(site)
    out = []
    for id, _, text in docs:
        lines = [] if text is None else text.split("\n")
        kept = [line for line in lines if len(seen.get(line.strip(" "), ())) < sites]
        out.append((id, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return out


def nearest(rows, k=20, every=20):
    """Rows (id, vector) to {query: [(id, score)]}; exact."""
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v}
    size = Counter(map(len, good.values())).most_common(1)[0][0] if good else 0
    good = {i: v for i, v in good.items() if len(v) == size and np.isfinite(v).all() and v.any()}
    out = {}
    for q in good:
        if q % every == 0:
            scores = [(i, float((good[q] * v).sum())) for i, v in good.items() if i != q]
            out[q] = sorted(scores, key=lambda x: (-x[1], x[0]))[:k]
    return out
