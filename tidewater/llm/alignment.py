"""Two tokenizers' tokens of one text laid side by side by galloping intersection of their end offsets.

Of the two end lists of a document the shorter one drives: each end looks on from where the one before it was found, in steps of 1, 2,
4, ... tokens of the longer list, then by binary search in the last step. Ends found in both lists cut the tokens into groups;
the ranks between two driving ends are the longer list's tokens that overlap. Runs of driving tokens of many documents walk
side by side in numpy.

Counts of linked id pairs over all documents are summed up in Spark and looked up in blocks of ``BLOCK`` pairs, one pass over the documents'
own pairs for each block, so that no task and no broadcast holds more.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import discard, durable

#: Bytes of text that one numpy pass aligns; a longer text comes alone.
CHUNK = 1 << 18
#: Driving tokens that one lane walks through.
LANE = 32
#: Pairs of ids whose counts are broadcast at a time (12 MB a million).
BLOCK = 4_000_000
#: Distinct pairs that a task holds before it hands on partial sums.
HELD = 1_000_000
#: An id pair as one number: ``a * PAIR + b``.
PAIR = 1 << 32

class Tokenizers:
    """A: byte-level BPE of ``space + text``. B: sentencepiece of ``text``, which adds the space itself. With the bytes of every id.

    The ranks of A's vocabulary are encoded by tiktoken, which gives the ids of ``tokenizers`` with the same vocabulary, special tokens in texts
    being plain text, at a third of the time.
    """

    def __init__(self, a_path: str | None = None, b_path: str | None = None):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(a_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.a = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path("piece_bpe_32k.model"))
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b_bytes = []
        for id in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(id)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(id) else piece.replace("▁", " ").encode())
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self._tables = [
            (np.frombuffer(b"".join(table), np.uint8), np.cumsum(lengths) - lengths, lengths)
            for table, lengths in ((self.a_bytes, self.a_lengths), (self.b_bytes, self.b_lengths))
        ]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B for each text; none where a text is null or empty or the joined bytes are not those of the text."""
        none = np.zeros(0, np.int64)
        a, b = [none] * len(texts), [none] * len(texts)
        full = [k for k, t in enumerate(texts) if t]
        for k, theirs in zip(full, self.b.encode([texts[k] for k in full], num_threads=1) if full else []):
            whole = " " + texts[k]
            ours, theirs = self.a.encode_to_numpy(whole, disallowed_special=()).astype(np.int64), np.array(theirs, np.int64)
            bytes_ = np.frombuffer(whole.encode(), np.uint8)
            if _spells(ours, *self._tables[0], bytes_) and _spells(theirs, *self._tables[1], bytes_):
                a[k], b[k] = ours, theirs
        return a, b


def _spells(ids: np.ndarray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, whole: np.ndarray) -> bool:
    """Whether the bytes of the ids, joined, are ``whole``."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    if not len(ids) or ends[-1] != len(whole):
        return False
    return bool((flat[np.arange(len(whole)) + np.repeat(starts[ids] - ends + sizes, sizes)] == whole).all())


@functools.cache
def tokenizers(a_path: str | None = None, b_path: str | None = None) -> Tokenizers:
    """One pair per Python worker."""
    return Tokenizers(a_path, b_path)


def gallop(driver: np.ndarray, other: np.ndarray, heads: np.ndarray, bases: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """For each value of ``driver`` the index of the first value of ``other`` that is not below it.

    Both ascend within a document. ``heads`` are the places in ``driver`` at which documents start, ``bases`` and ``limits`` where
    ``other`` has that document; the last value of a document must be in both. A document is walked by lanes of ``LANE`` driving
    values; a lane starts at its document's base and gallops on from the place found before.
    """
    found = np.zeros(len(driver), np.int64)
    counts = np.diff(np.append(heads, len(driver)))
    lanes = -(-counts // LANE)
    owner = np.repeat(np.arange(len(heads)), lanes)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    first = heads[owner] + nth * LANE
    last = np.minimum(first + LANE, heads[owner] + counts[owner])
    at, limit = bases[owner].copy(), limits[owner]
    for step in range(LANE):
        live = np.flatnonzero(first + step < last)
        if not len(live):
            break
        goal, low, end = driver[first[live] + step], at[live], limit[live]
        # Exponential: ``low`` stays below the goal's place or on it, ``high`` is not below the goal.
        high, reach = low.copy(), np.ones(len(live), np.int64)
        going = np.flatnonzero(other[high] < goal)
        while len(going):
            low[going] = high[going] + 1
            high[going] = np.minimum(high[going] + reach[going], end[going] - 1)
            reach[going] *= 2
            going = going[other[high[going]] < goal[going]]
        going = np.flatnonzero(low < high)
        while len(going):  # binary, between the last two steps
            middle = (low[going] + high[going]) >> 1
            below = other[middle] < goal[going]
            low[going[below]] = middle[below] + 1
            high[going[~below]] = middle[~below]
            going = going[low[going] < high[going]]
        at[live] = found[first[live] + step] = high
    return found


class Aligned:
    """The documents of one chunk: tokens of all of them in a row, with the document bounds ``a_first`` and ``b_first``."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a, self.b = np.concatenate([*a, np.zeros(0, np.int64)]), np.concatenate([*b, np.zeros(0, np.int64)])
        self.a_first = np.append(0, np.cumsum([len(x) for x in a])).astype(np.int64)
        self.b_first = np.append(0, np.cumsum([len(x) for x in b])).astype(np.int64)
        # Both lists hold the same bytes, so running ends over all documents agree at the end of each one.
        a_ends, b_ends = np.cumsum(a_lengths[self.a]), np.cumsum(b_lengths[self.b])
        a_few = np.diff(self.a_first) <= np.diff(self.b_first)
        parts = [
            self._walk(a_ends, b_ends, self.a_first, self.b_first, np.flatnonzero(a_few), False),
            self._walk(b_ends, a_ends, self.b_first, self.a_first, np.flatnonzero(~a_few), True),
        ]
        (a_cut, b_cut, a_link, b_link) = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(a_cut, kind="stable")
        #: Tokens up to and including the last one of each group, over all documents.
        self.a_cut, self.b_cut = a_cut[order] + 1, b_cut[order] + 1
        #: Token places of every overlapping pair, without order.
        self.a_link, self.b_link = a_link, b_link
        self.groups = np.searchsorted(self.a_cut, self.a_first, "right")

    @staticmethod
    def _walk(ends, others, first, other_first, docs, swapped):
        """Common ends and overlapping tokens of ``docs``, driven by the list ``ends``."""
        docs = docs[first[docs + 1] > first[docs]]
        sizes = first[docs + 1] - first[docs]
        heads = np.cumsum(sizes) - sizes
        places = np.arange(sizes.sum()) - np.repeat(heads, sizes) + np.repeat(first[docs], sizes)
        goal = ends[places]
        found = gallop(goal, others, heads, other_first[docs], other_first[docs + 1])
        common = others[found] == goal if len(goal) else np.zeros(0, bool)
        # A token overlaps from the place its predecessor ended in (or behind it, if that was a common end) to its own.
        start = np.zeros(len(places), np.int64)
        start[1:] = found[:-1] + common[:-1]
        start[heads] = other_first[docs]
        width = found - start + 1
        own = np.repeat(places, width)
        theirs = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start, width)
        out = (places[common], found[common], own, theirs)
        return (out[1], out[0], out[3], out[2]) if swapped else out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bounds of documents, id pairs, links of each): the distinct linked id pairs of every document."""
        docs = np.searchsorted(self.a_first, self.a_link, "right") - 1
        codes = self.a[self.a_link] * PAIR + self.b[self.b_link]
        kinds, code = np.unique(codes, return_inverse=True)
        both, links = np.unique(docs * max(1, len(kinds)) + code, return_counts=True)
        return np.searchsorted(both, np.arange(len(self.a_first)) * max(1, len(kinds))), kinds[both % max(1, len(kinds))], links

    def lines(self) -> tuple[bytes, np.ndarray]:
        """(bytes, bounds of documents): ``a1,a2|b1;a3|b2,b3;`` for every document, with a mark behind the last group too."""
        n_a, n_b = len(self.a), len(self.b)
        ids, marks = np.zeros(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        # A group's A ids stand behind the B ids of all groups before it, its B ids behind its A ids.
        a_group = np.searchsorted(self.a_cut, np.arange(n_a), "right")
        b_group = np.searchsorted(self.b_cut, np.arange(n_b), "right")
        a_at = np.arange(n_a) + np.append(0, self.b_cut)[a_group]
        b_at = np.arange(n_b) + np.append(self.a_cut, 0)[b_group]
        ids[a_at], ids[b_at] = self.a, self.b
        marks[a_at[self.a_cut - 1]] = ord("|")
        marks[b_at[self.b_cut - 1]] = ord(";")
        places = len(str(int(ids.max()))) if len(ids) else 1
        digits = np.zeros((len(ids), places + 1), np.uint8)
        shown = np.zeros(digits.shape, bool)
        for place in range(places - 1, -1, -1):
            digits[:, place] = ids % 10 + ord("0")
            shown[:, place] = (ids > 0) | (place == places - 1)
            ids //= 10
        digits[:, places], shown[:, places] = marks, True
        return digits[shown].tobytes(), np.append(0, np.cumsum(shown.sum(1)))[self.a_first + self.b_first]


def align(docs: DataFrame, text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``docs`` without its text, with the alignment of each text added, replacing columns of these names:

    ``a_ids``, ``b_ids``: the tokens; ``a_ends``, ``b_ends``: for every group the number of tokens up to its end; ``pairs``: distinct linked
    id pairs as ``a * PAIR + b``, ascending; ``pair_links``: how many links each pair has. Null and empty texts, and those that a
    tokenizer does not give back byte for byte, have empty arrays. Whole texts are tokenized, long ones alone; repeated rows are
    aligned each; an empty table gives an empty one.
    """

    def arrays(done: Aligned) -> list[pa.Array]:
        per_group = [np.repeat(x[:-1], np.diff(done.groups)) for x in (done.a_first, done.b_first)]
        return [
            _lists(done.a_first, done.a, pa.int32()),
            _lists(done.b_first, done.b, pa.int32()),
            _lists(done.groups, done.a_cut - per_group[0], pa.int32()),
            _lists(done.groups, done.b_cut - per_group[1], pa.int32()),
        ]

    return _mapped(docs, text, [(name, T.ArrayType(T.IntegerType())) for name in ("a_ids", "b_ids", "a_ends", "b_ends")], arrays, a_path, b_path)


def align_digests(docs: DataFrame, text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """As ``align``, but with ``n_a, n_b, n_groups, n_links`` and ``groups_sha256`` in place of the tokens and groups.

    The hash (lowercase hex, '' without tokens) is that of ``a1,a2|b1;a3|b2,b3``: the ids of every group.
    """

    def arrays(done: Aligned) -> list[pa.Array]:
        line, bounds = done.lines()
        hashes = [hashlib.sha256(line[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(bounds[:-1], bounds[1:])]
        links = np.bincount(np.searchsorted(done.a_first, done.a_link, "right") - 1, minlength=len(hashes)).astype(np.int64)
        return [pa.array(x) for x in (np.diff(done.a_first), np.diff(done.b_first), np.diff(done.groups), links)] + [pa.array(hashes, pa.string())]

    added = [(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")] + [("groups_sha256", T.StringType())]
    return _mapped(docs, text, added, arrays, a_path, b_path)


def _lists(bounds: np.ndarray, values: np.ndarray, type_: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, type_))


def _mapped(docs: DataFrame, text: str, added: list, arrays: Callable[[Aligned], list[pa.Array]], a_path: str | None, b_path: str | None) -> DataFrame:
    added = [*added, ("pairs", T.ArrayType(T.LongType())), ("pair_links", T.ArrayType(T.IntegerType()))]
    kept = [c for c in docs.columns if c not in (*[n for n, _ in added], text)]
    docs = docs.select(*[f"`{c}`" for c in kept], F.col(text).alias("_aligned_text"))
    kind = T.StructType([docs.schema[c] for c in kept])
    for name, type_ in added:
        kind = kind.add(name, type_)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        for batch in batches:
            texts = batch.column(len(kept))
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            first = 0
            while first < len(texts):
                last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + CHUNK, "right")))
                done = Aligned(*both.encode(texts.slice(first, last - first).to_pylist()), both.a_lengths, both.b_lengths)
                bounds, pairs, links = done.pairs()
                rest = [batch.column(i).slice(first, last - first) for i in range(len(kept))]
                new = [*arrays(done), _lists(bounds, pairs, pa.int64()), _lists(bounds, links, pa.int32())]
                yield pa.RecordBatch.from_arrays([*rest, *new], kind.names)
                first = last

    return docs.mapInArrow(run, kind)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, links, best``: the links of every id pair over all documents, and whether no pair with its B id has more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for batch in batches:
            pairs = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            links = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            kinds, code = np.unique(np.append(held[0], pairs), return_inverse=True)
            held = [kinds, np.bincount(code, np.append(held[1], links), len(kinds)).astype(np.int64)]
            if len(kinds) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["pair", "links"])
                held = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["pair", "links"])

    partial = aligned.select("pairs", "pair_links").mapInArrow(run, "pair bigint, links bigint")
    counts = durable(partial.groupBy("pair").agg(F.sum("links").alias("links")), "alignment-counts")
    b_id = F.pmod(F.col("pair"), F.lit(PAIR))
    most = counts.groupBy(b_id.alias("_b")).agg(F.max("links").alias("_most"))  # one row an id of B's vocabulary
    judged = counts.withColumn("_b", b_id).join(most, "_b")
    return judged.select("pair", "links", (F.col("links") == F.col("_most")).alias("best"))


def score(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` without its arrays of pairs, with ``n_best`` (links whose pair is best) and ``count_sum`` (counts over all links)."""
    counts = durable(counts, "alignment-best")
    n = counts.count()
    blocks = max(1, -(-n // BLOCK))
    numbered = counts if blocks == 1 else durable(counts.withColumn("_block", F.pmod(F.xxhash64("pair"), F.lit(blocks))), "alignment-blocks")
    kept = [c for c in aligned.columns if c not in ("n_best", "count_sum")]
    scored = aligned.select(*[f"`{c}`" for c in kept], F.lit(0).cast("bigint").alias("n_best"), F.lit(0).cast("bigint").alias("count_sum"))
    written = None
    for block in range(blocks):
        rows = numbered if blocks == 1 else numbered.where(F.col("_block") == block)
        table = rows.select("pair", "links", "best").toArrow()
        order = np.argsort(table["pair"].to_numpy())
        shared = aligned.sparkSession.sparkContext.broadcast([table[c].to_numpy()[order] for c in ("pair", "links", "best")])
        scored = scored.mapInArrow(_adder(scored.columns, shared), scored.schema)
        if block + 1 < blocks:
            scored, done = durable(scored, "alignment-scored"), written
            written = scored
            shared.unpersist()
            if done is not None:
                discard(done)
    return scored.drop("pairs", "pair_links")


def _adder(names: list[str], shared):
    places = [names.index(c) for c in ("pairs", "pair_links", "n_best", "count_sum")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, links, best = shared.value
        for batch in batches:
            own, times = batch.column(places[0]), batch.column(places[1]).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            codes = own.flatten().to_numpy(zero_copy_only=False)
            bounds = np.append(0, np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False)))
            at = np.searchsorted(pairs, codes)
            at[at == len(pairs)] = 0
            known = pairs[at] == codes if len(pairs) else np.zeros(len(codes), bool)
            at = at[known] if len(pairs) else at[:0]
            columns = list(batch.columns)
            for place, gain in ((places[2], best[at].astype(np.int64)), (places[3], links[at])):
                per_code = np.zeros(len(codes), np.int64)
                per_code[known] = gain * times[known]
                sums = np.append(0, np.cumsum(per_code))
                columns[place] = pa.array(columns[place].to_numpy(zero_copy_only=False) + np.diff(sums[bounds]))
            yield pa.RecordBatch.from_arrays(columns, names)

    return run
