"""Greedy longest-match word pieces, counted by an automaton in linear time.

The trie of the vocabulary gets failure links: where a word cannot go on from a node, the node's pieces are popped and
the link leads to the node for the rest. Only the number of popped pieces is stored, so pieces are never built. Many
words walk side by side in numpy, each distinct word of a chunk once.
"""

from __future__ import annotations

import functools
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import VISIBLE, Words, byte_column, chunks

#: Marks a piece that starts a word; pieces without it continue one.
WORD_START = "▁"
NONE = -1


class Automaton:
    """Nodes 0 (start of a word) and 1 (inside a word) are the roots; ``pops[n]`` pieces are done when ``fail[n]`` is taken."""

    def __init__(self, first: set[bytes], later: set[bytes]):
        children: list[dict[int, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((0, first), (1, later)):
            for piece in sorted(p for p in pieces if p):
                node = root
                for byte in piece:
                    if byte not in children[node]:
                        children[node][byte] = len(children)
                        children.append({})
                        whole.append(False)
                    node = children[node][byte]
                whole[node] = True
        fail, pops = [NONE] * len(children), [0] * len(children)
        if b"" in first:  # the mark of a word's start is a piece of its own
            fail[0], pops[0] = 1, 1
        todo = deque([0, 1])
        while todo:
            above = todo.popleft()
            for byte, node in children[above].items():
                if whole[node]:
                    fail[node], pops[node] = 1, 1
                else:
                    rest, done = fail[above], pops[above]
                    while rest != NONE and byte not in children[rest]:
                        done += pops[rest]
                        rest = fail[rest]
                    if rest != NONE:
                        fail[node], pops[node] = children[rest][byte], done
                todo.append(node)
        self.fail, self.pops = np.array(fail, np.int32), np.array(pops, np.int32)
        keys = np.array([n * 256 + b for n, c in enumerate(children) for b in c], np.int64)
        values = np.array([v for c in children for v in c.values()], np.int32)
        self.bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):  # open addressing: whoever gets a free slot stays, the others step on
            free = self.keys[slot[left]] < 0
            trial = left[free]
            self.keys[slot[trial]] = keys[trial]
            settled = trial[self.keys[slot[trial]] == keys[trial]]
            self.values[slot[settled]] = values[settled]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def child(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        keys = nodes.astype(np.int64) * 256 + symbols
        slot = self._slot(keys)
        out = np.full(len(keys), NONE, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            seen = self.keys[slot[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word, 0 for words that the vocabulary cannot spell."""
        node, total = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int64)
        lost = np.zeros(len(starts), bool)
        order = np.argsort(ends - starts, kind="stable")[::-1]
        lengths = (ends - starts)[order]
        for at in range(int(lengths[0]) if len(lengths) else 0):
            lanes = order[: np.searchsorted(-lengths, -at, "left")]
            lanes = lanes[~lost[lanes]]
            if not len(lanes):
                break
            while len(lanes):
                below = self.child(node[lanes], data[starts[lanes] + at])
                went = below != NONE
                node[lanes[went]] = below[went]
                lanes = self._fall(lanes[~went], node, total, lost)
        ending = np.flatnonzero(~lost & (node != 1))
        while len(ending):
            ending = self._fall(ending, node, total, lost)
            ending = ending[node[ending] != 1]
        total[lost] = 0
        return total

    def _fall(self, lanes: np.ndarray, node: np.ndarray, total: np.ndarray, lost: np.ndarray) -> np.ndarray:
        total[lanes] += self.pops[node[lanes]]
        node[lanes] = self.fail[node[lanes]]
        gone = node[lanes] == NONE
        lost[lanes[gone]] = True
        return lanes[~gone]


def sentencepiece_vocabulary(path: str | None = None) -> tuple[set[bytes], set[bytes]]:
    """Pieces that start words (without their mark) and pieces that continue them; control, unknown and byte pieces left out."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    first, later = set(), set()
    for k in range(model.vocab_size()):
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k)):
            piece = model.id_to_piece(k)
            (first if piece.startswith(WORD_START) else later).add(piece.removeprefix(WORD_START).encode())
    return first, later


@functools.cache
def automaton(path: str | None = None) -> Automaton:
    """One per Python worker, from the installed vocabulary file or the one at ``path``."""
    return Automaton(*sentencepiece_vocabulary(path))


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``n_tokens`` and ``n_unknown`` added, replacing columns of these names.

    Words are runs without ASCII white space. A word is cut greedily into the longest pieces of the vocabulary; a word
    that cannot be cut counts as one token and as unknown. Null, empty and blank texts have no words. ``vocabulary``: path of a
    sentencepiece model; None: the installed one.
    """
    docs = docs.drop("n_words", "n_tokens", "n_unknown")
    kind = T.StructType([*docs.schema.fields])
    for name in ("n_words", "n_tokens", "n_unknown"):
        kind = kind.add(name, T.LongType())

    def run(batches):
        machine = automaton(vocabulary)
        for batch in batches:
            data, bounds = byte_column(batch.column(batch.schema.get_field_index(text)))
            out = np.zeros((3, batch.num_rows), np.int64)
            for a, z in chunks(bounds):
                piece = data[bounds[a] : bounds[z]]
                words = Words(piece, bounds[a : z + 1] - bounds[a], VISIBLE, lower=False)
                _, sample, back = np.unique(words.hashes, return_index=True, return_inverse=True)
                counts = machine.count(piece, words.starts[sample], words.ends[sample])[back]
                unknown = counts == 0
                sums = [np.append(0, np.cumsum(x)) for x in (np.ones(len(back), np.int64), counts + unknown, unknown)]
                for k in range(3):
                    out[k, a:z] = np.diff(sums[k][words.first])
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out)], [*batch.schema.names, "n_words", "n_tokens", "n_unknown"])

    return docs.mapInArrow(run, kind)
