"""Token counts by greedy longest match in linear time.

The vocabulary is a trie whose nodes carry failure links: where no longer match is possible, the link leads to the node
that has read the same characters after the longest pieces were cut off, and a number says how many pieces those were
(Song et al., Fast WordPiece Tokenization, 2021). So a word's number of pieces is a walk with sums; no piece is built.

All distinct words of a batch walk side by side: one step of the walk is a lookup of (node, byte) in a sorted table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from learnlake.llm.common import fresh, in_slices, utf8

SLICE_BYTES = 4 << 20
# Longer words walk one by one, so that a batch's table of characters stays small.
LONG_WORD = 48
# In the trie's alphabet of bytes: what stands before the first byte of a word.
START = 32


class Automaton:
    """Longest-match counts over byte strings; pieces that begin a word begin with a space.

    Every single byte has to be a piece, with and without the space, or else a word may be unknown, which counts as one.
    """

    def __init__(self, pieces: Iterable[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    final.append(False)
                node = children[node][byte]
            final[node] = True
        n = len(children)
        # Breadth first, a node's link is found from its parent's: follow links, summing what they pop, to a child.
        self.link, self.pops = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        depth_first = 0
        order = [0]
        while depth_first < len(order):
            node = order[depth_first]
            depth_first += 1
            for byte, child in children[node].items():
                order.append(child)
                if final[child]:
                    # The whole string is a piece: cut it off and start again at the root.
                    self.link[child], self.pops[child] = 0, 1
                    continue
                at, popped = int(self.link[node]), int(self.pops[node])
                while at >= 0 and byte not in children[at]:
                    popped += int(self.pops[at])
                    at = int(self.link[at])
                if at >= 0:
                    self.link[child], self.pops[child] = children[at][byte], popped
        edges = sorted((node << 8 | byte, child) for node, kids in enumerate(children) for byte, child in kids.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([c for _, c in edges], np.int64)

    def _child(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        wanted = nodes << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.to[at], -1)

    def _walk(self, node: np.ndarray, total: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One byte further; node -1 means that no pieces fit."""
        out, open_ = np.full(len(node), -1, np.int64), np.arange(len(node))
        at = node.copy()
        while len(open_):
            found = self._child(at[open_], byte[open_])
            done = found >= 0
            out[open_[done]] = found[done]
            open_ = open_[~done]
            total[open_] += self.pops[at[open_]]
            at[open_] = self.link[at[open_]]
            open_ = open_[at[open_] >= 0]
        return out, total

    def _rest(self, node: np.ndarray, total: np.ndarray) -> np.ndarray:
        """What remains at the end of the words is cut off as well."""
        at, known = node.copy(), node >= 0
        while (open_ := np.flatnonzero(known & (at > 0))).size:
            total[open_] += self.pops[at[open_]]
            at[open_] = self.link[at[open_]]
            known[open_[at[open_] < 0]] = False
        return np.where(known, total, 1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each non-empty word."""
        lengths = np.array([len(w) for w in words], np.int64)
        out = np.zeros(len(words), np.int64)
        short = np.flatnonzero(lengths <= LONG_WORD)
        short = short[np.argsort(-lengths[short], kind="stable")]
        if len(short):
            out[short] = self._short([words[i] for i in short.tolist()], lengths[short])
        for i in np.flatnonzero(lengths > LONG_WORD).tolist():
            out[i] = self._long(words[i])
        return out

    def _short(self, words: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """Words by falling length, so that those still walking are always the first ones."""
        width = int(lengths[0])
        letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        node, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        node, total = self._walk(node, total, np.full(len(words), START, np.int64))
        for k in range(width):
            active = int(np.searchsorted(-lengths, -k, side="left"))
            alive = np.flatnonzero(node[:active] >= 0)
            node[alive], total[alive] = self._walk(node[alive], total[alive], letters[alive, k].astype(np.int64))
        return self._rest(node, total)

    @property
    def _edges(self) -> dict[int, int]:
        if not hasattr(self, "_edge_table"):
            self._edge_table = dict(zip(self.keys.tolist(), self.to.tolist(), strict=True))
            self._links, self._popped = self.link.tolist(), self.pops.tolist()
        return self._edge_table

    def _long(self, word: bytes) -> int:
        edges, node, total = self._edges, 0, 0
        for byte in chain((START,), word):
            while (child := edges.get(node << 8 | byte)) is None:
                total += self._popped[node]
                node = self._links[node]
                if node < 0:
                    return 1
            node = child
        while node > 0:
            total += self._popped[node]
            node = self._links[node]
        return total if node == 0 else 1


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file with one base64 piece and its rank per line; one per worker process."""
    return Automaton(base64.b64decode(line.split()[0]) for line in Path(path).read_bytes().splitlines() if line.strip())


def token_counts(docs: DataFrame, vocabulary: str, keys: list[str]) -> DataFrame:
    """``keys``, n_words and n_tokens of every whole text; a null or empty text has none of either.

    Words are separated by space and the ASCII controls 9 to 13.
    """
    (text,) = fresh(docs.select(*keys), "text")
    source = docs.select(*keys, utf8(docs["text"]).alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = automaton(vocabulary)
        for batch in in_slices(batches, text, SLICE_BYTES):
            words = [t.split() for t in batch.column(text).to_pylist()]
            distinct = list(set(chain.from_iterable(words)))
            count = dict(zip(distinct, pieces.counts(distinct).tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array([len(w) for w in words], pa.int64()),
                 pa.array([sum(map(count.__getitem__, w)) for w in words], pa.int64())],
                names=[*keys, "n_words", "n_tokens"])

    return source.mapInArrow(run, f"{fields}, n_words bigint, n_tokens bigint")
