"""Token counts of a unigram model, computed along a trie of pre-tokens.

The pieces are those of a public byte-level vocabulary, each with a score by its rank (the
logarithm of a Zipf share); a pre-token's segmentation is the one of the largest sum of
scores. Every task puts the distinct pre-tokens it meets into a trie. A node is a prefix: it
keeps the best score of the prefix, the pieces in it, and which vocabulary pieces may still
go on there, all from its parent's, so a prefix that many pre-tokens share is computed once.
The count at a pre-token's last node is kept by pre-token, in two generations: those met
again survive when the older one goes. A trie that reaches its size is begun anew, which
changes no count and forgets none. Prefixes beyond a depth are followed without being kept,
so a pre-token of any length takes no more memory.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator
from operator import mul

import pyarrow as pa
from pyspark.sql import DataFrame

from .recent import Recent
from .words import slices

NODES = 400_000
DEPTH = 48  # bytes of a pre-token that are kept in the trie
COUNTS = 300_000  # of a generation
OFFSET = 2.7  # of the Zipf law


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def piece_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Logarithm of a Zipf share by rank."""
    total = math.log(sum(1 / (rank + OFFSET) for rank in ranks.values()))
    return {piece: -math.log(rank + OFFSET) - total for piece, rank in ranks.items()}


class PrefixTrie:
    """Best segmentations of all prefixes of the pre-tokens seen."""

    def __init__(self, scores: dict[bytes, float], nodes: int = NODES):
        self.limit = nodes
        # The vocabulary as a trie of its own: (node, byte) → node, and the score of a whole piece.
        self.onward: dict[int, int] = {}
        self.score: list[float | None] = [None]
        for piece, score in scores.items():
            at = 0
            for byte in piece:
                key = at << 8 | byte
                if key not in self.onward:
                    self.onward[key] = len(self.score)
                    self.score.append(None)
                at = self.onward[key]
            self.score[at] = score
        self.least = min(scores.values(), default=0.0) - 10  # of a byte that no piece has
        self.counts = Recent(COUNTS)
        self.clear()

    def clear(self) -> None:
        """Begin the trie anew; counts stay."""
        self.child: dict[int, int] = {}
        self.best, self.pieces, self.open = [0.0], [0], [()]

    def _step(self, state: tuple, byte: int) -> tuple:
        """(best score, pieces, open pieces) after a byte: extend every piece that is open, and one begun here."""
        reached, made, opened = state
        still, best, pieces = [], None, 0
        for at, before, count in (*opened, (0, reached, made)):
            found = self.onward.get(at << 8 | byte)
            if found is None:
                continue
            still.append((found, before, count))
            score = self.score[found]
            if score is not None and (best is None or (before + score, -count - 1) > (best, -pieces)):
                best, pieces = before + score, count + 1
        if best is None:
            best, pieces = reached + self.least, made + 1
        return best, pieces, tuple(still)

    def _grow(self, parent: int, byte: int) -> int:
        best, pieces, still = self._step((self.best[parent], self.pieces[parent], self.open[parent]), byte)
        self.best.append(best)
        self.pieces.append(pieces)
        self.open.append(still)
        return len(self.best) - 1

    def count(self, word: str) -> int:
        """Pieces of a pre-token; its new prefixes are added to the trie."""
        known = self.counts.get(word)
        if known is not None:
            return known
        data = word.encode()
        if len(self.best) + DEPTH > self.limit:
            self.clear()
        at = 0
        for byte in data[:DEPTH]:
            key = at << 8 | byte
            child = self.child.get(key)
            if child is None:
                child = self.child[key] = self._grow(at, byte)
            at = child
        pieces = self.pieces[at]
        if len(data) > DEPTH:
            state = (self.best[at], pieces, self.open[at])
            for byte in data[DEPTH:]:
                state = self._step(state, byte)
            return state[1]  # too long to be worth keeping
        self.counts.put(word, pieces)
        return pieces

    def total(self, words: dict[str, int]) -> int:
        """Pieces of pre-tokens, each as often as it occurs."""
        found = list(map(self.counts.new.get, words))
        if None in found:
            found = [self.count(word) if n is None else n for word, n in zip(words, found, strict=True)]
        return sum(map(mul, found, words.values()))


def _counted(path: str, pattern: str, nodes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, trie = regex.compile(pattern), PrefixTrie(piece_scores(load_ranks(path)), nodes)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = []
                for text in part.column("text").to_pylist():
                    words = Counter(split.findall(text or ""))
                    rows.append((trie.total(words), sum(words.values()), len(words), len((text or "").encode())))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(list(c), pa.int64()) for c in columns]],
                    ["doc_id", "n_tokens", "n_pretokens", "n_distinct", "n_bytes"])
    return run


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, *, nodes: int = NODES) -> DataFrame:
    """(doc_id, n_tokens, n_pretokens, n_distinct, n_bytes) of every row, over its whole text.

    ``pattern`` cuts a text into pre-tokens. A null or empty text counts zero; ids are passed
    on as they are, and other columns are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _counted(ranks_path, pattern, nodes),
        "doc_id bigint, n_tokens bigint, n_pretokens bigint, n_distinct bigint, n_bytes bigint")
