"""Byte-level BPE by dynamic programming over byte prefixes.

Every prefix of a byte string has one encoding, and so one last token. Given the last token of
every shorter prefix, that of a prefix is the one token that ends there and may follow the
last token of what lies before it; whether a pair may stand side by side does not depend on
the rest. The last tokens are stored per byte; following them back from the end gives the
ids. Appending bytes adds entries and changes none, so it is exact, and after an edit only
the parts (matches of the split pattern) around it are encoded again.

A pair may not stand side by side if some piece at the end of the left token and some piece
at the start of the right one, both there at one time of merging, would have merged first.

Parts repeat, so each task keeps the ids of parts it has seen, in two generations of bounded
size: what is used again survives when the older one is dropped.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .recent import Recent

KEPT_PARTS = 300_000  # of a generation
KEPT_BYTES = 48  # longer parts are encoded each time
KEPT_PAIRS = 400_000  # of a generation
WALK = 16_384  # parts or ids handled at once
WHOLE_TEXT = 1 << 19  # characters up to which a text is split at once
LOOKAHEAD = 8  # characters beyond a part that the split pattern may look at
_NEVER = 1 << 30


class Vocabulary:
    """Ranks of byte strings, as BPE merges them: the pair whose joined string has the lowest rank first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte needs a token")
        self.halves: dict[int, tuple[int, int] | None] = {ranks[bytes([b])]: None for b in range(256)}
        self.longest = max(map(len, ranks))
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self._learn(token, rank):
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.pairs = Recent(KEPT_PAIRS)

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """Ids by merging pairs outright, down to ``least`` pieces; for the short strings of tokens."""
        ids, ranks, tokens = [self.ranks[bytes([b])] for b in data], self.ranks, self.tokens
        while len(ids) > least:
            best, at = min((ranks.get(tokens[a] + tokens[b], _NEVER), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
            if best == _NEVER:
                break
            ids[at:at + 2] = [best]
        return ids

    def _learn(self, token: bytes, rank: int) -> bool:
        """Note the two tokens that a token is made of; False if merging never makes it."""
        if len(token) == 1:
            return True
        halves = self.merged(token, 2)
        if len(halves) != 2:
            return False
        if max(halves) > rank:
            raise ValueError("a token must have a higher rank than the two it is made of")
        self.halves[rank] = (halves[0], halves[1])
        return True

    def beside(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side in an encoding."""
        key = left * _NEVER + right
        found = self.pairs.get(key)
        if found is None:
            self.pairs.put(key, found := 1 + self._beside(left, right))
        return found == 2

    def _beside(self, left: int, right: int) -> bool:
        """Go back through the merges on both sides of the border, the latest first."""
        ranks, tokens, halves = self.ranks, self.tokens, self.halves
        left_until = right_until = _NEVER  # when the piece merges within its own token
        while True:
            joined = ranks.get(tokens[left] + tokens[right], _NEVER)
            # Of merges of one rank the one further left comes first.
            if joined < left_until and joined <= right_until and joined != _NEVER:
                return False
            made, parts = halves[left], halves[right]
            if made is None and parts is None:
                return True
            if parts is None or (made is not None and left > right):
                left_until, left = left, made[1]
            else:
                right_until, right = right, parts[0]


class Prefixes:
    """Last token of every prefix of one part; grows by :meth:`append`."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", array("i")
        self.append(data)

    def append(self, data: bytes) -> None:
        """Exact for any border: earlier entries never change."""
        if not data:
            return
        vocabulary, known = self.vocabulary, len(self.last)
        # Tokens that end in the new bytes start at most the longest token before them.
        start = max(0, known - vocabulary.longest)
        self.data += data
        last, beside, seen = self.last, vocabulary.beside, vocabulary.pairs.new.get
        last.extend([-1] * len(data))
        for end, (length, token) in vocabulary.automaton.iter(self.data[start:].decode("latin-1")):
            end += start
            if end < known or last[end] >= 0:
                continue
            before = end - length
            if before >= 0:
                found = seen(last[before] * _NEVER + token)
                if found == 1 or (found is None and not beside(last[before], token)):
                    continue
            last[end] = token

    def truncate(self, length: int) -> None:
        """Back to a shorter prefix, whose entries are there already."""
        self.data = self.data[:length]
        del self.last[length:]

    def ids(self) -> array:
        vocabulary, at, found = self.vocabulary, len(self.last) - 1, array("i")
        whole = vocabulary.ranks.get(self.data)
        if whole is not None:  # a part that is a token is that token, whether or not merging makes it
            return array("i", [whole])
        while at >= 0:
            token = self.last[at]
            found.append(token)
            at -= len(vocabulary.tokens[token])
        found.reverse()
        return found


class Encoder:
    """Texts to ids and back for one vocabulary and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary, self.pattern = Vocabulary(ranks), regex.compile(pattern)
        self.parts = Recent(KEPT_PARTS)
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        self.lengths, self.starts = lengths, np.r_[0, np.cumsum(lengths)[:-1]]
        by_rank = sorted((rank, token) for token, rank in ranks.items())
        self.bytes = np.frombuffer(b"".join(token for _, token in by_rank), dtype=np.uint8)

    def part(self, text: str) -> bytes:
        """Ids of one match of the pattern, as 32-bit numbers."""
        found = self.parts.get(text)
        if found is None:
            data = text.encode()
            found = Prefixes(self.vocabulary, data).ids().tobytes()
            if len(data) <= KEPT_BYTES:
                self.parts.put(text, found)
        return found

    def _matches(self, text: str) -> Iterator[list[str]]:
        if len(text) <= WHOLE_TEXT:
            yield self.pattern.findall(text)
            return
        matches = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(matches, WALK)):
            yield some

    def encoded(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, some parts at a time."""
        for parts in self._matches(text):
            found = list(map(self.parts.new.get, parts))
            if None in found:
                found = [self.part(part) if ids is None else ids for part, ids in zip(parts, found, strict=True)]
            ids = np.frombuffer(b"".join(found), dtype=np.int32)
            for at in range(0, len(ids), WALK):
                yield ids[at:at + WALK]

    def decoded(self, ids: Sequence[int] | np.ndarray) -> bytes:
        """The bytes of some ids."""
        ids = np.asarray(ids, dtype=np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.bytes[places].tobytes()


class Document:
    """An encoded text that follows appends and edits without being encoded anew."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, text
        self.parts = [(m.start(), encoder.part(m.group())) for m in encoder.pattern.finditer(text)]

    @property
    def ids(self) -> list[int]:
        return np.frombuffer(b"".join(part for _, part in self.parts), dtype=np.int32).tolist()

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, text: str) -> int:
        """Put ``text`` in the place of the characters from start to end; returns the parts encoded again.

        Parts that begin at a border depend on what follows only, and on no more than
        ``LOOKAHEAD`` characters beyond their end. So parts that end well before the edit
        stay, and from the first border after the edit that was one before, all stay.
        """
        shift, borders = len(text) - (end - start), [at for at, _ in self.parts]
        self.text = self.text[:start] + text + self.text[end:]
        kept = int(np.searchsorted(borders, max(0, start - LOOKAHEAD), side="right")) - 1
        kept = max(kept, 0)
        at = borders[kept] if borders else 0
        old = {border + shift: number for number, border in enumerate(borders) if border >= end}
        fresh = []
        for match in self.encoder.pattern.finditer(self.text, at):
            if match.start() >= start + len(text) and match.start() in old:
                number = old[match.start()]
                rest = [(border + shift, part) for border, part in self.parts[number:]]
                break
            fresh.append((match.start(), self.encoder.part(match.group())))
        else:
            rest = []
        self.parts = [*self.parts[:kept], *fresh, *rest]
        return len(fresh)


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> Encoder:
    """One per worker and vocabulary."""
    return Encoder(read_ranks(path), pattern)


def _column(batch: pa.RecordBatch, name: str) -> list[str]:
    return [value or "" for value in batch.column(name).to_pylist()]


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        for batch in batches:
            counts, hashes, texts = [], [], []
            for text in _column(batch, "text"):
                count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                for ids in encoder.encoded(text):
                    ids_hash.update(("," * (count > 0) + ",".join(map(str, ids.tolist()))).encode())
                    text_hash.update(encoder.decoded(ids))
                    count += len(ids)
                counts.append(count)
                hashes.append(ids_hash.hexdigest())
                texts.append(text_hash.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()),
                 pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _ids(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        for batch in batches:
            ids = [np.concatenate([*encoder.encoded(text), np.zeros(0, np.int32)]) for text in _column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return run


def _texts(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        for batch in batches:
            decoded = [None if ids is None else b"".join(
                encoder.decoded(ids[at:at + WALK]) for at in range(0, len(ids), WALK))
                for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(decoded, pa.binary())], ["doc_id", "data"])
    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row; a null or empty text has no ids. Only ``doc_id`` and ``text`` are read.

    ``path`` is the vocabulary's file on every executor. Special tokens are ordinary text.
    """
    return docs.select("doc_id", "text").mapInArrow(_ids(path, pattern), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data) of (doc_id, ids): the bytes, which need not be UTF-8 for ids of other origin; null for null."""
    return encoded.select("doc_id", "ids").mapInArrow(_texts(path, pattern), "doc_id bigint, data binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, repeated ones and ones without an id too.

    The ids are hashed as decimals joined by commas, the decoded bytes as they are. A null
    text is an empty one. Texts are walked some parts at a time, so a long one costs no more
    memory than its own bytes and, for a part without a border, the table of that part.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _digests(path, pattern), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
