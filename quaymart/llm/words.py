"""Word and shingle hashes of whole Arrow columns of text, in numpy.

A word is a run of bytes other than the six white-space bytes, with A-Z lower-cased. Its
hash is a polynomial over random byte values, taken from one running sum over the text, so
no Python object is made per word. Work memory is bounded by a chunk of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C17
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_space = np.zeros(256, dtype=bool)
_space[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_lower = np.arange(256)
_lower[65:91] += 32
_value = mix(np.arange(1, 257, dtype=U64))[_lower]
_place = mix(np.arange(1001, 1065, dtype=U64)) | U64(1)
_powers: list[np.ndarray] = []


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < length:
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(max(length, CHUNK), base, dtype=U64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=U64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null is an empty text."""
    texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets if len(offsets) else np.zeros(1, dtype=np.int64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, index of the first word of every text and the total).

    The bytes are walked a chunk at a time. A word that a chunk cuts is carried over, its
    polynomial going on where it stopped, so a text without white space needs no more memory.
    """
    data, offsets = text_bytes(texts)
    at, end = int(offsets[0]), int(offsets[-1])
    found, places = [], []
    held: tuple[int, int, int] | None = None  # polynomial, length and place of a word that goes on

    def begins(position: int) -> bool:
        return int(offsets[np.searchsorted(offsets, position)]) == position

    def emit(raw: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> None:
        found.append(mix(raw + lengths.astype(U64)))
        places.append(place)

    while at < end:
        stop = min(at + CHUNK, end)
        part = data[at:stop]
        space = _space[part]
        breaks = np.zeros(len(part), dtype=bool)
        inside = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)] - at
        breaks[inside] = True
        before = np.empty(len(part), dtype=bool)
        before[0] = True
        before[1:] = space[:-1] | breaks[1:]
        after = np.empty(len(part), dtype=bool)
        after[-1] = True
        after[:-1] = space[1:] | breaks[1:]
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(~space & after) + 1
        powers, inverses = _power_tables(len(part))
        values = _value[part]
        values *= powers[:len(part)]
        sums = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(values, out=sums[1:])
        raw, lengths, place = (sums[ends] - sums[starts]) * inverses[starts], ends - starts, starts + at
        if held is not None:
            if space[0] or breaks[0]:
                emit(np.array([held[0]], dtype=U64), np.array([held[1]]), np.array([held[2]]))
            else:
                raw[0] = (held[0] + int(raw[0]) * pow(_BASE, held[1], 1 << 64)) & ((1 << 64) - 1)
                lengths[0] += held[1]
                place[0] = held[2]
            held = None
        if stop < end and not space[-1] and not begins(stop):
            held = int(raw[-1]), int(lengths[-1]), int(place[-1])
            raw, lengths, place = raw[:-1], lengths[:-1], place[:-1]
        emit(raw, lengths, place)
        at = stop
    if held is not None:
        emit(np.array([held[0]], dtype=U64), np.array([held[1]]), np.array([held[2]]))
    if not found:
        return np.zeros(0, dtype=U64), np.zeros(len(offsets), dtype=np.int64)
    place = np.concatenate(places)
    return np.concatenate(found), np.searchsorted(place, offsets).astype(np.int64)


def windows(hashes: np.ndarray, kept: list[int], span: int) -> np.ndarray:
    """Hash of the window at every word: its words at the ``kept`` places of ``span``."""
    count = len(hashes) - span + 1
    if count <= 0:
        return np.zeros(0, dtype=U64)
    total = np.zeros(count, dtype=U64)
    for place in kept:
        total += hashes[place:place + count] * _place[place]
    return mix(total)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; a shorter text is one shingle."""
    hashes, first = word_hashes(texts)
    every = windows(hashes, list(range(size)), size)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(every[a:b - size + 1]))
        elif b > a:
            whole = (hashes[a:b] * _place[:b - a]).sum(dtype=U64)
            sets.append(mix(np.array([whole + U64(b - a)], dtype=U64)))
        else:
            sets.append(np.zeros(0, dtype=U64))
    return sets


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Parts of a batch with about ``limit`` bytes of text each, so that work memory stays bounded."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        stop = min(max(stop, at + 1), batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop
