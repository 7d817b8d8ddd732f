"""Benchmark passages in documents, found by spaced seeds.

A seed is a mask over a span of words: it hashes the words at some places of a window and
ignores the rest, so a window still hits when ignored words were replaced. Every window of
every benchmark item and of every document is hashed under each mask, the hashes are joined,
and a hit gives a pair and the shift between the two texts. Around the hits of a shift the
words are compared one by one: a stretch of at least ``span`` places (or the whole item, if
that is shorter) with enough equal words is an overlap.

Items shorter than the span have masks of their own length; those of fewer than
``EXACT_WORDS`` words are found where all their words follow each other. Before the join,
document hashes pass a bitmap of fixed size filled with the benchmark's hashes; what passes by
chance finds no partner in the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import cut
from .words import U64, mix, slices, windows, word_hashes

SPAN = 12
# Places of a window that count. Any three of the places are all ignored by one of the masks, so that every
# window with LEAST_EQUAL of its words equal hits.
MASKS = (
    (0, 1, 2, 4, 9, 11), (0, 1, 2, 5, 6, 7), (0, 1, 3, 4, 5, 11),
    (0, 1, 3, 7, 8, 9), (0, 2, 4, 7, 9, 10), (0, 2, 5, 8, 10, 11),
    (0, 3, 6, 9, 10, 11), (0, 4, 6, 7, 8, 10), (1, 2, 3, 4, 8, 10),
    (1, 4, 5, 6, 9, 10), (1, 6, 7, 8, 10, 11), (2, 3, 4, 6, 7, 11),
    (2, 3, 5, 6, 8, 9), (2, 3, 7, 9, 10, 11), (4, 5, 7, 8, 9, 11),
)
LEAST_WORDS = 1
EXACT_WORDS = 8
LEAST_EQUAL = 0.75
BITMAP_BITS = 1 << 26

Masks = Sequence[Sequence[int]]


def _seeds(
    masks: Masks, span: int, lengths: Sequence[int], least_equal: float, exact_words: int
) -> list[tuple[int, list[int]]]:
    """(window length, places that count) of the full masks and of those of shorter items.

    The places of a short item are dealt to two groups more than words may be replaced, and
    each mask ignores as many groups as that: replaced words lie in no more of them.
    """
    seeds = [(span, list(mask)) for mask in masks]
    for length in lengths:
        replaced = 0 if length < exact_words else length - math.ceil(least_equal * length)
        for ignored in combinations(range(replaced + 2), replaced):
            seeds.append((length, [p for p in range(length) if p % (replaced + 2) not in ignored]))
    return [(length, mask) for length, mask in seeds if mask]


def _hashed(key: str, text: str, seeds: list[tuple[int, list[int]]], whole_only: bool, bitmap=None):
    """(key, place, hash) of every window; a short item's window is the item itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else bitmap.value
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                hashes, first = word_hashes(part.column(text))
                owner = np.repeat(np.arange(part.num_rows), np.diff(first))
                start = first[owner]
                room = first[owner + 1] - np.arange(len(hashes)) if len(hashes) else np.zeros(0, np.int64)
                span = max(length for length, _ in seeds)
                rows, places, values = [], [], []
                for number, (length, mask) in enumerate(seeds):
                    at = np.flatnonzero(room >= length)
                    if whole_only and length < span:
                        at = at[(room[at] == length) & (at == start[at])]
                    if not len(at):
                        continue
                    value = mix(windows(hashes, mask, length)[at] + mix(np.array([number + 1], dtype=U64)))
                    if bits is not None:
                        slot = (value & U64(len(bits) * 8 - 1)).astype(np.int64)
                        hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
                        at, value = at[hit], value[hit]
                    rows.append(owner[at])
                    places.append(at - start[at])
                    values.append(value)
                if rows:
                    row = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key).take(pa.array(row)), pa.array(np.concatenate(places), pa.int64()),
                         pa.array(np.concatenate(values).view(np.int64))], [key, "place", "hash"])
    return run


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the hashes; it comes as at most ``bits / 64`` words, however many hashes there are."""
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(slot, 3).alias("byte"), slot.bitwiseAND(F.lit(7)).cast("int").alias("bit"))
    rows = words.groupBy("byte").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("set")).toPandas()
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    bitmap[rows["byte"].to_numpy(dtype=np.int64)] = rows["set"].to_numpy(dtype=np.uint8)
    return bitmap


def _overlaps(span: int, least_equal: float, exact_words: int):
    """The best overlap of each (document, item) row: whole texts compared along the shifts hit."""
    def best(doc: np.ndarray, item: np.ndarray, shifts: list[int]):
        top = None
        need = min(span, len(item))
        share = 1 if len(item) < exact_words else least_equal
        for shift in shifts:
            low, high = max(0, -shift), min(len(item), len(doc) - shift)
            equal = (item[low:high] == doc[low + shift:high + shift]).astype(np.int64)
            if len(equal) < need:
                continue
            sums = np.r_[0, np.cumsum(equal)]
            good = np.flatnonzero(sums[need:] - sums[:-need] >= share * need)
            if not len(good):
                continue
            start, stop = int(good[0]), int(good[-1]) + need
            matched = int(sums[stop] - sums[start])
            row = (matched, stop - start, -(low + start + shift), -(low + start))
            top = row if top is None or row > top else top
        return top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                docs, first = word_hashes(part.column("text"))
                items, item_first = word_hashes(part.column("item_text"))
                found = []
                for row, shifts in enumerate(part.column("shifts").to_pylist()):
                    top = best(docs[first[row]:first[row + 1]], items[item_first[row]:item_first[row + 1]], sorted(shifts))
                    if top:
                        found.append((row, -top[2], -top[3], top[1], top[0]))
                columns = list(zip(*found, strict=True)) if found else [[]] * 5
                rows = pa.array(columns[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), part.column("item_id").take(rows),
                     *[pa.array(c, pa.int64()) for c in columns[1:]]],
                    ["doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal"])
    return run


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    masks: Masks = MASKS,
    span: int = SPAN,
    least_words: int = LEAST_WORDS,
    exact_words: int = EXACT_WORDS,
    least_equal: float = LEAST_EQUAL,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words, n_equal): the best overlap of each pair.

    ``doc_word`` and ``item_word`` count words from 0. Null or empty texts overlap with
    nothing, rows without an id are left out, and rows that repeat an id count as one text
    each, of which the best overlap is kept. Only the ids and texts are read. ``masks`` have to
    ignore together as many places of a window, wherever they are, as ``least_equal`` lets differ.
    """
    items = benchmark.select("item_id", F.col("text").alias("item_text")).where("item_id IS NOT NULL")
    source = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    # Lengths below the span only: at most ``span`` numbers.
    length = F.size(F.regexp_extract_all("item_text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    short = sorted(r[0] for r in items.select(length.alias("n")).where(f"n >= {least_words} AND n < {span}").distinct().collect())
    seeds = _seeds(masks, span, short, least_equal, exact_words)
    seen = cut(items.mapInArrow(
        _hashed("item_id", "item_text", seeds, True), "item_id bigint, place bigint, hash bigint"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(seen, bitmap_bits))
    hits = source.mapInArrow(
        _hashed("doc_id", "text", seeds, False, bitmap), "doc_id bigint, place bigint, hash bigint")
    pairs = hits.join(seen.withColumnRenamed("place", "item_place"), "hash").select(
        "doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    # A pair has at most as many shifts as its texts have places.
    pairs = cut(pairs.groupBy("doc_id", "item_id").agg(F.collect_list("shift").alias("shifts")))
    texts = source.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    both = pairs.join(texts, "doc_id").join(items, "item_id")
    found = both.select("doc_id", "item_id", "shifts", "text", "item_text").mapInArrow(
        _overlaps(span, least_equal, exact_words),
        "doc_id bigint, item_id bigint, doc_word bigint, item_word bigint, n_words bigint, n_equal bigint")
    order = F.struct("n_equal", "n_words", -F.col("doc_word"), -F.col("item_word"))
    kept = ("doc_word", "item_word", "n_words", "n_equal")
    best = found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct(*kept), order).alias("best"))
    return best.select("doc_id", "item_id", *[F.col(f"best.{c}").alias(c) for c in kept])
