"""N-gram Jaccard self-join by parity sketches, and the groups its links make.

A document is the set of its distinct word shingles. For a size band the sketch of a set
has as many words of 64 bits as the largest symmetric difference of a linked pair whose
smaller set lies in the band, plus one and some spare; every shingle XORs its hash into one
of them. A shingle that only one of two sets holds changes one word, so the number of words
that differ is at most the symmetric difference, and a linked pair agrees in at least
1 + spare words. Each word that holds a shingle is a join key (the pigeonhole join). Where a
set is so small that the words two sets agree in could all be empty, it also offers the
prefix of its ordered shingles, which two linked sets must share. The spare words serve to
leave keys out: of a set's most crowded keys, which passages shared by many texts make, as
many are dropped as can be without losing a link.

Keys give candidates in two rounds. First every set is paired with the smallest set of each
key it has (a star, never all pairs of a key). What is then linked is contracted; for the
rest, the sets of one key in different groups are joined, unless their sizes or a parity
sketch of 1,024 bits, both conditions of the join, show that they cannot be linked. Keys that
the very same sets have are joined once, and a part of the keys is joined before the others:
the links met there are contracted as well, and the other keys leave out the pairs already met. Longer sketches are compared next, and every
candidate is verified on whole sets. The groups are those of all links; pairs inside a group
already found are not listed.

Sets are compared by 64-bit shingle hashes and named by a 64-bit hash of the set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .cut import cut, release
from .thinned import thinned
from .words import U64, mix, shingle_sets, slices

SHINGLE = 5
PERCENT = 75
BAND_RATIO = 4 / 3
_WORD = U64(0xD6E8FEB86659FD93)
_BAND = U64(0xA0761D6478BD642F)
_PREFIX = U64(0x8EBC6AF09C88C6E3)
PAIRS_PER_SALT = 512
BITS_PER_SHINGLE = 4
FOLDED = 16  # numbers of 64 bits in the sketch that the join compares
PREFIX_CODE = 7  # of key codes; a set is in fewer than so many bands
CROWDED = 4  # sets of a key from which one may leave it out
KEYS_PER_EARLY = 16  # of so many keys one is joined before the others
MOST_KNOWN = 64  # partners of a set, met in those keys, that are not made again


def bands(limit: int) -> list[int]:
    """Lower ends of the size bands up to ``limit``."""
    ends = [1]
    while ends[-1] <= limit:
        ends.append(max(ends[-1] + 1, int(np.ceil(ends[-1] * BAND_RATIO))))
    return ends


def largest_difference(smaller: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of two linked sets, the smaller of this size.

    ``100 i >= percent u`` with union u and intersection i ≤ smaller gives
    difference = u − i ≤ smaller · (100 − percent) / percent. For given sizes it is at most
    their sum · (100 − percent) / (100 + percent).
    """
    return smaller * (100 - percent) // percent


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """Two linked sets share one of so many first shingles of each, in any common order."""
    return size - -(-size * percent // 100) + 1


def _bands_of(size: int, ends: list[int], percent: int) -> list[tuple[int, int, int]]:
    """(band, sketch words, largest difference) of every band in which a set may meet a partner."""
    found = []
    band, least = int(np.searchsorted(ends, size, side="right")) - 1, -(-size * percent // 100)
    while band >= 0 and ends[band + 1] - 1 >= least:
        most = largest_difference(ends[band + 1] - 1, percent)
        if most:  # else only equal sets are linked
            found.append((band, most + 1 + (most + 3) // 4, most))
        band -= 1
    return found


def sketch_keys(shingles: np.ndarray, ends: list[int], percent: int = PERCENT) -> np.ndarray:
    """The join keys of one set; their last bits say which band, or that it is of the prefix."""
    keys, sparse = [], False
    hashes = mix(shingles + _WORD)
    for band, count, most in _bands_of(len(shingles), ends, percent):
        word = shingles % U64(count)
        order = np.argsort(word, kind="stable")
        word = word[order]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        content = np.bitwise_xor.reduceat(hashes[order], first)
        key = mix(content ^ mix(word[first] * _BAND + U64(band + 1)))
        keys.append(key & ~U64(7) | U64(band % PREFIX_CODE))
        sparse |= len(first) <= most
    if sparse:
        prefix = mix(shingles[:prefix_length(len(shingles), percent)] ^ _PREFIX)
        keys.append(prefix & ~U64(7) | U64(PREFIX_CODE))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=U64)


def spare_keys(shingles: np.ndarray, ends: list[int], percent: int = PERCENT) -> list[int]:
    """By band code, how many of its keys a set can do without.

    Linked sets agree in more words than there are empty ones among them; if each leaves out
    at most half of the rest less one, a common key stays.
    """
    spare = [0] * (PREFIX_CODE + 1)
    for band, count, most in _bands_of(len(shingles), ends, percent):
        empty = count - len(np.unique(shingles % U64(count)))
        spare[band % PREFIX_CODE] = max(0, (count - most - 1 - empty) // 2)
    return spare


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bits, each the parity of the shingles that fall on it, as bytes.

    There are at least ``BITS_PER_SHINGLE`` times the shingles, and a power of two, so that a
    longer sketch folds to a shorter one by XOR of its halves.
    """
    count = max(64 * FOLDED, 1 << (BITS_PER_SHINGLE * max(1, len(shingles)) - 1).bit_length())
    places = (mix(shingles ^ _BAND) & U64(count - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=count) & 1).astype(np.uint8))


def set_name(shingles: np.ndarray) -> int:
    """One 64-bit hash of the set."""
    if not len(shingles):
        return 0
    return int(mix(np.array([mix(shingles).sum(dtype=U64) + U64(len(shingles))], dtype=U64)).view(np.int64)[0])


def _named(text: str, size: int):
    """(doc_id, node, n_shingles, text) of every row; the text of a set that this task has seen is left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = {0}
        for batch in batches:
            for part in slices(batch, text):
                sets = shingle_sets(part.column(text), size)
                names, places = [set_name(s) for s in sets], []
                for row, name in enumerate(names):
                    places.append(None if name in seen else row)
                    seen.add(name)
                texts = part.column(text).take(pa.array(places, pa.int64())).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), texts],
                    ["doc_id", "node", "n_shingles", "text"])
    return run


def _distinct_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One text of each set; all its copies are in this task."""
    seen: set[int] = set()
    for batch in batches:
        keep = []
        for row, name in enumerate(batch.column("node").to_pylist()):
            if name not in seen:
                seen.add(name)
                keep.append(row)
        yield batch.take(pa.array(keep, pa.int64()))


def _keyed(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = bands(1 << 10)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                keys, counts, names = [], [], part.column("node").to_numpy()
                for shingles in shingle_sets(part.column("text"), size):
                    if len(shingles) >= ends[-1]:
                        ends = bands(2 * len(shingles))
                    keys.append(sketch_keys(shingles, ends, percent))
                    counts.append(len(keys[-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(names, counts))],
                    ["key", "node"])
    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of their keys, those whose key another row has too.

    One row is held back from batch to batch, however long the run of a key is.
    """
    held: tuple[int, int] | None = None
    emitted = False  # whether a row of the held row's key went out
    for batch in batches:
        key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        if held is not None:
            key, node = np.r_[held[0], key], np.r_[held[1], node]
        if not len(key):
            continue
        same = key[1:] == key[:-1]
        many = np.r_[emitted, same] | np.r_[same, False]
        yield _shared(key[:-1][many[:-1]], node[:-1][many[:-1]])
        held, emitted = (int(key[-1]), int(node[-1])), bool(many[-1])
    if held is not None and emitted:
        yield _shared(np.array([held[0]]), np.array([held[1]]))


def _shared(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (key, node)], ["key", "node"])


def _compared(size: int):
    """Compare the sets of a group's rows with that of its first row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, center = None, np.zeros(0, dtype=U64)
        for batch in batches:
            for part in slices(batch, "text"):
                columns = [part.column(c).to_pylist() for c in ("a", "salt", "b")]
                found = []
                for a, salt, b, shingles in zip(*columns, shingle_sets(part.column("text"), size), strict=True):
                    if (a, salt) != group:
                        group, center = (a, salt), shingles
                        continue
                    shared = len(np.intersect1d(center, shingles, assume_unique=True))
                    found.append((a, b, shared, len(center) + len(shingles) - shared))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), pa.int64()) for x in zip(*found, strict=True)] if found
                    else [pa.array([], pa.int64())] * 4, ["a", "b", "shared", "total"])
    return run


def verify(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(a, b, shared, total): sizes of intersection and union of the sets of distinct pairs.

    Pairs travel grouped by ``a``, whose text comes once per group; a large group is split
    by a hash of ``b``. The texts of both sides are looked up by one join, to which hardly any others go.
    """
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs"))
    salt = F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / PAIRS_PER_SALT))
    salted = cut(pairs.join(counts, "a").select("a", "b", salt.alias("salt")))
    members = salted.select("a", "salt", F.lit(1).alias("turn"), "b").union(
        salted.select("a", "salt").distinct().select("a", "salt", F.lit(0), "a"))
    asked = thinned(texts.select(F.col("node").alias("b"), "text"), ["b"], members)
    grouped = (members.join(asked, "b")
               .repartition("a", "salt").sortWithinPartitions("a", "salt", "turn"))
    out = cut(grouped.select("a", "salt", "b", "text").mapInArrow(
        _compared(size), "a bigint, b bigint, shared bigint, total bigint"))
    release(salted)
    return out


def _sketches(size: int, percent: int):
    """Size, spare keys and parity sketch of every set; the sketch also folded to ``FOLDED`` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = bands(1 << 10)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                while max(map(len, sets), default=0) >= ends[-1]:
                    ends = bands(2 * ends[-1])
                spare = [spare_keys(s, ends, percent) for s in sets]
                bits = [bit_sketch(s) for s in sets]
                folded = np.array([np.bitwise_xor.reduce(b.reshape(-1, 8 * FOLDED), axis=0) for b in bits], dtype=np.uint8)
                folded = folded.reshape(-1, 8 * FOLDED).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(spare, pa.list_(pa.int32())), pa.array([b.tobytes() for b in bits], pa.binary()),
                     *[pa.array(np.ascontiguousarray(folded[:, i])) for i in range(FOLDED)]],
                    ["node", "n", "spare", "bits", *FOLDS])
    return run


FOLDS = [f"s{i}" for i in range(FOLDED)]
SKETCH = "node bigint, n bigint, spare array<int>, bits binary, " + ", ".join(f"{name} bigint" for name in FOLDS)


def _bits_apart(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Hamming distances of sketches, the longer of a pair folded to the other's length."""
    lengths = np.array([[len(x) for x in left], [len(x) for x in right]])
    apart = np.zeros(len(left), dtype=np.int64)
    for a, b in np.unique(lengths, axis=1).T.tolist():
        rows = np.flatnonzero((lengths[0] == a) & (lengths[1] == b))
        short = min(a, b)
        folded = [np.bitwise_xor.reduce(
            np.frombuffer(b"".join(side[i] for i in rows), dtype=U64).reshape(len(rows), -1, short // 8), axis=1)
            for side in (left, right)]
        apart[rows] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return apart


def _near_enough(percent: int):
    """Keep the pairs whose sketches differ in no more bits than linked sets do in shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                apart = _bits_apart(part.column("a_bits").to_pylist(), part.column("b_bits").to_pylist())
                both = part.column("a_n").to_numpy() + part.column("b_n").to_numpy()
                yield part.select(["a", "b"]).filter(pa.array(apart * (100 + percent) <= both * (100 - percent)))
    return run


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that sizes and sketches leave possible."""
    sketches = thinned(sketches.select("node", "n", "bits"), ["node"], pairs.select(F.explode(F.array("a", "b")).alias("node")))
    a = sketches.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"))
    b = sketches.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("bits").alias("b_bits"))
    sized = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    return cut(pairs.join(a, "a").join(b, "b").where(sized).mapInArrow(
        _near_enough(percent), "a bigint, b bigint"))


def _uncrowded(shared: DataFrame, sketches: DataFrame) -> DataFrame:
    """(key, node, pivot) rows without the crowded keys that sets can do without; the pivot is the key's smallest node."""
    sizes = shared.groupBy("key").count().where(F.col("count") > CROWDED)
    code = F.col("key").bitwiseAND(F.lit(7)).cast("int")
    hot = shared.join(sizes, "key").join(sketches.select("node", "spare"), "node")
    fullest = Window.partitionBy("node", code).orderBy(F.desc("count"), "key")
    dropped = hot.withColumn("turn", F.row_number().over(fullest)).where(F.col("turn") <= F.get("spare", code))
    left = cut(shared.join(dropped.select("key", "node"), ["key", "node"], "left_anti"))
    first = left.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last")
    out = cut(left.join(first.drop("last"), "key"))
    release(left)
    return out


def _meetings(rows: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """(a, b) for each key of ``rows`` and ``others`` that two sets of different groups have which may be linked.

    Pairs that ``rows`` has as ``known`` are left out.
    """
    x, y = rows.alias("x"), others.alias("y")
    apart = sum((F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in FOLDS), F.lit(0))
    smaller, larger = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    within = (
        (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
        & (smaller * 100 >= larger * percent)
        & (apart * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)))
    if "known" in rows.columns:
        within &= ~F.coalesce(F.array_contains("x.known", F.col("y.node")), F.lit(False))
    return x.join(y, (F.col("x.key") == F.col("y.key")) & within).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _rest(
    shared: DataFrame, links: DataFrame, sketches: DataFrame, percent: int,
    linked: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Pairs of one key in different groups that may still be linked.

    Two large sets may meet in hundreds of keys. So a few of all keys are joined first, and the
    pairs met there are known when the others are: what meets often comes out of the joins a few times.

    ``linked`` tells which of such pairs are linked. Given it, the links met first are contracted too, so that
    sets of a large group of near copies do not meet again, and (a, b) are ties that give the groups of all links.
    """
    groups = cut(connected_components(links))
    placed = cut(shared.join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")))
    hashes = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"h{i}") for i in (1, 2)]
    mixed = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("sets"), F.min("component").alias("low"), F.max("component").alias("high"), *hashes)
    kept = mixed.where("low <> high").groupBy("sets", "h1", "h2").agg(F.min("key").alias("key")).select("key")
    rows = cut(placed.join(kept, "key"))
    release(placed)
    early, sizes = F.pmod(F.xxhash64("key"), F.lit(KEYS_PER_EARLY)) == 0, sketches.select("node", "n", *FOLDS)
    some = cut(rows.where(early).join(sizes, "node"))
    first = cut(_meetings(some, some, percent).distinct())
    release(some)
    turn = F.row_number().over(Window.partitionBy("a").orderBy("b"))
    known = (first.withColumn("turn", turn).where(F.col("turn") <= MOST_KNOWN)  # only spares work: the others meet again
             .groupBy("a").agg(F.collect_list("b").alias("known")).withColumnRenamed("a", "node"))
    left = rows.where(~early)
    if linked is not None:
        near = possible(first, sketches, percent)
        ties = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(linked(near))
        groups = cut(connected_components(ties))
        release(near)
        left = left.select("key", "node").join(groups, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component"))
    others = cut(left.join(sizes.join(known, "node", "left"), "node"))
    release(rows)
    met = _meetings(others, others.drop("known"), percent)
    if linked is None:
        met = first.union(met)
    pairs = cut(met.distinct())
    release(others, first)
    out = possible(pairs, sketches, percent)
    release(pairs)
    if linked is None:
        return out
    return groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(linked(out))


def jaccard_groups(
    docs: DataFrame, *, text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``, by all links of ``percent`` or more.

    ``component_id`` is the smallest doc_id reachable by links. A null or empty text has no
    shingles and is its own group; rows with equal sets (repeated rows too) are linked; a
    row without doc_id takes part and has the group's id, null if no row of it has one.
    Only ``doc_id`` and ``text`` are read.
    """
    source = docs.select("doc_id", F.col(text).alias("text"))
    named = cut(source.mapInArrow(_named("text", size), "doc_id bigint, node bigint, n_shingles bigint, text string"))
    texts = cut(named.where("text IS NOT NULL AND node <> 0").select("node", "text").repartition("node").mapInArrow(
        _distinct_nodes, "node bigint, text string"))
    rows = cut(named.drop("text"))
    release(named)
    keys = texts.mapInArrow(_keyed(size, percent), "key bigint, node bigint")
    every = cut(keys.repartition("key").sortWithinPartitions("key").mapInArrow(_shared_keys, "key bigint, node bigint"))
    sketches = cut(texts.mapInArrow(_sketches(size, percent), SKETCH))
    shared = _uncrowded(every, sketches)
    release(every)

    def linked(pairs: DataFrame) -> DataFrame:
        return verify(pairs, texts, size).where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")

    stars = shared.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    ties = _rest(shared, linked(possible(stars, sketches, percent)), sketches, percent, linked)
    release(texts, sketches, shared)
    groups = connected_components(ties)
    placed = rows.join(groups, "node", "left").select(
        "doc_id", "node", "n_shingles", F.coalesce("component", "node").alias("component"))
    smallest = placed.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return placed.join(smallest, "component", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
