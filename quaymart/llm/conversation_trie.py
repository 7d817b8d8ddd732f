"""The prefix trie of conversations, its subtree sums taken along an Euler tour.

Every node is a distinct sequence of turns, named by the smallest conversation that starts
with it and its depth, and found by grouping 128-bit hashes of prefixes. A hash is the XOR of
hashes of (place, turn), so it is a running aggregate over a conversation's turns.

The tour enters a node, tours its children in the order of their names, and leaves it. Every
node has an arc in and an arc out, and the arc that follows each is known from the first child,
the next sibling and the parent. The list of arcs is ranked in two steps: tasks follow it
inside ranges of (name, depth), whose arcs largely follow each other, which leaves a list of
segments; that is ranked by pointer jumping, a join that doubles the reach of every segment.
The sum from an arc to the end of the tour then is known for each arc, and a subtree's sum is
the difference between its two arcs.

No step puts the turns of a conversation, the children of a node or the conversations that
end in it into one task. Their order is made by range partitioning; what runs across ranges is
carried over by a row for each range and key. Only the hash over the conversations that end in
a node is one stream, fed with joined pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut, release

HEADS = 9  # a conversation takes fewer turns than this from its family's first
FAMILY = 5
NODES_PER_TASK = 200_000
IDS_PER_PIECE = 256
SORTED_CHARS = 64


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranges(df: DataFrame, by: list) -> DataFrame:
    """``df`` written in ranges of ``by``, with the number of the range as ``part``; equal rows are spread too."""
    tied = df.withColumn("tie", F.monotonically_increasing_id())
    return cut(tied.repartitionByRange(_partitions(df), *by, "tie").withColumn("part", F.spark_partition_id()))


def _before(key: list[str]) -> Window:
    """The ranges before this one that have the key."""
    return Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)


def heads_taken(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def _numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of every conversation with their place, and (conv_id, turns)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.substring(role, 1, SORTED_CHARS).alias("r"), F.substring(text, 1, SORTED_CHARS).alias("t"),
        F.xxhash64(F.lit(1), role, text).alias("u1"), F.xxhash64(F.lit(2), text, role).alias("u2"),
        F.octet_length(text).cast("bigint").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), "r", "t", "u1", "u2"]
    rows = _ranges(turns, ["conv_id", *order])
    runs = rows.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    runs = runs.select("part", "conv_id", F.coalesce(F.sum("n").over(_before(["conv_id"])), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order, "tie")) - 1
    numbered = cut(rows.withColumn("place", place).join(runs, ["part", "conv_id"]).select(
        "part", "conv_id", (F.col("before") + F.col("place")).alias("place"), "u1", "u2", "bytes"))
    release(rows)
    return numbered, numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))


def _families(turns: DataFrame) -> DataFrame:
    """(conv_id, first, taken, own_from, length) of every conversation as it is rebuilt."""
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    every = turns.select("conv_id", "turns", first.alias("first"), heads_taken(F.col("conv_id")).alias("own_from"))
    there = turns.select(F.col("conv_id").alias("first"), F.col("turns").alias("first_turns"))
    taken = F.least(F.col("own_from").cast("bigint"), F.coalesce("first_turns", F.lit(0)))
    return every.join(there, "first", "left").select(
        "conv_id", "first", taken.alias("taken"), "own_from",
        (taken + F.greatest(F.col("turns") - F.col("own_from"), F.lit(0))).alias("length"))


def rebuilt_prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, x1, x2, p1, p2, bytes, length) of every prefix of the rebuilt conversations, and (conv_id, length).

    x names the prefix, p the one a turn shorter; the empty prefix has zeros.
    """
    numbered, turns = _numbered(conversations)
    families = cut(_families(turns))
    heads = numbered.where(f"place < {HEADS - 1}").select(F.col("conv_id").alias("first"), "place", "u1", "u2", "bytes")
    taken = families.join(heads, "first").where("place < taken").select(
        F.lit(-1).alias("part"), "conv_id", (F.col("place") + 1).alias("depth"), "u1", "u2", "bytes")
    runs = numbered.select("part", "conv_id").distinct().join(families, "conv_id").select("part", "conv_id", "taken", "own_from")
    own = numbered.join(runs, ["part", "conv_id"]).where("place >= own_from").select(
        "part", "conv_id", (F.col("place") - F.col("own_from") + F.col("taken") + 1).alias("depth"), "u1", "u2", "bytes")
    both = cut(taken.union(own).select(
        "part", "conv_id", "depth", "bytes", F.xxhash64("depth", "u1", "u2").alias("g1"),
        F.xxhash64("u2", "depth", "u1").alias("g2")))
    release(numbered)
    so_far = Window.partitionBy("part", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.groupBy("part", "conv_id").agg(F.bit_xor("g1").alias("g1"), F.bit_xor("g2").alias("g2"))
    carried = carried.select("part", "conv_id", *[
        F.coalesce(F.bit_xor(g).over(_before(["conv_id"])), F.lit(0)).alias(f"c{g[1]}") for g in ("g1", "g2")])
    carried = carried.join(families.select("conv_id", "length"), "conv_id")
    running = both.select("*", *[F.bit_xor(g).over(so_far).alias(f"s{g[1]}") for g in ("g1", "g2")])
    joined = running.join(carried, ["part", "conv_id"])
    x = {i: F.col(f"s{i}").bitwiseXOR(F.col(f"c{i}")) for i in (1, 2)}
    prefixes = cut(joined.select(
        "conv_id", "depth", *[x[i].alias(f"x{i}") for i in (1, 2)],
        *[x[i].bitwiseXOR(F.col(f"g{i}")).alias(f"p{i}") for i in (1, 2)], "bytes", "length"))
    release(both)
    return prefixes, families.select("conv_id", "length")


def trie(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every node with its parent's name, first child, next sibling and counts."""
    zero = F.lit(0).cast("bigint")
    nodes = prefixes.groupBy("depth", "x1", "x2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    nodes = cut(nodes)
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), "conv_id", "n_convs", zero.alias("bytes"))
    named = nodes.drop("p1", "p2").unionByName(root)
    parent = ["depth", "p1", "p2"]
    rows = _ranges(nodes, [*parent, "conv_id"])
    runs = rows.groupBy("part", *parent).agg(F.min("conv_id").alias("least"))
    # The parent's name and the first sibling of the next range, once for each range and parent.
    above = named.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    runs = runs.select("part", *parent, F.lead("least").over(Window.partitionBy(*parent).orderBy("part")).alias("beyond"))
    runs = runs.join(above, parent)
    next_here = F.lead("conv_id").over(Window.partitionBy("part", *parent).orderBy("conv_id"))
    placed = rows.withColumn("next", next_here).join(runs, ["part", *parent]).select(
        "depth", "x1", "x2", "conv_id", "n_convs", "bytes", "parent_conv_id", F.coalesce("next", "beyond").alias("next"))
    every = placed.unionByName(root.withColumns({"parent_conv_id": F.lit(None).cast("bigint"), "next": F.lit(None).cast("bigint")}))
    children = nodes.groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("child")).select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), "n_children", "child")
    out = cut(every.join(children, ["depth", "x1", "x2"], "left").withColumn("n_children", F.coalesce("n_children", zero)))
    release(nodes, rows)
    return out


# --- the tour ------------------------------------------------------------------------------------

SIDES = 2  # an arc is a node's name, its depth times SIDES, plus 1 on the way out
LOCAL = ("kind int, conv_id bigint, code bigint, leaves bigint, saved bigint, "
         "enter_conv bigint, enter_code bigint, exit_conv bigint, exit_code bigint")


def _known(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    """The columns of a whole range; a null is -1 with ``has_`` false."""
    table = pa.Table.from_batches(list(batches))
    found = {}
    for name in table.column_names:
        column = table.column(name).combine_chunks()
        found[f"has_{name}"] = column.is_valid().to_numpy(zero_copy_only=False)
        found[name] = column.fill_null(-1).to_numpy(zero_copy_only=False)
    return found


def _indices(convs: np.ndarray, key: np.ndarray, width: int, conv: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where nodes (conv, depth) are in this range, -1 if elsewhere."""
    at = np.minimum(np.searchsorted(convs, conv), len(convs) - 1)
    wanted = at * width + depth
    place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
    here = (convs[at] == conv) & (key[place] == wanted)
    return np.where(here, place, -1)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow the tour inside one range, whose nodes are in order of (conv_id, depth).

    For each node (kind 0): the sums from its arc in to its arc out if the way does not leave
    the range, else the difference of both sums to the end of their segments, with the arcs
    that follow these segments. For each segment (kind 1): its first arc, its sums, and in
    ``enter_`` the arc that follows.
    """
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    c = _known(iter(batches))
    conv, depth, n = c["conv_id"], c["depth"], len(c["conv_id"])
    convs, number = np.unique(conv, return_inverse=True)
    width = int(depth.max()) + 2
    key = number * width + depth
    # What follows each arc: arcs in come first, then arcs out.
    down, over, up = c["has_child"], c["has_next"], c["has_parent_conv_id"]
    target_conv = np.r_[np.where(down, c["child"], conv), np.where(over, c["next"], c["parent_conv_id"])]
    target_code = np.r_[np.where(down, (depth + 1) * SIDES, depth * SIDES + 1),
                        np.where(over, depth * SIDES, (depth - 1) * SIDES + 1)]
    last = np.r_[np.zeros(n, dtype=bool), ~over & ~up]
    place = _indices(convs, key, width, target_conv, target_code // SIDES)
    follower = np.where((place >= 0) & ~last, place + n * (target_code % SIDES), -1)
    first = np.ones(2 * n, dtype=bool)
    first[follower[follower >= 0]] = False
    end = np.where(follower >= 0, follower, np.arange(2 * n))
    weights = [np.r_[(~down).astype(np.int64), np.zeros(n, dtype=np.int64)],
               np.r_[(c["n_convs"] - 1) * c["bytes"], np.zeros(n, dtype=np.int64)]]
    # Pointer jumping: sums[a] runs from a up to, and without, end[a].
    sums = [np.where(follower >= 0, w, 0) for w in weights]
    while True:
        further = end[end]
        if np.array_equal(further, end):
            break
        sums = [s + s[end] for s in sums]
        end = further
    sums = [s + w[end] for s, w in zip(sums, weights, strict=True)]
    beyond_conv, beyond_code = target_conv[end], target_code[end]
    ends = last[end]
    same = end[:n] == end[n:]

    def column(values, missing=None):
        return pa.array(values.astype(np.int64), pa.int64(), mask=missing)

    difference = [s[:n] - s[n:] for s in sums]
    nothing = np.ones(n, dtype=bool)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.where(same, 0, 2), pa.int32()), column(conv), column(depth), *map(column, difference),
         *[column(v, same | e) for v, e in ((beyond_conv[:n], ends[:n]), (beyond_code[:n], ends[:n]),
                                           (beyond_conv[n:], ends[n:]), (beyond_code[n:], ends[n:]))]], LOCAL_NAMES)
    heads = np.flatnonzero(first)
    node, side = heads % n, heads // n
    nothing = np.ones(len(heads), dtype=bool)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(heads)), pa.int32()), column(conv[node]), column(depth[node] * SIDES + side),
         *[column(s[heads]) for s in sums], column(beyond_conv[heads], ends[heads]), column(beyond_code[heads], ends[heads]),
         column(heads, nothing), column(heads, nothing)], LOCAL_NAMES)


LOCAL_NAMES = [part.split()[0] for part in LOCAL.split(", ")]


def ranked(segments: DataFrame) -> DataFrame:
    """(conv_id, code, leaves, saved): sums from the start of each segment to the end of the tour.

    Pointer jumping: every round adds to a segment the sums of the one it points to, and lets
    it point to where that one points. A segment is pointed to by at most one other.
    """
    state = cut(segments)
    while state.where("next_conv IS NOT NULL").limit(1).count():
        known = state.select(F.col("conv_id").alias("next_conv"), F.col("code").alias("next_code"),
                             F.col("leaves").alias("l"), F.col("saved").alias("s"),
                             F.col("next_conv").alias("further_conv"), F.col("next_code").alias("further_code"))
        jumped = state.where("next_conv IS NOT NULL").join(known, ["next_conv", "next_code"]).select(
            "conv_id", "code", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"),
            F.col("further_conv").alias("next_conv"), F.col("further_code").alias("next_code"))
        after = cut(state.where("next_conv IS NULL").unionByName(jumped))
        release(state)
        state = after
    return state


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of every node of :func:`trie`."""
    needed = nodes.select("conv_id", "depth", "child", "next", "parent_conv_id", "n_convs", "bytes")
    ranges = max(_partitions(nodes), -(-nodes.count() // NODES_PER_TASK))  # a task holds its range in memory
    local = cut(needed.repartitionByRange(ranges, "conv_id", "depth").sortWithinPartitions("conv_id", "depth")
                .mapInArrow(_followed, LOCAL))
    segments = local.where("kind = 1").select(
        "conv_id", "code", "leaves", "saved", F.col("enter_conv").alias("next_conv"), F.col("enter_code").alias("next_code"))
    sums = ranked(segments)
    inside = local.where("kind = 0").select("conv_id", F.col("code").alias("depth"), "leaves", "saved")
    outside = local.where("kind = 2")
    for side in ("enter", "exit"):
        known = sums.select(F.col("conv_id").alias(f"{side}_conv"), F.col("code").alias(f"{side}_code"),
                            F.col("leaves").alias(f"{side}_leaves"), F.col("saved").alias(f"{side}_saved"))
        outside = outside.join(known, [f"{side}_conv", f"{side}_code"], "left")
    none = F.lit(0)
    total = [(F.col(w) + F.coalesce(f"enter_{w}", none) - F.coalesce(f"exit_{w}", none)).alias(w) for w in ("leaves", "saved")]
    found = inside.unionByName(outside.select("conv_id", F.col("code").alias("depth"), *total))
    return found.select("conv_id", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


# --- the conversations that end in a node ---------------------------------------------------------


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of every node, whose pieces follow each other."""
    node, digest = None, None
    for batch in batches:
        done = []
        for x1, x2, ids in zip(*(batch.column(name).to_pylist() for name in ("x1", "x2", "ids")), strict=True):
            if (x1, x2) == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (x1, x2), hashlib.sha256()
            digest.update(ids.encode())
        yield _digests(done)
    if node is not None:
        yield _digests([(*node, digest.hexdigest())])


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    x1, x2, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(x1, pa.int64()), pa.array(x2, pa.int64()), pa.array(digest, pa.string())], ["x1", "x2", "ends_sha256"])


def end_hashes(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(x1, x2, ends_sha256) of the nodes in which conversations end: their ids in order, joined by commas."""
    zero = F.lit(0).cast("bigint")
    ends = prefixes.where("depth = length").select("x1", "x2", "conv_id").union(
        lengths.where("length = 0").select(zero, zero, "conv_id"))
    rows = _ranges(ends, ["x1", "x2", "conv_id"])
    turn = F.row_number().over(Window.partitionBy("part", "x1", "x2").orderBy("conv_id")) - 1
    pieces = rows.withColumn("piece", F.floor(turn / IDS_PER_PIECE)).groupBy("part", "x1", "x2", "piece").agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    hashed = pieces.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "part", "piece")
    out = cut(hashed.select("x1", "x2", "ids").mapInArrow(_hashed, "x1 bigint, x2 bigint, ends_sha256 string"))
    release(rows)
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c is rebuilt from the first h turns of c - c % 5 and its own turns after its
    first h, h = crc32(c) % 9. Turns are ordered by ``turn`` (null first), equal ones by the
    first 64 characters of role and text and then a hash of both; repeated rows are turns each.
    A null role or text is empty, rows without conv_id take no part, and a table without
    conversations has no nodes, not even a root. Columns other than conv_id, turn, role and
    text are not read.
    """
    prefixes, lengths = rebuilt_prefixes(conversations)
    nodes = trie(prefixes, lengths)
    ends = end_hashes(prefixes, lengths)
    release(prefixes)
    sums = subtree_sums(nodes)
    return nodes.join(sums, ["conv_id", "depth"]).join(ends, ["x1", "x2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
