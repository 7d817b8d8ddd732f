"""Nearest neighbours from windows around a query on several shifted Hilbert curves.

Every curve has a rotation of its own of the leading principal axes and a random shift; the
vectors are put in the order of their place on the curve (range partitioned, so a place in
the order is a place in a range plus the sizes of the ranges before it) and cut into blocks
of equal size. A query meets the vectors of the blocks around its own place on every curve,
but for those that it meets on a curve before, so no distance is measured twice; the nearest
by the exact distance are kept, then merged over blocks and curves.

How far the window reaches is measured, not set: for some queries the true neighbours are
found by comparing them with all vectors, and the window is as wide as most of these need on
their best curve. Vectors that have near neighbours take a narrow one, however large the
table; among evenly spread vectors, where neighbours are not much nearer than others, it
becomes a share of the table.

Equal vectors are one point with its smallest ids, of which no more than a result's length
can ever be listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut, release

K = 10
CURVES = 16
DIMENSIONS, BITS = 8, 7
AXES = 32  # principal axes that the rotations mix
FOUND = 0.93  # share of the true neighbours of the tried queries that the window reaches
TRIED = 128  # queries on which it is measured
BLOCKS = (32, 4096)  # least and largest size of a block
QUERIES_PER_GROUP = 4096
SAMPLE = 4096
SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of cells (rows of whole coordinates of ``bits`` bits)."""
    x = cells.astype(np.int64).copy()
    width = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in range(width):
            # In an upper half the first axis is mirrored, in a lower half it changes places.
            upper = (x[:, axis] & bit) > 0
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= np.where(upper, low, swap)
            x[:, axis] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=1)
    turn = np.zeros(len(x), dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(width):
            key = (key << 1) | ((x[:, axis] >> level) & 1)
    return key


def curve_frames(sampled: np.ndarray, curves: int, dimensions: int, axes: int = AXES) -> list[tuple[np.ndarray, np.ndarray]]:
    """Projection and shift of every curve: principal axes of a sample, rotated from a fixed seed, in units of their spread."""
    size = sampled.shape[1]
    _, principal = np.linalg.eigh(np.atleast_2d(np.cov(sampled.T)) if len(sampled) > 1 else np.eye(size))
    leading = principal[:, ::-1][:, :min(size, axes)]
    frames = []
    for number in range(curves):
        draw = np.random.default_rng(SEED + number)
        wide = max(leading.shape[1], dimensions)
        rotation = np.linalg.qr(draw.normal(size=(wide, wide)))[0][:leading.shape[1], :dimensions]
        projection = leading @ rotation
        spread = float(np.std((sampled - sampled.mean(axis=0)) @ projection)) or 1.0
        frames.append((projection / spread, draw.uniform(-0.5, 0.5, size=dimensions)))
    return frames


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _keyed(frames, center: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column("vector")) - center
            for number, (projection, shift) in enumerate(frames):
                at = (vectors @ projection + shift + 4) / 8 * (1 << bits)
                cells = np.clip(at, 0, (1 << bits) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, number, dtype=np.int32)), pa.array(hilbert_keys(cells, bits)),
                     batch.column("point")], ["curve", "key", "point"])
    return run


def _first(vectors: np.ndarray, squares: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int):
    """Places and exact distances of the ``k`` nearest of some vectors."""
    take = min(k + 4, len(vectors))  # some more, as the fast distances are rounded
    near = np.argpartition(squares - 2 * (vectors @ query), take - 1)[:take]
    exact = np.sqrt(((vectors[near] - query) ** 2).sum(axis=1))
    order = np.lexsort((ids[near], exact))[:k]
    return near[order], exact[order]


def _true(queries: np.ndarray, names: np.ndarray, k: int):
    """The ``k`` nearest vectors of a task for each of some queries, without the query itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, ids = _vectors(batch.column("vector")), batch.column("point").to_numpy()
            squares, rows = (vectors * vectors).sum(axis=1), []
            for name, query in zip(names.tolist(), queries, strict=True):
                at, score = _first(vectors, squares, ids, query, k + 1)
                other = ids[at] != name
                rows.append((np.full(other.sum(), name), ids[at][other], score[other]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], ["query", "point", "score"])
    return run


def _nearest(k: int, reach: int):
    """The ``k`` nearest points of a block for each query that meets it and did not meet them on a curve before."""
    def run(asked: pa.Table, block: pa.Table) -> pa.Table:
        names = ["query", "point", "score", "compared"]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        rows = []
        if len(asked) and len(block):
            queries, points = (_vectors(t.column("vector").combine_chunks()) for t in (asked, block))
            theirs, own = (_vectors(t.column("blocks").combine_chunks()) for t in (asked, block))
            curve, ids = asked.column("curve")[0].as_py(), block.column("point").to_numpy()
            squares = (points * points).sum(axis=1)
            for row, query, places in zip(asked.column("point").to_pylist(), queries, theirs, strict=True):
                met = (np.abs(own[:, :curve] - places[:curve]) <= reach).any(axis=1)
                new = np.flatnonzero(~met & (ids != row))
                if len(new):
                    at, score = _first(points[new], squares[new], ids[new], query, k)
                    compared = np.zeros(len(at), dtype=np.int64)
                    compared[0] = len(new)
                    rows.append((np.full(len(at), row), ids[new][at], score, compared))
        columns = [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [[]] * 4
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)
    return run


def points_of(vectors: DataFrame, every: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (point, vector, asked, ids) with their smallest ``k + 1`` ids, and (vec_id, point) of all rows.

    A point is named by its smallest id. Left out are null ids and vectors that are null,
    zero, of another length than most, or hold a null, infinite or undefined component.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    sound = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite & some).select(
        "vec_id", F.col("embedding").alias("vector"))
    lengths = sound.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    sound = sound.where(F.size("vector") == (lengths["length"] if lengths else 0)).distinct()
    points = cut(sound.groupBy("vector").agg(
        F.min("vec_id").alias("point"), F.bool_or(F.col("vec_id") % every == 0).alias("asked")))
    rows = cut(sound.join(points, "vector").select("vec_id", "point"))
    in_order = Window.partitionBy("point").orderBy("vec_id")
    smallest = rows.withColumn("n", F.row_number().over(in_order)).where(F.col("n") <= k + 1)
    ids = smallest.groupBy("point").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return cut(points.join(ids, "point")), rows


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of the (query, point, score) rows of each query."""
    nearest = Window.partitionBy("query").orderBy("score", "point")
    return rows.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k).drop("n")


def window_needed(points: DataFrame, placed: DataFrame, k: int, tried: int, found: float) -> int:
    """How many places a window must reach to either side for a share of the true neighbours to be in it.

    At most ``tried`` queries, those with the smallest hash, are compared with all vectors;
    what comes back is ``k`` numbers for each: the least distance on any curve.
    """
    some = points.where("asked").orderBy(F.xxhash64("point")).limit(tried).select("point", "vector").toArrow()
    if not len(some):
        return 1
    queries = _vectors(some.column("vector").combine_chunks())
    true = _top(points.select("point", "vector").mapInArrow(
        _true(queries, some.column("point").to_numpy(), k), "query bigint, point bigint, score double"), k).select("query", "point")
    theirs = placed.select("curve", F.col("point").alias("query"), F.col("place").alias("query_place"))
    gaps = placed.join(F.broadcast(true), "point").join(theirs, ["curve", "query"]).groupBy("query", "point").agg(
        F.min(F.abs(F.col("place") - F.col("query_place"))).alias("gap"))
    needed = [row["gap"] for row in gaps.select("gap").collect()]
    return max(1, int(np.quantile(needed, found, method="higher"))) if needed else 1


def search(
    vectors: DataFrame, *, every: int = 100, k: int = K, curves: int = CURVES, dimensions: int = DIMENSIONS,
    bits: int = BITS, found: float = FOUND, tried: int = TRIED, blocks: tuple[int, int] = BLOCKS, sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score, compared): the ``k`` nearest found of each row whose id ``every`` divides.

    ``score`` is the Euclidean distance in double precision, ties go to the smaller id, and
    a query is no result of its own. ``compared`` is the number of vectors whose distance to
    the query was measured. Rows that repeat an id and vector count once. The axes and the
    spread of the curves are fitted on at most ``sample`` vectors and the window on at most
    ``tried`` queries, those with the smallest hashes; all vectors are indexed.
    """
    points, rows = points_of(vectors, every, k)
    count = points.count()
    fitted = points.orderBy(F.xxhash64("point")).limit(sample).select("vector").toArrow()
    sampled = _vectors(fitted.column("vector").combine_chunks()) if count else np.zeros((1, 1))
    frames = curve_frames(sampled, curves, dimensions)
    keyed = points.select("point", "vector").mapInArrow(
        _keyed(frames, sampled.mean(axis=0), bits), "curve int, key bigint, point bigint")
    ranged = cut(keyed.repartitionByRange("curve", "key", "point").withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy("curve", "range").count()
    before = Window.partitionBy("curve").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("curve", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("curve", "range").orderBy("key", "point")
    ordered = ranged.withColumn("turn", F.row_number().over(inside)).join(starts, ["curve", "range"])
    placed = cut(ordered.select("curve", "point", (F.col("start") + F.col("turn") - 1).alias("place")))
    release(ranged)
    window = min(window_needed(points, placed, k, tried, found), max(1, count))
    size = int(np.clip(window // 4, *blocks))  # a few blocks make the window
    reach, last = -(-window // size), max(0, (count - 1) // size)
    # The blocks of a point on every curve, in the order of curves.
    mine = placed.groupBy("point").agg(F.array_sort(F.collect_list(F.struct("curve", "place"))).alias("places")).select(
        "point", F.transform("places", lambda p: F.floor(p["place"] / size).cast("int")).alias("blocks"))
    indexed = cut(points.select("point", "vector", "asked").join(mine, "point"))
    release(placed)
    meet = points.where("asked").count() * min(1.0, (2 * reach + 1) * size / max(1, count))  # queries of a block
    groups = max(1, -(-int(meet) // QUERIES_PER_GROUP))
    each = indexed.select("point", "vector", "blocks", F.posexplode("blocks").alias("curve", "block"))
    stored = each.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    around = F.explode(F.sequence(F.greatest(F.col("own") - reach, F.lit(0)), F.least(F.col("own") + reach, F.lit(last))))
    asked = indexed.where("asked").select("point", "vector", "blocks", F.posexplode("blocks").alias("curve", "own")).select(
        "point", "vector", "blocks", "curve", around.alias("block"),
        F.pmod(F.xxhash64("point"), F.lit(groups)).cast("int").alias("part"))
    # Names of its own, as both sides come from one table.
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])
    keys = ["curve", "block", "part"]
    met = cut(asked.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(
        _nearest(k + 1, reach), "query bigint, point bigint, score double, compared bigint"))
    work = met.groupBy("query").agg(F.sum("compared").alias("compared"))
    # The other ids of a query's own point are as near as can be.
    twins = points.where("asked").select(F.col("point").alias("query"), "point", F.lit(0.0).alias("score"))
    merged = _top(met.select("query", "point", "score"), k + 1).unionByName(twins)
    listed = merged.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy("score", "vec_id")
    top = cut(listed.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1).drop("n"))
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("point").alias("query"))
    others = queries.join(top, "query").where("vec_id <> query_id")
    ranks = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = others.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return ranked.join(work, "query", "left").select(
        "query_id", "rank", "vec_id", "score", F.coalesce("compared", F.lit(0)).alias("compared"))
