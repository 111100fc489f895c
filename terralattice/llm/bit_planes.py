"""Centroid clustering of integer vectors by bit-plane popcounts.

Bit plane i of a vector holds bit i of its 64 components in one unsigned 64-bit
word; the highest plane weighs minus its power of two. A dot product is the
weighted sum of the set bits that two vectors' planes have in common, so products,
norms, distances and component sums are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from terralattice import session

COMPONENTS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
WORD_BITS = 28  # planes up to which all sums of a distance fit 64 bits; beyond, Python's integers take over
LARGEST = 2.0 ** 62  # scaled components from here on have no integer of 64 bits


def quantize(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are kept, and their integers, one row each."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(sizes == COMPONENTS)
    values = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    scaled = np.floor(values.reshape(-1, COMPONENTS) * scale)
    whole = (np.abs(scaled) < LARGEST).all(axis=1)
    return at[whole], scaled[whole].astype(np.int64)


def pack(integers: np.ndarray) -> np.ndarray:
    """Bit planes of rows of 64 integers, as many as the largest needs; the last holds the signs."""
    most = int(np.abs(integers ^ (integers >> 63)).max(initial=0))
    shifts = np.arange(most.bit_length() + 1)
    bits = ((integers[:, None, :] >> shifts[None, :, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def weights(n_planes: int) -> list[int]:
    """What a bit of each plane counts; the last plane's takes away."""
    return [1 << i for i in range(n_planes - 1)] + [-(1 << (n_planes - 1))]


def widen(planes: np.ndarray, n_planes: int) -> np.ndarray:
    """The same numbers in more planes: signs are repeated."""
    return np.concatenate([planes, np.repeat(planes[:, -1:], n_planes - planes.shape[1], axis=1)], axis=1)


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of each row of planes in `left` with `right`, which is one row or as many."""
    kind = np.int64 if left.shape[1] <= WORD_BITS and right.shape[1] <= WORD_BITS else object
    total = np.zeros(len(left), kind)
    for i, a in enumerate(weights(left.shape[1])):
        for j, b in enumerate(weights(right.shape[1])):
            total += np.bitwise_count(left[:, i] & right[:, j]).astype(kind) * (a * b)
    return total


def nearest(planes: np.ndarray, centroids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid per vector, the smaller of equals, and the squared distance."""
    norms = dots(planes, planes)
    away = np.stack([norms - 2 * dots(planes, c[None]) + dots(c[None], c[None])[0] for c in centroids])
    best = np.array([min(range(len(centroids)), key=away[:, i].__getitem__) for i in range(len(planes))], np.int64) \
        if away.dtype == object else away.argmin(axis=0)
    return best, away[best, np.arange(len(planes))]


def component_sums(planes: np.ndarray) -> list[int]:
    """Sum of each component over the rows: set bits of each plane by place, weighted."""
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.int64).tolist()
    return [sum(w * c for w, c in zip(weights(planes.shape[1]), column)) for column in zip(*counts)]


def packed(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and planes (array<long>) of the vectors with 64 finite components that have an integer."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, integers = quantize(batch.column(1), scale)
            if len(at):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), _lists(integers)], names=["vec_id", "planes"])
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), embedding).mapInArrow(each, "vec_id long, planes array<long>")


def _lists(integers: np.ndarray) -> pa.Array:
    """Planes of each row, as many as it needs itself, so that they do not depend on the batch."""
    planes = pack(integers)
    most = np.abs(integers ^ (integers >> 63)).max(axis=1)
    needed = 1 + (most[:, None] >> np.arange(planes.shape[1]) > 0).sum(axis=1)
    flat = planes[np.arange(planes.shape[1]) < needed[:, None]].view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(needed))).astype(np.int32)), pa.array(flat))


def _planes(column: pa.Array) -> np.ndarray:
    """Planes of a batch, all rows widened to the most among them."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    starts, most = np.cumsum(sizes) - sizes, int(sizes.max())
    return flat[starts[:, None] + np.minimum(np.arange(most)[None, :], sizes[:, None] - 1)]


def first_centroids(table: DataFrame, n: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """Integers of the `n` vectors first by the hash of seed and id; equal ids by their planes."""
    named = table.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
    rows = named.orderBy("h", "planes").limit(n).collect()  # n rows
    return [component_sums(np.array([r["planes"]], np.int64).view(np.uint64)) for r in rows]


def _centroid_planes(centroids: list[list[int]]) -> list[np.ndarray]:
    return [pack(np.array([c], np.int64))[0] for c in centroids]


def new_centroids(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Floored means of the vectors nearest to each centroid; one without vectors stays.

    Each task adds up its own vectors and sends a row per centroid and component.
    """
    held = _centroid_planes(centroids)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * len(held), [[0] * COMPONENTS for _ in held]
        for batch in batches:
            if not batch.num_rows:
                continue
            planes = _planes(batch.column(0))
            best = nearest(planes, held)[0]
            for c in np.unique(best).tolist():
                mine = planes[best == c]
                counts[c] += len(mine)
                sums[c] = [a + b for a, b in zip(sums[c], component_sums(mine))]
        full = [c for c, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(full, COMPONENTS), pa.int32()), "place": pa.array(list(range(COMPONENTS)) * len(full), pa.int32()),
            "n": pa.array([counts[c] for c in full for _ in range(COMPONENTS)], pa.int64()),
            "total": pa.array([str(v) for c in full for v in sums[c]], pa.string())})
    partial = table.select("planes").mapInArrow(each, "cluster int, place int, n long, total string")
    totals = partial.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = [list(c) for c in centroids]
    for r in totals.collect():  # at most centroids * components rows
        out[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]
    return out


def assign(table: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance: the nearest centroid and the squared distance to it; null where that exceeds a long."""
    held = _centroid_planes(centroids)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best, away = nearest(_planes(batch.column(1)), held)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)),
                                                  pa.array([d if d < 1 << 63 else None for d in away.tolist()], pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])
    return table.select("vec_id", "planes").mapInArrow(each, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, n: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, vec_id: str = "vec_id", embedding: str = "embedding",
            scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance, cluster_inertia, inertia per kept vector, and the final centroids.

    Vectors are kept that have exactly 64 components, none null, NaN, infinite or of
    2^62 and more when scaled. Fewer vectors than centroids give fewer centroids, an
    empty table an empty result. A null vec_id hashes as an empty text; rows that
    repeat an id are vectors of their own. Distances and sums of them that exceed a
    long are null. Other columns are not read.

    The packed vectors are written once and read in each round; only the centroids,
    n * 64 integers, pass through the driver and to the tasks.
    """
    table = session.materialize(packed(vectors, vec_id, embedding, scale), "bit-planes")
    centroids = first_centroids(table, n, seed)
    if not centroids:
        none = table.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return none, []
    for _ in range(rounds):
        centroids = new_centroids(table, centroids)
    assigned = session.materialize(assign(table, centroids), "bit-plane-clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = F.expr("count(distance) = count(*)")
    per = assigned.groupBy("cluster").agg(F.when(whole, exact).alias("part"))  # a row per centroid
    every = Window.orderBy("cluster").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.when(F.count("part").over(every) == F.count("*").over(every), F.sum("part").over(every))
    sums = per.select("cluster", F.col("part").try_cast("long").alias("cluster_inertia"), total.try_cast("long").alias("inertia"))
    return assigned.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia"), centroids


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
