"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

Structured masks (Pagh 2016) guarantee that any two fingerprints within the
radius agree on all bits of at least one mask, so no link is left to chance.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from terralattice import session
from terralattice.llm import components
from terralattice.llm.common import by_batch, order_id

BITS = 64
RADIUS = 4
BLOCK = 2048  # largest bucket whose members are compared with each other in a task


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks; every pair within `radius` agrees on one of them.

    Bit i gets a vector of radius+1 bits, and mask v keeps the bits whose vector
    has an odd overlap with v. At most `radius` differing bits span a subspace
    with some v orthogonal to it, whose mask therefore holds none of them.
    """
    size = 1 << (radius + 1)
    vector = [1 + (i * 11) % (size - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, size)]


def shingles(text: bytes | None, n: int, seed: int) -> np.ndarray:
    """Hashes of the runs of n words, one per place; a text of fewer words is one run."""
    words = (text or b"").lower().split()  # bytes.lower changes A-Z only
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.fromiter(map(len, words), np.int64, len(words)).cumsum() + np.arange(len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(n, len(words))
    return np.array([xxhash.xxh64_intdigest(joined[a:b], seed)
                     for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())], "<u8")


def fingerprint(text: bytes | None, n: int, seed: int) -> int:
    """Bit b is set where over half of the shingle hashes have it set; 0 without words."""
    return majority(shingles(text, n, seed))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 65536):
        block = hashes[part:part + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str = "text", n: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and the fingerprint as a signed long (`fp`), one row per row of `docs`."""
    def make(columns):
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()),
                "fp": [signed(fingerprint(t, n, seed)) for t in columns["text"]]}
    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")),
                    "doc_id long, fp long", make)


def _spanning(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links within the radius that join the bucket's members as all its links would.

    A search from each member not yet reached compares the front with those left,
    so a bucket yields fewer links than it has members.
    """
    left = np.array(values, np.int64).view(np.uint64)
    links = []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            value = front.pop()
            near = np.bitwise_count(left ^ value) <= radius
            for other in left[near]:
                links.append((int(value.view(np.int64)), int(other.view(np.int64))))
                front.append(other)
            left = left[~near]
    return links


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links between distinct fingerprints (`fp`) that connect all within the radius.

    Each fingerprint enters one bucket per mask. Buckets up to BLOCK members are
    searched in place. Members of larger ones go another exact way, without a
    limit on their number: each emits every value within half the radius of
    itself, and two fingerprints are within the radius exactly if they share one.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    keys = F.explode(F.array(*[F.struct(F.lit(t).cast("byte").alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                               for t, m in enumerate(masks(radius))]))
    entries = fps.select("fp", keys.alias("e")).select("fp", "e.mask", "e.key")
    counted = entries.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    small = (entries.join(counted.where(F.col("n") <= BLOCK).select("mask", "key"), ["mask", "key"])
             .groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps"))

    def make(columns):
        found = {pair for group in columns["fps"] for pair in _spanning(sorted(group), radius)}
        return {"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())}
    near = by_batch(small, "a long, b long", make).distinct()

    crowded = entries.join(counted.where(F.col("n") > BLOCK).select("mask", "key"), ["mask", "key"], "left_semi").select("fp").distinct()
    flips = [0] + [sum(1 << b for b in c) for k in range(1, radius // 2 + 1) for c in itertools.combinations(range(BITS), k)]
    flips = F.array(*[F.lit(signed(f)) for f in flips])
    around = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    first = around.groupBy("centre").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z").select("centre", "a")
    shared = around.join(first, "centre").where("a < fp").select("a", F.col("fp").alias("b")).distinct()
    return near.unionByName(shared)


def near_groups(docs: DataFrame, text: str = "text", n: int = 4, seed: int = 42, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id reachable over links within the radius.

    Documents with one fingerprint are one node, so copies are never paired. Null,
    empty and wordless texts have fingerprint 0 and are linked like any other. A
    null doc_id comes before all others. Repeated rows give repeated results;
    columns of `docs` other than the id and the text are not read.
    """
    marked = session.materialize(fingerprints(docs, text, n, seed), "simhash")
    nodes = session.materialize(marked.groupBy("fp").agg(F.min(order_id()).alias("least")), "simhash-nodes")
    groups = components.connected(nodes.select(F.col("fp").alias("node")),
                                  session.materialize(links(nodes.select("fp"), radius), "simhash-links"))
    rooted = groups.join(nodes.withColumnRenamed("fp", "node"), "node")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    joined = marked.join(named, "fp")
    return joined.select("doc_id", "fp", F.when(F.col("component_id") != F.lit(-(1 << 63)), F.col("component_id")).alias("component_id"))
