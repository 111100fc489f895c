"""Near copies: groups of texts linked by a similarity of SIMILARITY or more over word shingles.

Fingerprints within the radius of the covering masks (simhash.py) are tried first and
join most copies. The rest follows from a prefix filter, which misses no link: with
all shingles in one order, common ones last, two sets that alike share one of their
first few (Bayardo et al. 2007). Sizes, places in that order and bit maps of the sets
bound the similarity (Xiao et al. 2008, Sandes et al. 2018) before a text is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from terralattice import session
from terralattice.llm import components, simhash
from terralattice.llm.common import by_batch, text_hash
from terralattice.llm.simhash import majority, shingles, signed  # by name: they go to the tasks

WORDS = 5
SIMILARITY = 0.8
SEED = 42
COUNTERS = 1 << 20  # places of the shingle counts, whatever the corpus; equal places count together
_BLOCK = 1 << 12
MAP_WORDS = 8  # 64-bit words of a bit map
MORE_PIVOTS = 16  # times as many in each round
SALTED = 10_000  # rows of a key that meet its pivots in one task
_CHUNK = 1 << 20


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingles((text or "").encode(), WORDS, SEED))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared shingles as a share of all; 1 for two texts without words."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    return similarity(a, b) >= SIMILARITY


def bit_map(held: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each of 64 * MAP_WORDS places; two maps differ in at most as many bits as the sets in shingles."""
    odd = np.bincount((held & np.uint64(64 * MAP_WORDS - 1)).astype(np.int64), minlength=64 * MAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def counter_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64) & (COUNTERS - 1)


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles in the common order, of which an alike set has one."""
    least = -(-4 * len(shingles) // 5)  # of a set's shingles are in any set alike
    return shingles[np.lexsort((shingles, counts[counter_of(shingles)]))[:len(shingles) - least + 1]] if len(shingles) else shingles


def _sketches(texts: DataFrame) -> DataFrame:
    maps = [f"m{i}" for i in range(MAP_WORDS)]

    def make(columns):
        all_ = [shingles((t or "").encode(), WORDS, SEED) for t in columns["text"]]
        sets = [np.unique(s) for s in all_]
        bits = np.stack([bit_map(s) for s in sets])
        return {"node": pa.array(columns["node"], pa.int64()), "size": pa.array(map(len, sets), pa.int64()),
                "set": pa.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) - (1 << 63) for s in sets], pa.int64()),
                "fp": pa.array([signed(majority(s)) for s in all_], pa.int64())} | {m: pa.array(bits[:, i]) for i, m in enumerate(maps)}
    return by_batch(texts, "node long, set long, size long, fp long, " + ", ".join(f"{m} long" for m in maps), make)


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """How many sets hold a shingle of each place. Tasks send what they have counted, block by block; a stream adds it up."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = np.zeros(COUNTERS, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(counter_of(shingle_set(text)))
                size += len(held[-1])
                if size > _CHUNK:
                    counts += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, size = [], 0
        counts += np.bincount(np.concatenate([np.zeros(0, np.int64), *held]), minlength=COUNTERS)
        yield _blocks(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            np.add.at(sums, batch.column("at").flatten().to_numpy(), batch.column("n").flatten().to_numpy())
        yield _blocks(sums)
    schema = "block int, at array<int>, n array<long>"
    found = texts.select("text").mapInArrow(each, schema).repartition("block").mapInArrow(add, schema).toArrow()  # COUNTERS numbers at most
    out = np.zeros(COUNTERS, np.int64)
    for at, n in zip(found["at"].chunks, found["n"].chunks):
        out[at.flatten().to_numpy()] = n.flatten().to_numpy()
    return out


def _blocks(counts: np.ndarray) -> pa.RecordBatch:
    """The places counted, and their counts, in blocks of places."""
    at = np.flatnonzero(counts)
    block, start = np.unique(at // _BLOCK, return_index=True)
    ends = pa.array(np.append(start, len(at)).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))),
                                       pa.ListArray.from_arrays(ends, pa.array(counts[at]))], names=["block", "at", "n"])


def _postings(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """key, set, place: prefixes of all sets, without shingles that no other prefix has."""
    def make(columns):
        firsts = [prefix(shingle_set(t), counts).view(np.int64) for t in columns["text"]]
        sizes = list(map(len, firsts))
        none = np.zeros(0, np.int64)
        return {"key": pa.array(np.concatenate([none, *firsts])), "set": pa.array(np.repeat(np.array(columns["set"], np.int64), sizes)),
                "place": pa.array(np.concatenate([none, *map(np.arange, sizes)]))}
    made = by_batch(texts.select("set", "text"), "key long, set long, place long", make)
    return made.repartition("key").sortWithinPartitions("key", "set").mapInArrow(_shared, "key long, set long, place long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of key, those whose key comes more than once; the last row waits for the next batch."""
    names, held, known = ("key", "set", "place"), np.zeros((3, 0), np.int64), False
    for batch in batches:
        rows = np.concatenate([held, np.stack([batch.column(n).to_numpy() for n in names])], axis=1)
        if not rows.shape[1]:
            continue
        same = rows[0, 1:] == rows[0, :-1]
        shared = np.append(same, False)
        shared[1:] |= same
        shared[0] |= known
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[:, :-1][:, shared[:-1]]], names=list(names))
        held, known = rows[:, -1:], bool(shared[-1])
    if known:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=list(names))


def groups(docs: DataFrame) -> DataFrame:
    """node, root for every different text: the same root where links of SIMILARITY or more lead, also over others.

    Texts with equal shingle sets are one node of the search. In each round every
    key, a shingle of prefixes, draws some of its sets as pivots, which meet those of
    its sets that are not in their group yet, and are then done with the key; keys
    whose sets are all in one group are done. The bounds in the join leave pairs
    that are alike but for few, so a large group of copies, which shrinks with each
    pivot, takes pairs in proportion to its size. Only counts of COUNTERS places
    pass through the driver. Shuffle files go with the step that wrote them, and
    the few pairs of a round are one file, met without shuffles.
    """
    with session.shuffles_dropped(docs.sparkSession):
        return _groups(docs)


def _groups(docs: DataFrame) -> DataFrame:
    texts = session.materialize(docs.select(text_hash().alias("node"), F.col("text").cast("string").alias("text")).dropDuplicates(["node"]), "near-texts")
    sketches = session.materialize(_sketches(texts), "near-sketches")
    maps = [f"m{i}" for i in range(MAP_WORDS)]
    sets = session.materialize(sketches.groupBy("set").agg(*[F.min(c).alias(c) for c in ("node", "size", "fp", *maps)]), "near-sets")
    counts = shingle_counts(texts)
    postings = session.materialize(_postings(texts.join(sets.select("node", "set"), "node").select("set", "text"), counts), "near-postings")

    heads = session.materialize(sets.groupBy("fp").agg(F.min("set").alias("head"), F.min_by("node", "set").alias("head_node")), "near-heads")
    links = session.materialize(simhash.links(heads.select("fp")), "near-fingerprints")
    near = sets.join(heads, "fp").where("set != head").select(F.col("head").alias("a"), F.col("set").alias("b"), F.col("head_node").alias("a_node"), F.col("node").alias("b_node"))
    for name in ("a", "b"):
        links = links.join(heads.select(F.col("fp").alias(name), F.col("head").alias(f"{name}_set"), F.col("head_node").alias(f"{name}_node")), name)
    pairs = near.unionByName(links.select(F.col("a_set").alias("a"), F.col("b_set").alias("b"), "a_node", "b_node"))
    tested = session.gathered(_ordered(pairs), "near-pairs")
    roots = _joined(sets.select("set", F.col("set").alias("root")), _alike(tested, texts))
    pivots = 1
    while True:
        left = session.materialize(_open(postings, roots), "near-open")
        if left.isEmpty():
            break
        pivot = session.materialize(left.groupBy("key", F.pmod(F.xxhash64("set", F.lit(pivots)), F.lit(pivots)).alias("class"))
                                    .agg(F.min("set").alias("set"), *[F.min_by(c, "set").alias(c) for c in ("place", "root", "n")]).drop("class"), "near-pivots")
        pairs = session.gathered(_pairs(left, pivot, sets).join(tested, ["a", "b"], "left_anti"), "near-pairs")
        if not pairs.isEmpty():
            tested = tested.unionByName(pairs)
            roots = _joined(roots, _alike(pairs, texts))
        postings = left.select("key", "set", "place").join(pivot, ["key", "set"], "left_anti")
        pivots *= MORE_PIVOTS
    return sketches.select("node", "set").join(roots, "set").select("node", "root")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots (set, root) after further links a, b between sets: only the groups that these join are gone through."""
    for name in ("a", "b"):
        links = session.gathered(links, "near-links").join(roots.select(F.col("set").alias(name), F.col("root").alias(f"{name}_root")), name)
    links = session.gathered(links.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).where("a != b").distinct(), "near-links")
    if links.isEmpty():
        return roots
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    moved = session.materialize(components.connected(nodes, links), "near-moved").select(F.col("node").alias("root"), F.col("root").alias("to"))
    return session.materialize(roots.join(moved, "root", "left").select("set", F.coalesce("to", "root").alias("root")), "near-roots")


def _open(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings of the keys that hold sets of several groups, with the set's root and the key's number of rows."""
    labelled = postings.join(roots, "set")
    several = labelled.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("z"), F.count("*").alias("n")).where("a < z")
    return labelled.join(several.select("key", "n"), "key")


def _pairs(left: DataFrame, pivot: DataFrame, sets: DataFrame) -> DataFrame:
    """Different pairs a < b of a pivot and a set of its key in another group that the bounds allow to be alike; the nodes of both."""
    maps = [f"m{i}" for i in range(MAP_WORDS)]
    rows = left.join(sets.select("set", "node", "size", *maps), "set")
    chosen = pivot.join(sets.select("set", "node", "size", *maps), "set")
    parts = (F.col("n") / SALTED).cast("int")
    chosen = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), parts)))
    chosen = chosen.select("key", "part", *[F.col(c).alias(f"p_{c}") for c in ("set", "node", "place", "root", "size", *maps)])
    size = F.col("size") + F.col("p_size")
    differing = sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"p_{m}"))) for m in maps[1:]), F.bit_count(F.col("m0").bitwiseXOR(F.col("p_m0"))))
    allowed = ((F.col("root") != F.col("p_root")) & (5 * F.least("size", "p_size") >= 4 * F.greatest("size", "p_size"))
               & (9 * F.least(F.col("size") - F.col("place"), F.col("p_size") - F.col("p_place")) >= 4 * size) & (9 * differing <= size))
    met = rows.withColumn("part", F.pmod(F.xxhash64("set"), parts + 1).cast("int")).join(chosen, ["key", "part"]).where(allowed)
    return _ordered(met.select(F.col("set").alias("a"), F.col("p_set").alias("b"), F.col("node").alias("a_node"), F.col("p_node").alias("b_node")))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair of sets once, with a < b, and the nodes of both."""
    swapped = F.col("a") > F.col("b")
    sides = [F.when(swapped, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("a_node", "b_node"), ("b_node", "a_node"))]
    return pairs.select(*sides).groupBy("a", "b").agg(F.min("a_node").alias("a_node"), F.min("b_node").alias("b_node"))


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b whose texts reach SIMILARITY. A set with many partners meets them in parts.

    Pairs are few beside the texts; written first, they are sent to the texts while
    small, and no text moves that is in none.
    """
    many = pairs.groupBy("a").agg(F.count("*").alias("n"))
    parted = pairs.join(many, "a").withColumn("part", F.pmod(F.xxhash64("b"), (F.col("n") / 1000).cast("int") + 1).cast("int"))
    parted = session.gathered(parted.select("a", "b", "part", "a_node", "b_node"), "near-parted")
    firsts = session.materialize(parted.select("a", "a_node", "part").distinct().join(
        texts.select(F.col("node").alias("a_node"), F.col("text").alias("a_text")), "a_node").select("a", "part", "a_text"), "near-firsts")
    joined = parted.join(texts.select(F.col("node").alias("b_node"), F.col("text").alias("b_text")), "b_node").join(firsts, ["a", "part"])

    def make(columns):
        kept, last, first = [], None, None
        for a, b, a_text, b_text in zip(columns["a"], columns["b"], columns["a_text"], columns["b_text"]):
            if a != last:
                last, first = a, shingle_set(a_text)
            if alike(first, shingle_set(b_text)):
                kept.append((a, b))
        return {"a": pa.array([k[0] for k in kept], pa.int64()), "b": pa.array([k[1] for k in kept], pa.int64())}
    return by_batch(joined.select("a", "b", "a_text", "b_text"), "a long, b long", make)
