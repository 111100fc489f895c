"""Removal of repeated word passages by seed and extend.

Every window of `window` words picks one of its word n-grams as an anchor, by
content alone (winnowing, Schleimer et al. 2003), so equal windows meet at equal
anchors. Anchors that share a seed are compared by how far they extend, both ways,
over all windows that picked them; where that decides nothing, at the ends of a
repeat, window by window. Groups of any size are passed in order, never in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from terralattice import session
from terralattice.llm import winnow
from terralattice.llm.common import LEAST, by_batch, order_id

WINDOW = 13
SEED_WORDS = 5
_FOUND = "doc long, node long, at long, open boolean"


def _node(text: bytes) -> int:
    """Tells apart texts of one doc_id; the same as xxhash64 gives in Spark."""
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (1 << 64) if value >> 63 else value


class Place:
    """Packs a first window and a number of windows into a long."""

    @staticmethod
    def pack(first: np.ndarray, count: np.ndarray) -> np.ndarray:
        return (count.astype(np.int64) << 32) | first.astype(np.int64)

    @staticmethod
    def span(at: int) -> tuple[int, int]:
        return at & 0xFFFFFFFF, at >> 32


def _hashes(words: list[bytes], seed: int = 0) -> winnow.Hashes:
    return winnow.Hashes(np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64))


def _sequence(text: bytes, window: int, width: int) -> tuple[list[bytes], winnow.Hashes | None, tuple]:
    """Words, their hashes, and (seed, extension, first, count) of each anchor."""
    words = text.split()
    if len(words) < window:
        return words, None, ()
    hashes = _hashes(words)
    seeds = hashes.grams(window - width + 1)
    at, first, last = winnow.anchors(seeds, width)
    extended = winnow.mix(hashes.of(first, last + window) + winnow.mix((at - first).astype(np.uint64)))
    return words, hashes, (seeds[at].view(np.int64), extended.view(np.int64), first, last - first + 1)


def _columns(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _seeds(docs: DataFrame, window: int, width: int) -> DataFrame:
    """One row per anchor. Of anchors alike in a batch only the first document's goes on as open."""
    def make(columns):
        parts = [[np.zeros(0, np.int64)] * 5]
        for doc, text in zip(columns["doc"], columns["text"]):
            found = _sequence(text, window, width)[2]
            if found:
                seed, extended, first, count = found
                parts.append([seed, extended, np.full(len(seed), doc), np.full(len(seed), _node(text)), Place.pack(first, count)])
        seed, extended, doc, node, at = map(np.concatenate, zip(*parts))
        order = np.lexsort((doc, extended, seed))
        seed, extended, doc, node, at = (c[order] for c in (seed, extended, doc, node, at))
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (extended[1:] != extended[:-1])
        first_doc = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))] if len(doc) else doc
        later = doc > first_doc
        seed = np.where(later, winnow.mix((at ^ node).view(np.uint64)).view(np.int64), seed)  # settled rows are spread anyhow
        return {"seed": pa.array(seed), "extended": pa.array(extended), "doc": pa.array(doc), "node": pa.array(node), "at": pa.array(at),
                "settled": pa.array(later)}
    return by_batch(docs, "seed long, extended long, doc long, node long, at long, settled boolean", make)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes anchors in order of (seed, extended, doc); holds only the open anchors of one document and seed.

    An anchor alike to one of an earlier document, seed and extension, is settled:
    all its windows are repeats. Those of the first document of each extension stay
    open where their seed has others in other documents.
    """
    last_seed = last_extended = first_doc = None
    held: list[tuple[int, int, int]] = []  # open anchors of the current seed while all are of one document
    shared = False  # whether the current seed has open anchors of several documents
    for batch in batches:
        seed, extended, doc, node, at = (batch.column(c).to_numpy() for c in ("seed", "extended", "doc", "node", "at"))
        settled = batch.column("settled").to_numpy(zero_copy_only=False)
        yield _columns(doc=pa.array(doc[settled]), node=pa.array(node[settled]), at=pa.array(at[settled]), open=pa.array(np.zeros(settled.sum(), bool)))
        seed, extended, doc, node, at = (c[~settled] for c in (seed, extended, doc, node, at))
        if not len(seed):
            continue
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (extended[1:] != extended[:-1])
        new[0] = seed[0] != last_seed or extended[0] != last_extended
        start = np.maximum.accumulate(np.where(new, np.arange(len(seed)), -1))
        earliest = np.where(start >= 0, doc[start], 0 if first_doc is None else first_doc)
        later = doc > earliest
        out = [(doc[later], node[later], at[later], np.zeros(later.sum(), bool))]

        reps = np.flatnonzero(~later)  # a document's own copies of a stretch all stay open
        if len(reps):
            runs = np.flatnonzero(np.concatenate(([True], seed[reps][1:] != seed[reps][:-1])))
            low, high = np.minimum.reduceat(doc[reps], runs), np.maximum.reduceat(doc[reps], runs)
            several = low < high
            if seed[reps[0]] == last_seed:  # goes on from the batch before
                several[0] |= shared or any(d not in (low[0], high[0]) for d, _, _ in held)
                if several[0] and held:
                    out.append((*np.array(held, np.int64).T, np.ones(len(held), bool)))
                    held = []
            else:
                held = []
            chosen = reps[np.repeat(several, np.diff(np.append(runs, len(reps))))]
            out.append((doc[chosen], node[chosen], at[chosen], np.ones(len(chosen), bool)))
            if not several[-1]:
                tail = reps[runs[-1]:]
                held = held + list(zip(doc[tail].tolist(), node[tail].tolist(), at[tail].tolist()))
            else:
                held = []
            shared = bool(several[-1])
        last_seed, last_extended, first_doc = seed[-1], extended[-1], earliest[-1]
        made = [np.concatenate(c) for c in zip(*out)]
        yield _columns(**{n: pa.array(c) for n, c in zip(("doc", "node", "at", "open"), made)})


def repeated_windows(docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """doc, node, spans: per document the windows whose words also start in a document with a smaller id.

    `docs` has doc (never null), node (the hash of the text, which tells apart texts
    of one id) and text (binary, never null). A span is (first window, number of
    windows), packed. Windows left open by their anchors meet on two independent
    hashes of 64 bits.
    """
    width = window - seed_words + 1
    anchors = _seeds(docs, window, width).repartition("seed").sortWithinPartitions("seed", "extended", "doc")
    found = session.materialize(anchors.mapInArrow(_compare, _FOUND), "passages")
    asked = found.where("open").groupBy("doc", "node").agg(F.collect_list("at").alias("spans"))  # at most one per word

    def windows(columns):
        parts = [[np.zeros(0, np.int64)] * 5]
        for doc, node, text, spans in zip(columns["doc"], columns["node"], columns["text"], columns["spans"]):
            if spans:
                words = text.split()
                first = np.unique(np.concatenate([np.arange(a, a + n) for a, n in map(Place.span, spans)]))
                both = [_hashes(words, seed).of(first, first + window).view(np.int64) for seed in (0, 1)]
                parts.append([np.full(len(first), doc), np.full(len(first), node), Place.pack(first, np.ones(len(first))), *both])
        return {n: pa.array(np.concatenate(c)) for n, c in zip(("doc", "node", "at", "hash", "other"), zip(*parts))}
    open_windows = session.materialize(by_batch(docs.join(asked, ["doc", "node"]), "doc long, node long, at long, hash long, other long", windows),
                                       "passage-ends")
    first = open_windows.groupBy("hash", "other").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    late = open_windows.join(first.select("hash", "other", "least"), ["hash", "other"]).where("doc > least").select("doc", "node", "at")
    closed = found.where("not open").select("doc", "node", "at").unionByName(late)
    return closed.groupBy("doc", "node").agg(F.collect_list("at").alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept: texts without the words of repeated windows.

    A word goes if some window of `window` words that holds it also starts in a
    document with a smaller doc_id; windows are judged on the input. Words are the
    texts' own bytes, apart at space and 0x09-0x0D; the kept ones are joined by a
    space (`kept`, binary).

    Null and empty texts have no words. A null doc_id is smaller than any other.
    Rows that repeat a doc_id keep all that no smaller id has. Other columns of
    `docs` are not read.
    """
    held = (docs.select(order_id().alias("doc"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
            .withColumn("node", F.xxhash64("text")))

    def kept(columns):
        out = []
        for text, spans in zip(columns["text"], columns["spans"]):
            words = text.split()
            edges = np.zeros(len(words) + 1, np.int64)
            for first, count in map(Place.span, spans or ()):
                edges[first] += 1
                edges[first + count - 1 + window] -= 1
            stay = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
            out.append((len(words), len(words) - len(stay), b" ".join([words[i] for i in stay.tolist()])))
        return {"doc": columns["doc"], "n_words": [r[0] for r in out], "n_removed": [r[1] for r in out],
                "kept": pa.array([r[2] for r in out], pa.binary())}
    spans = repeated_windows(held, window, seed_words)
    done = by_batch(held.join(spans, ["doc", "node"], "left"), "doc long, n_words long, n_removed long, kept binary", kept)
    return done.select(F.when(F.col("doc") != LEAST, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept")
