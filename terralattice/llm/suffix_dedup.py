"""Removal of repeated byte strings by suffix arrays and their interval trees.

Windows of `window` bytes pick an anchor each (see winnow), and only stretches
around anchors whose seed occurs in several texts are looked at further. Those
stretches are brought together by seed and their suffixes sorted; a stack scan of
the sorted suffixes yields the intervals of common prefixes, and those whose
occurrences differ in the byte before are the maximal repeats, each with all its
occurrences. Equal windows have equal seeds, so no repeat is split.

Copies of a whole text are one string of the array, held by the smallest doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from terralattice import session
from terralattice.llm import winnow
from terralattice.llm.common import LEAST, by_batch, order_id

WINDOW = 50
SEED_BYTES = 20
CROWD = 20_000  # texts of a seed beyond which its windows are sorted under keys of their own
CHUNK = 20_000  # stretches sorted at once, but all of a key
MAX_BROADCAST_ROWS = 1_000_000

_SYMBOL = winnow.mix(np.arange(1, 257, dtype=np.uint64))


def _anchors(text: bytes, window: int, seed_bytes: int):
    """Hashes, and seed (48 bits), offset in the first window, first window and number of windows of each anchor."""
    hashes = winnow.Hashes(_SYMBOL[np.frombuffer(text, np.uint8)])
    seeds = hashes.grams(seed_bytes)
    at, first, last = winnow.anchors(seeds, window - seed_bytes + 1)
    return hashes, (seeds[at] >> np.uint64(16)).astype(np.int64), at - first, first, last - first + 1


def _joined(parts: list[tuple], width: int) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]) for i in range(width)]


def _place(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return first + (count << 32)


def _span(at: int) -> tuple[int, int]:
    return at & 0xFFFFFFFF, at >> 32


def _distinct(columns: dict[str, list], window: int) -> Iterator[tuple[int, int, bytes]]:
    """(hash, smallest doc, text) of the texts of a batch that hold a window, each once."""
    least: dict[int, tuple[int, bytes]] = {}
    for h, doc, text in zip(columns["h"], columns["doc"], columns["text"]):
        if len(text) >= window and (h not in least or doc < least[h][0]):
            least[h] = doc, text
    return ((h, doc, text) for h, (doc, text) in least.items())


def _seeds(docs: DataFrame, window: int, seed_bytes: int) -> DataFrame:
    """Seeds of each text. Of a seed met in several texts of a batch, all are known to be
    shared (mark 1), and one more row with twice their number as mark goes to meet other batches."""
    def make(columns):
        parts = []
        for h, _, text in _distinct(columns, window):
            seeds = np.unique(_anchors(text, window, seed_bytes)[1])
            parts.append((seeds, np.full(len(seeds), h)))
        seed, h = _joined(parts, 2)
        order = np.argsort(seed, kind="stable")
        seed, h = seed[order], h[order]
        start = np.flatnonzero(np.concatenate((np.ones(min(1, len(seed)), bool), seed[1:] != seed[:-1])))
        n = np.diff(np.append(start, len(seed)))
        known = np.repeat(n > 1, n)
        alone = _joined([(seed[start], h[start], 2 * n)], 3)
        back = np.argsort(order[start])  # in the order of texts, which compresses better
        out = [tuple(c[back] for c in alone), (seed[known], h[known], np.ones(known.sum(), np.int64))]
        return dict(zip(("seed", "h", "mark"), map(pa.array, _joined(out, 3))))
    return by_batch(docs, "seed long, h long, mark long", make)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes seeds in order of (seed, h); yields the texts of shared ones, and once each crowded seed."""
    last, count, shared, held = None, 0, False, None  # of the last seed; held: its only text so far
    for batch in batches:
        seed, h, mark = (batch.column(c).to_numpy() for c in ("seed", "h", "mark"))
        known = mark == 1
        out = [(seed[known], h[known], np.zeros(known.sum(), np.int64))]
        seed, h, n = seed[~known], h[~known], mark[~known] // 2
        if len(seed):
            start = np.flatnonzero(np.concatenate(([True], seed[1:] != seed[:-1])))
            length = np.diff(np.append(start, len(seed)))
            several, totals = h[start] < np.maximum.reduceat(h, start), np.add.reduceat(n, start)
            before = np.zeros(len(start), np.int64)
            if seed[0] == last:
                before[0] = count
                several[0] |= shared or held is not None and held != h[0]
                if several[0] and held is not None:
                    out.append((np.array([last]), np.array([held]), np.zeros(1, np.int64)))
            chosen = np.repeat(several, length)
            out.append((seed[chosen], h[chosen], np.zeros(chosen.sum(), np.int64)))
            crowded = (before <= CROWD) & (before + totals > CROWD)
            out.append((seed[start][crowded], np.zeros(crowded.sum(), np.int64), np.ones(crowded.sum(), np.int64)))
            last, count, shared = seed[-1], before[-1] + totals[-1], bool(several[-1])
            held = None if shared else h[-1]
        seed, h, crowd = _joined(out, 3)
        yield pa.RecordBatch.from_pydict({"seed": pa.array(seed), "h": pa.array(h), "crowded": pa.array(crowd == 1)})


def _candidates(docs: DataFrame, window: int, seed_bytes: int) -> DataFrame:
    """h, seeds, crowded: per text the seeds it shares, and those of them that very many share."""
    where = F.when(F.col("mark") == 1, F.xxhash64("seed", "h")).otherwise(F.col("seed"))
    passed = _seeds(docs, window, seed_bytes).repartition(where).sortWithinPartitions("seed", "h")
    found = session.materialize(passed.mapInArrow(_shared, "seed long, h long, crowded boolean"), "shared-seeds")
    crowd = found.where("crowded").select("seed", F.lit(True).alias("many"))
    if crowd.count() <= MAX_BROADCAST_ROWS:
        crowd = F.broadcast(crowd)
    marked = found.where("not crowded").select("seed", "h").join(crowd, "seed", "left")
    return marked.groupBy("h").agg(F.collect_set("seed").alias("seeds"), F.collect_set(F.when(F.col("many"), F.col("seed"))).alias("crowded"))


def _stretches(units: DataFrame, window: int, seed_bytes: int) -> DataFrame:
    """Rows to meet by key: the bytes of all windows that picked a shared anchor. Of rows alike in
    a batch only the first document's goes on; the others repeat it in whole and are `settled`."""
    def make(columns):
        unpack = zstandard.ZstdDecompressor().decompress
        rows, pieces = [], []
        for h, doc, blob, seeds, many in zip(*(columns[c] for c in ("h", "doc", "blob", "seeds", "crowded"))):
            if not seeds:
                continue
            text = unpack(blob)
            hashes, seed, offset, first, count = _anchors(text, window, seed_bytes)
            wanted = np.isin(seed, np.array(seeds, np.int64))
            seed, offset, first, count = seed[wanted], offset[wanted], first[wanted], count[wanted]
            if many:
                apart = np.isin(seed, np.array(many, np.int64))
                alone = np.unique(np.concatenate([first[:0], *(np.arange(a, a + n) for a, n in zip(first[apart], count[apart]))]))
                seed = np.concatenate((seed[~apart], hashes.of(alone, alone + window).view(np.int64)))
                offset = np.concatenate((offset[~apart], np.zeros(len(alone), np.int64)))
                first = np.concatenate((first[~apart], alone))
                count = np.concatenate((count[~apart], np.ones(len(alone), np.int64)))
            end = first + count - 1 + window
            form = winnow.mix(hashes.of(first, end) + winnow.mix(offset.astype(np.uint64))).view(np.int64)
            rows.append((seed, form, np.full(len(seed), doc), np.full(len(seed), h), _place(first, count)))
            pieces.extend([text[a:b] for a, b in zip(first.tolist(), end.tolist())])
        key, form, doc, h, at = _joined(rows, 5)
        order = np.lexsort((doc, form, key))
        key, form, doc, h, at = (c[order] for c in (key, form, doc, h, at))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (form[1:] != form[:-1])
        earliest = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))] if len(doc) else doc
        later = doc > earliest
        return {"key": pa.array(key), "doc": pa.array(doc), "h": pa.array(h), "at": pa.array(at), "settled": pa.array(later),
                "piece": pa.array([None if l else pieces[i] for i, l in zip(order.tolist(), later.tolist())], pa.binary())}
    return by_batch(units, "key long, doc long, h long, at long, settled boolean, piece binary", make)


def intervals(common: list[int], before: list[int], ids: list[int], least: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """Common-prefix intervals of a suffix array: (left, right, depth, smallest id, left-diverse).

    `common[i]` is the common prefix of suffixes i-1 and i in sorted order; intervals
    shorter than `least` are passed over. One scan with a stack: an interval closes where
    the common prefix falls below its depth, and hands its id and its bytes before
    on to the one around it. `before` is the byte before each suffix, -1 if unknown.
    """
    stack: list[list] = []  # depth, left, smallest id, byte before (-1: diverse)
    n = len(common)
    for i in range(1, n + 1):
        depth = common[i] if i < n else 0
        left, small, byte = i - 1, ids[i - 1], before[i - 1]
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            top[2] = min(top[2], small)
            if byte != top[3]:
                top[3] = -1
            yield top[1], i - 1, top[0], top[2], top[3] == -1
            left, small, byte = top[1], top[2], top[3]
        if depth < least:
            continue
        if stack and stack[-1][0] == depth:
            stack[-1][2] = min(stack[-1][2], small)
            if byte != stack[-1][3]:
                stack[-1][3] = -1
        else:
            stack.append([depth, left, small, byte])


def suffix_array(pieces: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted suffixes of at least `window` bytes: their piece, their offset, common prefix with the one before, byte before."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    width = int(sizes.max())
    text = np.frombuffer(b"".join(pieces) + bytes(width), np.uint8)
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    n = sizes - window + 1
    piece = np.repeat(np.arange(len(pieces)), n)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    start, size = base[piece] + offset, sizes[piece] - offset
    rows = np.lib.stride_tricks.sliding_window_view(text, width)[start]
    rows[np.arange(width) >= size[:, None]] = 0
    order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
    rows, size = rows[order], size[order]
    common = np.zeros(len(order), np.int64)
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
    before = np.where(offset[order] > 0, text[start[order] - 1].astype(np.int64), -1)
    return piece[order], offset[order], common, before


def _repeats(docs: list[int], places: list[list[tuple[int, int]]], pieces: list[bytes], window: int):
    """Repeated bytes of later documents among stretches: h, place (first byte, number of bytes).

    `places` are (h, at) of all copies of a stretch in its document; they share its finds.
    """
    piece, offset, common, before = suffix_array(pieces, window)
    ids = np.array(docs)[piece]
    linked = common >= window
    inside = linked | np.append(linked[1:], False)  # suffixes alone in their interval say nothing
    piece, offset, common, before, ids = piece[inside], offset[inside], common[inside], before[inside], ids[inside]
    rows, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for left, right, depth, small, diverse in intervals(common.tolist(), before.tolist(), ids.tolist(), window):
        if diverse:
            later = left + np.flatnonzero(ids[left:right + 1] > small)
            rows.append(later)
            sizes.append(np.full(len(later), depth))
    row, size = np.concatenate(rows), np.concatenate(sizes)
    copies = np.fromiter(map(len, places), np.int64, len(places))
    h, at = np.array([p for part in places for p in part], np.int64).reshape(-1, 2).T
    n = copies[piece[row]]
    ends = np.cumsum(n)
    origin = np.repeat((np.cumsum(copies) - copies)[piece[row]] - (ends - n), n) + np.arange(int(n.sum()))
    return h[origin], _place((at[origin] & 0xFFFFFFFF) + np.repeat(offset[row], n), np.repeat(size, n))


def _spans(h: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Spans of bytes, those of a text that touch or overlap as one."""
    first, end = at & 0xFFFFFFFF, (at & 0xFFFFFFFF) + (at >> 32)
    order = np.lexsort((first, h))
    h, first, end = h[order], first[order], end[order]
    if len(h):
        new = np.ones(len(h), bool)
        group = np.cumsum(np.concatenate(([0], h[1:] != h[:-1]))) << 33  # so that no text reaches into the next
        reach = np.maximum.accumulate(end + group)
        new[1:] = first[1:] + group[1:] > reach[:-1]
        start = np.flatnonzero(new)
        h, first, end = h[start], first[start], np.maximum.reduceat(end, start)
    return pa.RecordBatch.from_pydict({"h": pa.array(h), "at": pa.array(_place(first, end - first))})


def _scan(window: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Passes stretches in order of (key, piece, doc), some keys at a time. Copies of a stretch in its first document are one."""
        held: list[list] = [[], [], [], []]  # key, doc, places and piece of stretches of different form
        last_key = last_piece = first_doc = None

        def flush(n: int):
            _, docs, places, pieces = (h[:n] for h in held)
            for h in held:
                del h[:n]
            if n > 1:
                yield _spans(*_repeats(docs, places, pieces, window))

        for batch in batches:
            settled = batch.column("settled").to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(~settled)
            key, doc, h, at = (batch.column(c).to_numpy() for c in ("key", "doc", "h", "at"))
            whole = _place(at & 0xFFFFFFFF, (at >> 32) - 1 + window)
            done = [(h[settled], whole[settled])]
            if len(rows):
                key, doc, h, at, whole = (c[rows] for c in (key, doc, h, at, whole))
                piece = batch.column("piece").take(pa.array(rows))
                new = np.ones(len(key), bool)
                new[0] = key[0] != last_key or piece[0].as_py() != last_piece
                new[1:] = (key[1:] != key[:-1]) | pc.not_equal(piece[1:], piece[:-1]).to_numpy(zero_copy_only=False)
                start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
                earliest = np.where(start >= 0, doc[start], 0 if first_doc is None else first_doc)
                later = doc > earliest  # alike to a stretch of an earlier document
                done.append((h[later], whole[later]))
                last_key, last_piece, first_doc = key[-1], piece[len(key) - 1].as_py(), earliest[-1]
                for i in np.flatnonzero(~later).tolist():  # the first document's
                    if new[i] or not held[0]:
                        for part, value in zip(held, (int(key[i]), int(doc[i]), [], piece[i].as_py())):
                            part.append(value)
                    held[2][-1].append((int(h[i]), int(at[i])))
            yield _spans(*_joined(done, 2))
            while len(held[0]) > CHUNK:
                cut = next((i for i in range(CHUNK, 0, -1) if held[0][i] != held[0][i - 1]), 0) or _last_start(held[0])
                if not cut:
                    break
                yield from flush(cut)
        yield from flush(len(held[0]))
    return each


def _last_start(keys: list[int]) -> int:
    """Where the last run of equal keys starts."""
    at = len(keys) - 1
    while at and keys[at - 1] == keys[at]:
        at -= 1
    return at


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed_bytes: int = SEED_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans: what goes from each text as repeated.

    A byte goes if some string of `window` bytes that covers it also starts in a
    document with a smaller doc_id; strings are judged on the input and never
    cross documents. `spans` are the runs that go, (first byte, bytes) each; `cut`
    takes them out of texts. kept_sha256 is of the bytes left.

    Null and empty texts have no bytes. A null doc_id is smaller than any other.
    Rows that repeat a doc_id keep all that no smaller id has. Other columns of
    `docs` are not read. Equal texts are found by a 64-bit hash and confirmed by
    SHA-256.
    """
    held = docs.select(order_id().alias("doc"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).withColumn("h", F.xxhash64("text"))
    thin = session.materialize(held.select("doc", "h", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    first = thin.groupBy("h").agg(F.min("doc").alias("first"))

    def pack(columns):
        compress = zstandard.ZstdCompressor(level=3).compress
        rows = [(h, doc, compress(text)) for h, doc, text in _distinct(columns, window)]
        return {"h": pa.array([r[0] for r in rows], pa.int64()), "doc": pa.array([r[1] for r in rows], pa.int64()), "blob": pa.array([r[2] for r in rows], pa.binary())}
    packed = by_batch(held, "h long, doc long, blob binary", pack)  # texts travel compressed, once for both uses

    asked = packed.join(first, "h", "left").join(_candidates(held, window, seed_bytes), "h", "left").where("doc = first")
    rows = _stretches(asked.select("h", "doc", "blob", "seeds", "crowded"), window, seed_bytes)
    where = F.when(F.col("settled"), F.xxhash64("h", "at")).otherwise(F.col("key"))
    met = rows.repartition(where).sortWithinPartitions("key", "piece", "doc")
    spans = met.mapInArrow(_scan(window), "h long, at long").groupBy("h").agg(F.collect_list("at").alias("spans"))

    def kept(columns):
        unpack = zstandard.ZstdDecompressor().decompress
        runs, shas, wholes = [], [], []
        for blob, spans in zip(columns["blob"], columns["spans"]):
            text = unpack(blob)
            runs.append(_merge(spans or ()))
            wholes.append(hashlib.sha256(text).hexdigest())
            shas.append(hashlib.sha256(_without(text, runs[-1])).hexdigest() if spans else wholes[-1])
        return {"h": columns["h"], "first": columns["doc"], "whole": wholes, "kept": shas,
                "gone": pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("bytes", pa.int64())])))}
    united = packed.join(first, "h", "left").join(spans, "h", "left").where("doc = first")
    units = by_batch(united.select("h", "doc", "blob", "spans"), "h long, first long, whole string, kept string, gone array<struct<first:bigint,bytes:bigint>>", kept)
    joined = thin.join(units.dropDuplicates(["h"]), "h", "left")
    own, copy = F.col("doc") == F.col("first"), F.col("sha") == F.col("whole")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("bytes")))
    nothing = F.slice(everything, 1, 0)
    gone = F.when(copy & own, F.col("gone")).when(copy, everything).otherwise(nothing)
    sha = F.when(copy & own, F.col("kept")).when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha"))
    out = joined.select(F.when(F.col("doc") != LEAST, F.col("doc")).alias("doc_id"), "n_bytes", sha.alias("kept_sha256"), gone.alias("spans"))
    return out.select("doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["bytes"]).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans")


def _merge(places) -> list[dict[str, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[dict[str, int]] = []
    for first, count in sorted(map(_span, places)):
        if out and first <= out[-1]["first"] + out[-1]["bytes"]:
            out[-1]["bytes"] = max(out[-1]["bytes"], first + count - out[-1]["first"])
        else:
            out.append({"first": first, "bytes": count})
    return out


def _without(text: bytes, spans) -> bytes:
    at, left = 0, []
    for span in spans:
        left.append(text[at:span["first"]])
        at = span["first"] + span["bytes"]
    return b"".join([*left, text[at:]])


def cut(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """doc_id, kept: the bytes (binary) of each text without the spans of remove_repeats; rows meet by doc_id."""
    rows = docs.select(order_id().alias("doc"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    joined = rows.join(removed.select(order_id().alias("doc"), "spans").dropDuplicates(["doc"]), "doc", "left")

    def make(columns):
        return {"doc": columns["doc"], "kept": pa.array([_without(t, s or ()) for t, s in zip(columns["text"], columns["spans"])], pa.binary())}
    return by_batch(joined.select("doc", "text", "spans"), "doc long, kept binary", make).select(
        F.when(F.col("doc") != LEAST, F.col("doc")).alias("doc_id"), "kept")
