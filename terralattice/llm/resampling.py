"""Importance resampling towards a target distribution over hashed n-gram features.

Documents are scored by gains held in an array, one per feature bucket, that say how
much more likely a feature is in the target than in the corpus; seeded Gumbel noise
turns the highest scores into a sample without replacement in proportion to the
importance weights. Scores are ranked by a distributed radix sort.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terralattice import session
from terralattice.llm import radix
from terralattice.llm.common import LEAST, by_batch, order_id

BUCKETS = 10_000
WORDS = 1  # longest run of words that is a feature
UNIT = 1000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

_WORD_BYTES = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORD_BYTES else 32 for b in range(256))


def features(text: bytes | None, longest: int = WORDS, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """Buckets of all runs of 1 to `longest` words, repeats included, and the number of words."""
    words = (text or b"").translate(_PLAIN).split()  # all that is no word byte is a space by now
    found = list(map(zlib.crc32, words))
    for k in range(2, longest + 1):
        found += map(zlib.crc32, map(b" ".join, zip(*(words[i:] for i in range(k)))))
    return np.array(found, np.int64) % buckets, len(words)


def bucket_counts(rows: DataFrame, longest: int = WORDS, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """Features per bucket over all rows; each task sends its own sums, a row per bucket at most."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts += np.bincount(features(value, longest, buckets)[0], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used.astype(np.int32)), "n": pa.array(counts[used])})
    made = rows.select(F.col(text).cast("binary")).mapInArrow(each, "bucket int, n long")
    found = made.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most `buckets` rows
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket how much more likely it is in the target, in 1/UNIT nats; counts are raised by one."""
    n, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(UNIT * math.log((t + 1) * (all_corpus + n) / ((s + 1) * (all_target + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in 1/UNIT nats, fixed by seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-UNIT * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, longest: int = WORDS, buckets: int = BUCKETS,
             seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank per row of `docs`; rank, from 1, is null where a row is not drawn.

    Rows of at least `min_words` words may be drawn; `percent` of their number are,
    by the highest score, then the smaller doc_id, then as they were read. Null and
    empty texts have no features and weight 0, a null doc_id stays null, comes before
    others and is hashed as an empty text. Repeated rows are rows of their own. An
    empty target leaves only what is rare in `docs` preferred. Other columns are not
    read. Only the bucket counts pass through the driver.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))

    def make(columns):
        found = [features(t, longest, buckets) for t in columns["text"]]
        weight = [int(gain[f].sum()) // len(f) if len(f) else 0 for f, _ in found]
        score = [w + noise(d, seed) for w, d in zip(weight, columns["doc_id"])]
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "n_features": [len(f) for f, _ in found],
                "weight": weight, "score": score, "words": [n for _, n in found]}
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    scored = session.materialize(by_batch(named, "doc_id long, n_features long, weight long, score long, words long", make), "scored")
    able = F.col("words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    ordered = radix.ranks(scored.where(able).select((-F.col("score")).alias("down"), order_id().alias("id"), "n_features", "weight"), ["down", "id"])
    ranked = ordered.select(F.when(F.col("id") != LEAST, F.col("id")).alias("doc_id"), "n_features", "weight", (-F.col("down")).alias("score"),
                            F.when(F.col("rank") < drawn, F.col("rank") + 1).alias("rank"))
    rest = scored.where(~able).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
