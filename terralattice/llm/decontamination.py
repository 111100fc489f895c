"""Benchmark decontamination: rare n-gram seeds join passages to test items, then Smith-Waterman alignment.

Seeds are pairs of words at most two apart. An alignment that reaches a share s of
a verbatim copy's score has less than one error per match on average, so it holds
at least s * n - 1 such pairs of an item of n words. Of all pairs of the item, ranked
by their frequency in the corpus, the commonest can therefore be left out: as many
as still force half of that number on every such alignment. No copy is lost by it.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from terralattice import session
from terralattice.llm import winnow
from terralattice.llm.common import LEAST, by_batch, order_id, text_hash

APART = 2  # words, at most, from the first of a pair to the second
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5  # of the score of a verbatim copy
MIN_WORDS = 6  # of an item are aligned at least, or all of a shorter one
FILTER_BITS = 1 << 22  # of the filter that tells which pairs are worth a look, whatever the benchmark

_TOKEN = re.compile(r"\w+")
_ASCII = bytes(c if chr(c).isalnum() or c == ord("_") else ord(" ") for c in range(128)) + bytes(range(128, 256))  # the same words where all is ASCII
_BLOCK = 1 << 16  # words that are hashed together
_FACTOR = np.uint64(0x9FB21C651E98DF25)  # odd, so that products keep all bits


def tokens(text: str | None) -> list[str]:
    """Words without case and punctuation."""
    low = (text or "").lower()
    return low.encode().translate(_ASCII).decode().split() if low.isascii() else _TOKEN.findall(low)


class _Codes(dict):
    """Hashes of words, kept as they come up; a new one is worked out."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


_CODES = _Codes()


def pair_keys(words: list[str], singles: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word pairs in a text and where they start; with `singles` of its words, too."""
    code = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
    parts = [winnow.mix(code[:-gap] * _FACTOR + code[gap:]) for gap in range(1, APART + 1) if gap < len(code)]
    if singles:
        parts.append(winnow.mix(~code))
    at = [np.arange(len(p)) for p in parts]
    return np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64), np.concatenate([np.zeros(0, np.int64), *at])


def _passing_pairs(texts: list[str | None], singles: bool, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, at, row: the pairs of each text, as pair_keys gives them, that pass the filter. Texts are hashed many at a time."""
    parts, words, sizes, first = [[np.zeros(0, np.int64)] * 3], [], [], 0
    for i, text in enumerate(texts):
        held = len(words)
        words += tokens(text)
        sizes.append(len(words) - held)
        if len(words) < _BLOCK and i + 1 < len(texts):
            continue
        code = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
        row = np.repeat(np.arange(first, i + 1), sizes)
        start = np.cumsum([0, *sizes[:-1]])
        for gap in range(0 if singles else 1, APART + 1):
            keys = winnow.mix(code[:len(code) - gap] * _FACTOR + code[gap:] if gap else ~code).view(np.int64)
            at = np.flatnonzero(_passing(keys, bits))
            at = at[row[at] == row[at + gap]]
            parts.append([keys[at], at - start[row[at] - first], row[at]])
        words, sizes, first = [], [], i + 1
    key, at, row = (np.concatenate(c) for c in zip(*parts))
    return key, at, row


def align(passage: list[str], item: list[str]) -> float:
    """Smith-Waterman score of the best local alignment, as a share of a verbatim copy's score."""
    return aligned(passage, item)[0]


def aligned(passage: list[str], item: list[str]) -> tuple[float, int]:
    """The score as above, and the most words that an alignment of that score has in common.

    One row of the table per item word; a run of gaps within a row is a running
    maximum of scores that slope by the gap. Scores are scaled, so that the number
    of common words fits below a step.
    """
    if not passage or not item:
        return 0.0, 0
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    words = np.array([number.get(w, -1) for w in passage], np.int64)
    scale = len(item) + 1
    gap = GAP * scale
    slope = np.arange(len(words) + 1) * gap
    row = np.zeros(len(words) + 1, np.int64)
    best = 0
    for w in item:
        new = np.zeros_like(row)
        step = np.where(words == number[w], MATCH * scale + 1, MISMATCH * scale)
        np.maximum(row[:-1] + step, row[1:] + gap, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new - slope) + slope
        best = max(best, int(row.max()))
    score, common = divmod(best, scale)
    return score / (MATCH * len(item)), common


def _places(keys: np.ndarray) -> np.ndarray:
    return keys & (FILTER_BITS - 1)


def _filter(keys: DataFrame) -> np.ndarray:
    """Marks the places that keys fall on; FILTER_BITS places, however many keys."""
    found = keys.select(F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("place")).distinct().toArrow()
    marks = np.zeros(FILTER_BITS, bool)
    marks[found["place"].to_numpy()] = True
    return np.packbits(marks, bitorder="little")


def _passing(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = _places(keys)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def _item_pairs(items: DataFrame) -> DataFrame:
    """nr, words, key: all pairs of the items of three words and more, the one of items of two, the word of items of one."""
    def make(columns):
        parts = [[np.zeros(0, np.int64)] * 3]
        for nr, text in zip(columns["nr"], columns["text"]):
            words = tokens(text)
            keys = pair_keys(words, len(words) == 1)[0]
            parts.append([np.full(len(keys), nr), np.full(len(keys), len(words)), keys])
        return {n: pa.array(np.concatenate(c)) for n, c in zip(("nr", "words", "key"), zip(*parts))}
    return by_batch(items.select("nr", "text"), "nr long, words long, key long", make)


def _frequencies(docs: DataFrame, pairs: DataFrame, singles: bool) -> DataFrame:
    """key, n: how often pairs of items, and others that fall on their places, come in the corpus."""
    bits = _filter(pairs)

    def make(columns):
        key, n = np.unique(_passing_pairs(columns["text"], singles, bits)[0], return_counts=True)
        return {"key": pa.array(key), "n": pa.array(n)}
    return by_batch(docs.select("text"), "key long, n long", make).groupBy("key").agg(F.sum("n").alias("n"))


def rare_seeds(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """key, nr, times, needed: the rarest pairs of each item, how often it has them, and how many a passage must have.

    Pairs that the corpus lacks come first and cost nothing; of the others the
    commonest are left out, so many that a copy still has `needed` of the rest.
    """
    pairs = session.materialize(_item_pairs(items), "item-pairs")
    singles = not pairs.where("words = 1").isEmpty()
    counted = _frequencies(docs, pairs, singles).join(pairs.select("key").distinct(), "key")
    ranked = pairs.join(session.materialize(counted, "pair-counts"), "key", "left").groupBy("nr", "words").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key"))).alias("p"))  # of one item
    forced = F.greatest(F.lit(1), F.ceil(F.lit(float(min_score)) * F.col("words")) - 1).cast("int")
    needed = F.greatest(F.lit(1), F.floor(forced / 2)).cast("int")
    chosen = ranked.select("nr", needed.alias("needed"), F.explode(F.slice("p", F.lit(1), F.greatest(F.size("p") - forced + needed, F.lit(1)))).alias("s"))
    return chosen.where("s.n > 0").groupBy("s.key", "nr", "needed").agg(F.count("*").alias("times"))


def matches(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, item_id, score for each document and item whose alignment reaches `min_score`.

    The corpus is read once for the frequencies of the items' pairs and once for the
    places of the seeds; seeds, items and passages are tables and meet in joins. A
    passage is a stretch of a document around seeds of one item, wide enough for any
    alignment of the score; it is aligned if it has enough words in common with the
    item. The result is that of aligning every document with every item in whole.

    Scores compare words without case and punctuation. MIN_WORDS words of an item,
    or all of a shorter one, are aligned besides; items of one or two words match
    where these stand in a row. Null and empty texts match nothing. Rows that
    repeat an id are taken as one document or item with the best of their scores. A
    null doc_id or item_id is kept as null. Other columns are not read.
    """
    return _scores(docs, items, min_score).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def _scores(docs: DataFrame, items: DataFrame, min_score: float) -> DataFrame:
    """doc_id, node, item_id, score for rows that reach `min_score`; node is the hash of the text."""
    docs = docs.select(order_id().alias("id"), text_hash().alias("node"), F.col("text").cast("string").alias("text"))
    held = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    held = session.materialize(held.withColumn("nr", F.xxhash64("item_id", "text", F.lit(7))), "items")
    seeds = session.materialize(rare_seeds(docs, held, min_score), "seeds")
    sized = by_batch(held.select("nr", "text"), "nr long, words long", lambda c: {"nr": pa.array(c["nr"], pa.int64()), "words": [len(tokens(t)) for t in c["text"]]})
    found = session.materialize(_near(docs, seeds, sized, min_score), "passages")

    def make(columns):
        kept = []
        for id_, node, item_id, passage, text in zip(*(columns[n] for n in ("id", "node", "item_id", "passage", "text"))):
            words, item = passage.split(" "), tokens(text)
            if (Counter(item) & Counter(words)).total() < min_score * len(item):
                continue  # no alignment scores more than all words in common
            score, common = aligned(words, item)
            if score >= (min_score if len(item) > 2 else 1.0) and common >= min(MIN_WORDS, len(item)):
                kept.append((None if id_ == LEAST else id_, node, item_id, score))
        return {n: pa.array([k[i] for k in kept], t) for i, (n, t) in enumerate((("doc_id", pa.int64()), ("node", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())))}
    met = found.join(held, "nr").select("id", "node", "item_id", "passage", "text")
    return by_batch(met, "doc_id long, node long, item_id long, score double", make)


def _near(docs: DataFrame, seeds: DataFrame, sized: DataFrame, min_score: float) -> DataFrame:
    """id, node, nr, passage: stretches of documents with enough seeds of an item."""
    bits, singles = _filter(seeds), not sized.where("words = 1").isEmpty()

    def hits(columns):
        key, at, row = _passing_pairs(columns["text"], singles, bits)
        return {"id": pa.array(np.array(columns["id"], np.int64)[row]), "node": pa.array(np.array(columns["node"], np.int64)[row]), "key": pa.array(key), "at": pa.array(at)}
    found = by_batch(docs, "id long, node long, key long, at long", hits).join(seeds, "key")
    # Places of a document that hold seeds of an item: at most as many as it has words and the item pairs.
    hit = F.array_sort(F.collect_list(F.struct("at", "key", "times")))
    together = found.groupBy("id", "node", "nr", "needed").agg(hit.alias("hits"))
    most = F.aggregate(F.array_distinct(F.transform("hits", lambda h: F.struct(h["key"], h["times"]))), F.lit(0).cast("long"), lambda n, h: n + h["times"])
    together = session.materialize(together.where((F.size("hits") >= F.col("needed")) & (most >= F.col("needed"))).join(sized, "nr"), "seed-places")
    wanted = session.materialize(together.groupBy("id", "node").agg(F.collect_list(F.struct(
        "nr", "needed", "words", F.col("hits.at").alias("at"), F.col("hits.key").alias("key"), F.col("hits.times").alias("times"))).alias("asked")), "asked")  # sent to the texts while small

    def cut(columns):
        rows = []
        for id_, node, text, asked in zip(columns["id"], columns["node"], columns["text"], columns["asked"]):
            words = tokens(text)
            for item in asked:
                reach = math.ceil((3 - 2 * min_score) * item["words"])  # no alignment of the score spans more words
                for first, last in _stretches(item["at"], item["key"], item["times"], reach, item["needed"]):
                    rows.append((id_, node, item["nr"], " ".join(words[max(0, first - reach):last + APART + 1 + reach])))
        return {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("id", pa.int64()), ("node", pa.int64()), ("nr", pa.int64()), ("passage", pa.string())))}
    return by_batch(docs.join(wanted, ["id", "node"]), "id long, node long, nr long, passage string", cut)


def _stretches(at: list[int], keys: list[int], times: list[int], reach: int, needed: int) -> list[tuple[int, int]]:
    """First and last place of stretches that hold `needed` seeds within `reach` words, each key as often as the item has it.

    Places ascend; stretches closer than twice the reach are one.
    """
    out: list[list[int]] = []
    held, count, first = Counter(), 0, 0
    for i, place in enumerate(at):
        held[keys[i]] += 1
        count += held[keys[i]] <= times[i]
        while place - at[first] > reach:
            count -= held[keys[first]] <= times[first]
            held[keys[first]] -= 1
            first += 1
        if count >= needed:
            if out and at[first] - out[-1][1] <= 2 * reach:
                out[-1][1] = place
            else:
                out.append([at[first], place])
    return [(a, z) for a, z in out]


def clean(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of `docs` whose own text matches no item, with all their columns; ids may be missing or repeated."""
    found = session.materialize(_scores(docs, items, min_score).select(order_id().alias("id"), "node").distinct(), "leaks")
    marked = docs.select(order_id().alias("id"), text_hash().alias("node"), F.struct(*docs.columns).alias("row"))
    return marked.join(found, ["id", "node"], "left_anti").select("row.*")
