"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find the word windows that occurred
before in a text; the share of its word characters that such copies cover, and
the share inside copies of lines, decide whether the text is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terralattice.llm.common import by_batch

# Largest share of word characters inside n-grams that occurred before.
# Published limits for this family of rules (Rae et al. 2021, table A1).
LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.30  # largest share of word characters inside lines that occurred before
BASE_WINDOW = 8
MIN_WORDS = 20
BASE_PERCENT = 30

_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, so that products keep all bits
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_line_share double, " + ", ".join(f"dup_{n}gram_share double" for n in LIMITS)
          + ", base_failed boolean, kept boolean")


def repeated(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks the values that occur twice or more, and of them those that occurred before."""
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    marks, later = np.zeros((2, len(windows)), bool)
    later[order[1:]] = same
    marks[order[:-1]] = same
    return marks | later, later


def covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Marks the words inside any n-word window that starts at one of `starts`."""
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def repeat_coverage(words: list[bytes], sizes: np.ndarray, lengths) -> dict[int, tuple[int, int]]:
    """For each window length: words inside windows found twice or more, and characters inside later copies of windows.

    The hash of a window grows by one word from that of the next shorter length.
    A repeated window holds two shorter repeated ones, so each length looks only
    at the starts that the length before it left.
    """
    out = {n: (0, 0) for n in lengths}
    total, shortest, longest = len(words), min(lengths), max(lengths)
    if total <= shortest:
        return out
    code = np.fromiter(map(hash, words), np.int64, total).view(np.uint64)
    rolling = code
    starts = np.arange(total)
    for n in range(2, longest + 1):
        starts = starts[starts + n <= total]
        rolling = rolling[:total - n + 1] * _FACTOR + code[n - 1:]
        if n < shortest:
            continue
        twice, later = repeated(rolling[starts])
        if not twice.any():
            break
        if n in out:
            out[n] = int(covered(starts[twice], n, total).sum()), int(sizes[covered(starts[later], n, total)].sum())
        starts = starts[twice]
    return out


def line_repeats(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the word characters in them."""
    seen: set[bytes] = set()
    again = chars = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            if line in seen:
                again += 1
                chars += len(b"".join(line.split()).decode("utf-8", "replace"))
            seen.add(line)
    return again, chars


def measure(text: bytes | None) -> dict[str, object]:
    text = text or b""
    words = text.split()  # splits bytes at space and 0x09-0x0D
    raw = np.frombuffer(text, np.uint8)
    chars = len(raw) - int(_SPACE[raw].sum()) - int(((raw & 0xC0) == 0x80).sum())
    sizes = np.fromiter((len(w) if w.isascii() else len(w.decode("utf-8", "replace")) for w in words), np.int64, len(words))
    coverage = repeat_coverage(words, sizes, sorted({BASE_WINDOW, *LIMITS}))
    again, line_chars = line_repeats(text)
    out = {"n_words": len(words), "word_chars": chars, "n_symbols": int(_SYMBOL[raw].sum()),
           "n_dup_lines": again, "n_repeat_words": coverage[BASE_WINDOW][0],
           "dup_line_share": line_chars / chars if chars else 0.0}
    for n in LIMITS:
        out[f"dup_{n}gram_share"] = coverage[n][1] / chars if chars else 0.0
    out["base_failed"] = len(words) < MIN_WORDS or 100 * out["n_repeat_words"] > BASE_PERCENT * len(words)
    out["kept"] = not out["base_failed"] and out["dup_line_share"] <= LINE_LIMIT and all(
        out[f"dup_{n}gram_share"] <= limit for n, limit in LIMITS.items())
    return out


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of measures and verdict per row of `docs`, with its doc_id.

    Each text is measured alone and whole, so repeated rows give repeated results
    and no row is moved. A null or empty text has no words and fails the base
    rule. Other columns of `docs` are not read, whatever their names.
    """
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def make(columns):
        rows = [measure(t) for t in columns["text"]]
        return {"doc_id": pa.array(columns["doc_id"], pa.int64())} | {n: [r[n] for r in rows] for n in names[1:]}
    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")),
                    SCHEMA, make)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` whose text passes, unchanged, with all their columns."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([measure(t)["kept"] for t in texts], pa.bool_()))
    return docs.mapInArrow(each, docs.schema)
