"""Secrets in texts: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two chains of the second order, of random strings and of ordinary identifiers, are
trained from labelled samples of the corpus itself. A run of identifier characters
is taken for a secret where its likelihood ratio outweighs the odds against one.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terralattice import session
from terralattice.llm.common import by_batch

# Characters of candidate strings; a run of them is one candidate. Symbol 0 stands for all others.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
LEAST_CHARS = 12  # of a candidate
ODDS = 1_000_000  # to one that a candidate is no secret
STRENGTH = 16.0  # draws of the next lower order that count beside what was seen after two characters
UNIT = 1000  # ratios are whole numbers of 1/UNIT nats, so that sums do not depend on their order
DRAWN = 32  # characters of each random string drawn per row

KINDS = ("assign", "access", "hex", "model")  # in this order where spans start together

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST_CHARS},}}")

_SIZE = len(ALPHABET) + 1
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[list(ALPHABET.encode())] = np.arange(1, _SIZE)
_CHUNK = 1 << 20

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str, runs: list[tuple[int, str]]) -> list[Span]:
    """Matches of the fixed patterns, in code points; `runs` are the text's candidates.

    Hexadecimal and access keys consist of candidate characters, so they are looked
    for in candidates only. Any assignment holds one of the keywords.
    """
    found = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    for start, run in runs:
        if "AKIA" in run:
            found += [(start + m.start(), 1, start + m.end()) for m in _ACCESS.finditer(run)]
        if len(run) >= 16:
            found += [(start + m.start(), 2, start + m.end()) for m in _HEX.finditer(run)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, str]]:
    return [(m.start(), m[0]) for m in _RUN.finditer(text)]


def drawn(text: str) -> list[str]:
    """Random strings in the usual alphabets, fixed by the text."""
    bits = hashlib.sha512(text.encode()).digest()
    return [code(bits).decode()[:DRAWN] for code in (base64.b64encode, base64.b32encode, base64.b16encode)] + [bits.hex()[-DRAWN:]]


def samples(text: str | None) -> tuple[list[str], list[str]]:
    """Labelled strings of a text: random ones (matches of the fixed patterns, and drawn ones) and ordinary ones (all else)."""
    text = text or ""
    random, ordinary, at = drawn(text), [], 0
    for start, kind, end in base_spans(text, candidates(text)):
        if kind == 0:
            start = _ASSIGN.match(text, start).start(2)
        if start >= at:
            random.append(text[start:end])
            ordinary.append(text[at:start])
        at = max(at, end)
    return random, [*ordinary, text[at:]]


def _codes(symbols: np.ndarray) -> np.ndarray:
    """Numbers of all three symbols in a row, last one lowest."""
    return (symbols[:-2] * _SIZE + symbols[1:-1]) * _SIZE + symbols[2:]


def _raw(strings: list[str]) -> np.ndarray:
    """Bytes of strings, two that are no candidate's before each."""
    return np.frombuffer(("\n\n" + "\n\n".join(strings)).encode(), np.uint8)


def transition_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """random, code, n: how often three symbols follow each other in the samples of either label.

    Each task adds up its own counts, so a row per task and code is shuffled at most.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, gathered, size = np.zeros((2, _SIZE ** 3), np.int64), ([], []), 0

        def add() -> None:
            for label, strings in enumerate(gathered):
                raw = _raw(strings)
                for first in range(0, len(raw) - 2, _CHUNK):
                    counts[label] += np.bincount(_codes(_SYMBOL[raw[first:first + _CHUNK + 2]]), minlength=_SIZE ** 3)
                strings.clear()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                random, ordinary = samples(value)
                gathered[0].extend(ordinary)
                gathered[1].extend(random)
                size += len(value or "")
                if size > _CHUNK:
                    add()
                    size = 0
        add()
        for label in (0, 1):
            code = np.flatnonzero(counts[label])
            code = code[code % _SIZE > 0]
            yield pa.RecordBatch.from_pydict({"random": pa.array(np.full(len(code), bool(label))), "code": pa.array(code.astype(np.int32)),
                                              "n": pa.array(counts[label][code])})
    made = docs.select(F.col(text).cast("string")).mapInArrow(each, "random boolean, code int, n long")
    return made.groupBy("random", "code").agg(F.sum("n").alias("n"))


def _log_chance(counts: np.ndarray) -> np.ndarray:
    """Log chance of a symbol after two others; chances of a lower order stand in for what was rarely seen."""
    counts = counts.reshape(_SIZE, _SIZE, _SIZE)[:, :, 1:].astype(np.float64)
    lower = np.full(_SIZE - 1, 1 / (_SIZE - 1))
    for seen in (counts.sum((0, 1)), counts.sum(0), counts):
        lower = (seen + STRENGTH * lower) / (seen.sum(-1, keepdims=True) + STRENGTH)
    return np.log(lower)


def train(counts: DataFrame) -> np.ndarray:
    """Per code the log-likelihood ratio of random to ordinary; the table's size is fixed by ALPHABET."""
    held = np.zeros((2, _SIZE ** 3), np.int64)
    found = counts.select(F.col("random").cast("int").alias("label"), "code", "n").toArrow()  # at most 2 * _SIZE ** 3 rows
    held[found["label"].to_numpy(), found["code"].to_numpy()] = found["n"].to_numpy()
    ratio = np.zeros((_SIZE, _SIZE, _SIZE), np.int32)  # other characters say nothing
    ratio[:, :, 1:] = np.floor(UNIT * (_log_chance(held[1]) - _log_chance(held[0])))
    return ratio.ravel()


def ratios(strings: list[str], model: np.ndarray) -> np.ndarray:
    """The log-likelihood ratio of each string, in 1/UNIT nats."""
    if not strings:
        return np.zeros(0, np.int64)
    symbols = _SYMBOL[_raw(strings)]
    sums = np.zeros(len(symbols) - 1, np.int64)
    np.cumsum(model[_codes(symbols)], out=sums[1:])
    ends = np.cumsum([len(s.encode()) + 2 for s in strings]) - 2
    return np.diff(sums[ends], prepend=0)


def spans(text: str | None, model: np.ndarray, odds: float = ODDS) -> list[Span]:
    """Base spans, and candidates beside them whose ratio outweighs the odds."""
    text = text or ""
    runs = candidates(text)
    base = base_spans(text, runs)
    likely = np.flatnonzero(ratios([run for _, run in runs], model) > UNIT * math.log(odds)).tolist()
    taken: list[list[int]] = []  # disjoint stretches of the base spans
    for start, _, end in base:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    found = list(base)
    for i in likely:
        start, end = runs[i][0], runs[i][0] + len(runs[i][1])
        before = bisect.bisect_left(taken, [end]) - 1  # the last stretch that starts before the candidate's end
        if before < 0 or taken[before][1] <= start:
            found.append((start, 3, end))
    return sorted(found)


def _written(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(docs: DataFrame, model: np.ndarray | None = None, odds: float = ODDS, text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_model, base, spans per row of `docs`.

    `base` lists the spans of the fixed patterns and `spans` those and the model's,
    as kind:start:end in code points, by start and then kind. A candidate that
    meets a base span is left to it. Without a `model` one is trained on `docs`.

    Null and empty texts have no spans; a null doc_id stays null; repeated rows give
    repeated results, and weigh in the training as often as they come. Other columns
    are not read. Texts are scanned alone and whole, so no row is moved.
    """
    if model is None:
        model = train(transition_counts(docs, text))

    def make(columns):
        found = [spans(t, model, odds) for t in columns["text"]]
        counts = [[sum(kind == k for _, kind, _ in f) for f in found] for k in range(4)]
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "n_assign": counts[0], "n_access": counts[1], "n_hex": counts[2],
                "n_model": counts[3], "base": [_written([s for s in f if s[1] < 3]) for f in found], "spans": list(map(_written, found))}
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_batch(held, "doc_id long, n_assign long, n_access long, n_hex long, n_model long, base string, spans string", make)
