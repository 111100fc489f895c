"""Removal of repeated bytes, words and lines against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terralattice.llm import line_dedup, substring_dedup, suffix_dedup, winnow

LEAST = -(1 << 63)


def number(doc_id):
    return LEAST if doc_id is None else doc_id


def brute(rows, sequence, window):
    """Per row: (doc_id, symbols, marks of those covered by a window of a smaller id)."""
    first = {}
    parts = [(number(d), sequence((t or "").encode())) for d, t in rows]
    for d, s in parts:
        for i in range(len(s) - window + 1):
            key = s[i:i + window] if isinstance(s, bytes) else tuple(s[i:i + window])
            first[key] = min(first.get(key, d), d)
    for d, s in parts:
        gone = np.zeros(len(s), bool)
        for i in range(len(s) - window + 1):
            if first[s[i:i + window] if isinstance(s, bytes) else tuple(s[i:i + window])] < d:
                gone[i:i + window] = True
        yield d, s, gone


def tangled(n=120, seed=5):
    """Texts stitched from a few passages, with single edits and copies inside a text."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "so", "ti", "vu", "", "xe")]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    texts = []
    for _ in range(n):
        words = " ".join(rng.choice(passages) for _ in range(rng.randint(1, 4))).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    return list(enumerate(texts)) + [(None, texts[0]), (5, texts[5]), (n, passages[0]), (n + 1, texts[3]), (n + 2, None), (n + 3, ""), (n + 4, "short")]


def bytes_wanted(rows, window):
    out = []
    for d, s, gone in brute(rows, lambda b: b, window):
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((d, len(s), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(s, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def bytes_got(df, **options):
    return sorted((number(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, **options).collect())


@pytest.mark.parametrize("crowd, chunk", [(20_000, 20_000), (3, 20_000), (20_000, 4), (3, 4)])
def test_bytes(docs_of, monkeypatch, crowd, chunk):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rows = tangled()
    assert bytes_got(docs_of(rows).repartition(7)) == bytes_wanted(rows, 50)


def test_bytes_of_a_line_repeated_very_often(docs_of, monkeypatch):
    """Copies of a stretch in one document are held once, whatever their number, and all go where another has it first."""
    line = "this very line of the document comes again and again, with nothing in between\n"
    rows = [(1, line * 3 + "end"), (2, "start " + line * 3000), (3, line * 2000 + "another end of it"), (2, "other text " + line * 5)]
    sorted_at_once = []
    array = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda pieces, window: sorted_at_once.append(len(pieces)) or array(pieces, window))
    assert bytes_got(docs_of(rows)) == bytes_wanted(rows, 50)
    held = [[1, 1], [1, 2], [[(7, 0)], [(8, 0), (8, 100), (9, 5)]], [line.encode() * 2, b"x" + line.encode()]]
    h, at = suffix_dedup._repeats(held[1], held[2], held[3], 50)
    found = collections.defaultdict(set)
    for text, place in zip(h.tolist(), at.tolist()):
        found[text] |= set(range(place & 0xFFFFFFFF, (place & 0xFFFFFFFF) + (place >> 32)))
    assert found == {8: set(range(1, 1 + len(line))) | set(range(101, 101 + len(line))), 9: set(range(6, 6 + len(line)))}


def test_bytes_of_odd_documents(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert bytes_got(odd) == bytes_wanted(rows, 50)


def test_cut(docs_of):
    rows = tangled(40)
    df = docs_of(rows)
    got = {number(r.doc_id): bytes(r.kept) for r in suffix_dedup.cut(df, suffix_dedup.remove_repeats(df)).collect()}
    for d, s, gone in brute(rows, lambda b: b, 50):
        assert got[d] == np.frombuffer(s, np.uint8)[~gone].tobytes()


def test_intervals_are_the_maximal_repeats():
    """Every string that occurs twice, and cannot grow to either side in all its places, comes once."""
    rng = random.Random(11)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.randint(6, 30))).encode() for _ in range(8)]
    piece, offset, common, before = suffix_dedup.suffix_array(pieces, 4)
    got = collections.Counter()
    for left, right, depth, small, diverse in suffix_dedup.intervals(common.tolist(), before.tolist(), piece.tolist(), 4):
        places = frozenset(zip(piece[left:right + 1].tolist(), offset[left:right + 1].tolist()))
        assert small == min(p for p, _ in places)
        if diverse:
            got[places, depth] += 1
    wanted = set()
    strings = {p[i:j] for p in pieces for i in range(len(p)) for j in range(i + 4, len(p) + 1)}
    for s in strings:
        at = [(k, i) for k, p in enumerate(pieces) for i in range(len(p) - len(s) + 1) if p[i:i + len(s)] == s]
        lefts = {pieces[k][i - 1] if i else -1 for k, i in at}
        rights = {pieces[k][i + len(s)] if i + len(s) < len(pieces[k]) else -k - 1 for k, i in at}
        if len(at) > 1 and (len(lefts) > 1 or -1 in lefts) and (len(rights) > 1 or min(rights) < 0):
            wanted.add((frozenset(at), len(s)))
    assert set(got) == wanted and set(got.values()) == {1}


def words_got(df, **options):
    return sorted((number(r.doc_id), r.n_words, r.n_removed, bytes(r.kept)) for r in substring_dedup.remove_repeats(df, **options).collect())


def words_wanted(rows, window):
    return sorted((d, len(s), int(gone.sum()), b" ".join(w for w, g in zip(s, gone) if not g)) for d, s, gone in brute(rows, bytes.split, window))


def test_words(docs_of, odd):
    rows = tangled()
    assert words_got(docs_of(rows).repartition(7)) == words_wanted(rows, 13)
    assert words_got(odd) == words_wanted([(r.doc_id, r.text) for r in odd.collect()], 13)


def test_words_of_many_texts_under_one_id(docs_of):
    """Texts that share an id keep their own words, short ones among them; 24 bits of a hash would mix some up."""
    rows = [(2, t) for _, t in tangled(300, seed=3)] + [(2, f"short {i}") for i in range(3000)] + [(None, f"none {i}") for i in range(3000)] + tangled(40)
    assert words_got(docs_of(rows).repartition(5)) == words_wanted(rows, 13)


def test_words_of_other_windows(docs_of):
    rows = tangled(60, seed=9)
    assert words_got(docs_of(rows).repartition(3), window=7, seed_words=3) == words_wanted(rows, 7)


def test_nothing_to_remove(docs_of):
    none = docs_of([])
    assert substring_dedup.remove_repeats(none).isEmpty() and suffix_dedup.remove_repeats(none).isEmpty() and line_dedup.remove_repeats(none).isEmpty()


def test_anchors_are_chosen_by_content():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 9, 500).astype(np.uint64) << np.uint64(32)
    at, first, last = winnow.anchors(grams, 10)
    chosen = np.repeat(at, last - first + 1)
    assert [int(np.argmin(grams[i:i + 10])) + i for i in range(491)] == chosen.tolist()


def lines_wanted(rows, least):
    """(doc_id, lines, removed, longest, kept) of the reading order by doc_id."""
    docs = []
    for d, t in rows:
        units = []
        for line in (t or "").split("\n"):
            if not units or line.encode().split():
                units.append([line])
            else:
                units[-1].append(line)
        worded = [bool(u[0].encode().split()) for u in units]
        docs.append((number(d), units, worded))
    places = collections.defaultdict(list)
    sizes = [least] + [1 << k for k in range(1, 12) if 1 << k > least]
    for k, (d, units, worded) in enumerate(docs):
        for n in sizes:
            for i in range(len(units) - n + 1):
                if all(worded[i:i + n]):
                    places[n, tuple(u[0] for u in units[i:i + n])].append((d, i, k))
    gone, longest = [set() for _ in docs], [0] * len(docs)
    for (n, _), at in places.items():
        start = min(at)[:2]
        for d, i, k in at:
            if (d, i) > start:
                gone[k] |= set(range(i, i + n))
                longest[k] = max(longest[k], n)
    return sorted((d, sum(w), len(gone[k]), longest[k], "\n".join("\n".join(u) for i, u in enumerate(units) if i not in gone[k]))
                  for k, (d, units, w) in enumerate(docs))


@pytest.mark.parametrize("least", [2, 3])
def test_lines(docs_of, least):
    rng = random.Random(2)
    pool = [f"line {i}" for i in range(25)] + ["", "  ", "\t"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(60, texts[0]), (61, "\n".join(texts[:6])), (None, texts[1]), (62, None), (63, ""), (64, "\n\n")]
    got = sorted((number(r.doc_id), r.n_lines, r.n_removed, r.longest, r.kept) for r in line_dedup.remove_repeats(docs_of(rows), least).collect())
    assert got == lines_wanted(rows, least)


def test_lines_of_odd_documents(odd):
    got = {number(r.doc_id): (r.n_removed, r.kept) for r in line_dedup.remove_repeats(odd).collect()}
    assert got[1] == (0, "") and got[2] == (0, "") and got[3] == (0, " \t\n")
    assert got[4] == (0, "One two three, four five six.\nSeven eight.")  # rows repeated whole are no copies
    assert line_dedup.remove_repeats(odd).count() == odd.count()


def test_lines_stay_on_the_jvm(documents):
    plan = line_dedup.remove_repeats(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
