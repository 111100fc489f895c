"""Near copies of the pipeline against brute force over all pairs."""

import random

import pytest

import corpus_pipeline
from terralattice import session
from terralattice.llm import decontamination, near_copies

SMALL = "/root/testdata/sf0.001"


def brute_set(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute_groups(texts):
    """For each text the first of its group at a similarity of 0.8 or more."""
    sets, root = [brute_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and (not sets[i] | sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def edited(rng, words, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("more", [4, 1000])
def test_near_dedup_finds_what_brute_force_finds(spark, docs_of, monkeypatch, more):
    """Families around 0.8, a crowded one of copies of copies among them."""
    monkeypatch.setattr(near_copies, "MORE_PIVOTS", more)
    rng, texts = random.Random(4), ["", None, " \n", "two words", "Two  words"]
    for family in range(30):
        words = [f"f{family}w{k}" for k in range(rng.randint(40, 200))]
        texts += [" ".join(edited(rng, words, share)) for share in (0, 0.01, 0.02, 0.03, 0.04)]
    words = [f"hot{k}" for k in range(150)]
    for _ in range(60):
        texts.append(" ".join(words := edited(rng, words, 0.01)))
    root = brute_groups(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs_of(rows), SMALL).collect()}
    assert kept == {i for i, r in enumerate(root) if i == r}


def test_near_dedup_of_the_given_documents(spark, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    root = brute_groups([t for _, t in rows])
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, documents, SMALL).collect()}
    assert kept == {d for i, (d, _) in enumerate(rows) if root[i] == i}


def test_rows_with_missing_and_repeated_ids(spark, docs_of):
    """Rows are chosen and left out by their own group and text, whatever shares their id."""
    a, b, t, u = (" ".join(f"{x}{k}" for k in range(100)) for x in "abtu")
    copy, other = t.replace("t99", "end"), t.replace("t98", "end")
    df = docs_of([(None, a), (None, b), (None, b), (2, t), (5, copy), (5, u), (7, b + " more"), (5, u + " z"), (5, u + " y")])
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, df, SMALL).collect()), key=str)
    assert got == sorted([(None, a), (None, b), (2, t), (5, u)], key=str)
    items = spark.createDataFrame([(1, other)], "item_id long, text string")
    left = decontamination.clean(docs_of([(None, t), (None, a), (5, copy), (5, u)]), items)
    assert sorted((r.text for r in left.collect())) == [a, u]


def test_shuffle_files_go_with_each_step_of_the_groups(spark, docs_of, monkeypatch):
    """Groups are those of brute force; the caller's setting is as before."""
    rng, texts = random.Random(9), ["", None]
    for family in range(2):
        words = [f"f{family}w{k}" for k in range(60)]
        texts += [" ".join(edited(rng, words, share)) for share in (0, 0, 0.01, 0.02, 0.02, 0.05, 0.3)]
    held, before, write = [], spark.conf.get(session._CLEANUP), session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, label: held.append(spark.conf.get(session._CLEANUP)) or write(df, label))
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    found = near_copies.groups(docs)
    assert len(held) > 10 and set(held) == {"true"} and spark.conf.get(session._CLEANUP) == before
    root = {r.text or "": r.root for r in docs.join(found, near_copies.text_hash() == found["node"]).collect()}
    first = brute_groups(texts)
    for i, a in enumerate(texts):
        assert [root[a or ""] == root[b or ""] for b in texts[:i]] == [first[i] == r for r in first[:i]]
