"""Sharding, mixing, token totals, the pipeline and the registered queries."""

import importlib.util
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from check_queries import compare, connect
from test_near_copies import brute_groups
from terralattice import session
from terralattice.llm import decontamination, mixing, quality, sharding, token_counts
from terralattice.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def check_shards(rows, n, size_of):
    rows = sorted(rows, key=lambda r: (r.shard, r.slot))
    total = sum(map(size_of, rows))
    for k in range(n):
        part = [r for r in rows if r.shard == k]
        assert [r.slot for r in part] == list(range(len(part)))
        assert abs(sum(map(size_of, part)) - total / n) <= max(map(size_of, rows))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)


def test_shards(spark, documents):
    rows = QUERIES["op1_sharding"](spark, SMALL).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts) and {r.law for r in rows} == {"bytes"}
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r.grown_shard is None for r in rows)
    check_shards(rows, 8, lambda r: r.size)


def test_shards_are_those_of_brute_force(spark, documents):
    """Shard and slot by running bytes in order of id, checksum and size, recomputed one row at a time."""
    rows = sorted((r.doc_id, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 1) for r in documents.collect())
    total, before, want, slots = sum(r[2] for r in rows), 0, {}, [0] * 8
    for doc_id, crc, size in rows:
        shard = (2 * before + size) * 8 // (2 * total)
        want[doc_id], slots[shard], before = (size, crc, shard, slots[shard]), slots[shard] + 1, before + size
    got = {r.doc_id: (r["size"], r.text_crc32, r.shard, r.slot) for r in QUERIES["op1_sharding"](spark, SMALL).collect()}
    assert got == want


def test_shards_of_odd_documents(odd, docs_of):
    out = sharding.contiguous_shards(odd, 3, sharding.text_bytes(), ["doc_id"])
    assert set(out.columns) == set(odd.columns)  # shard and slot are replaced
    rows = out.collect()
    assert len(rows) == odd.count()
    check_shards(rows, 3, lambda r: len((r.text or "").encode()) + 1)
    assert sharding.contiguous_shards(docs_of([]), 3, sharding.text_bytes(), ["doc_id"]).isEmpty()


def test_shards_of_one_id(docs_of):
    rows = sharding.contiguous_shards(docs_of([(None, "x" * 9)] * 400), 8, sharding.text_bytes(), ["doc_id"]).collect()
    check_shards(rows, 8, lambda r: 10)


def water_fill(sizes, weights, most):
    """Shares by bisection on the level."""
    low, high = 0.0, 1e12
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(level * w, most * s) for s, w in zip(sizes, weights)) < sum(sizes):
            low = level
        else:
            high = level
    return [min(low * w, most * s) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[100, 5, 7, 900, 1, 0], [10, 10, 10], [1, 1000], [0, 0], [7]])
def test_targets(spark, sizes):
    weights = [i % 3 + 1 for i in range(len(sizes))]
    df = spark.createDataFrame([(f"s{i}", s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight long")
    got = [r.target for r in mixing.targets(df).orderBy("source").collect()]
    assert got == pytest.approx(water_fill(sizes, weights, 3), rel=1e-6, abs=1e-6)


def test_mix(spark, documents, odd, docs_of):
    for df in (documents, odd):
        rows = mixing.mix(df).collect()
        assert len(rows) == df.count() and sorted(rows, key=str) == sorted(mixing.mix(df).collect(), key=str)
        by_source = {}
        for r in rows:
            assert r.taken == r.size * r.copies <= 3 * r.size
            by_source.setdefault(r.source, []).append(r)
        for part in by_source.values():
            assert sum(r.size for r in part) == part[0].source_size
            assert abs(sum(r.taken for r in part) - part[0].target) <= max(r.size for r in part) / 2 + 1e-6
    assert mixing.mix(docs_of([])).isEmpty()
    plan = mixing.mix(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


TOKENIZER = "byte_bpe_50k.tiktoken"


def counted(spark, path):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in token_counts.totals(spark, path).collect()}


def test_token_totals(spark, docs_of):
    def change(doc, tokens, source="a", deleted=False):
        return doc, source, "en", "t", tokens, deleted
    def frame(*rows):
        return spark.createDataFrame(rows, "doc_id long, source string, lang string, tokenizer string, tokens long, deleted boolean")
    path = session.scratch_path(spark, "test-totals")
    assert counted(spark, path) == {}
    assert token_counts.apply(path, 1, frame(change(1, 10), change(2, 5), change(2, 5), change(3, 7, None), change(None, 2)))
    assert counted(spark, path) == {("a", "en", "t"): (3, 17), (None, "en", "t"): (1, 7)}
    second = frame(change(1, 12), change(2, 0, None, True), change(9, 0, None, True), change(3, 7, "b"))
    assert token_counts.apply(path, 2, second)
    assert counted(spark, path) == {("a", "en", "t"): (2, 14), ("b", "en", "t"): (1, 7)}
    assert not token_counts.apply(path, 2, second) and counted(spark, path) == {("a", "en", "t"): (2, 14), ("b", "en", "t"): (1, 7)}
    # A batch that stopped between its two folders is done again in whole.
    frame(change(1, 99)).selectExpr("doc_id AS doc", "tokenizer", "source", "lang", "1L AS docs", "tokens").write.parquet(f"{path}/deltas/batch=3")
    assert counted(spark, path) == {("a", "en", "t"): (2, 14), ("b", "en", "t"): (1, 7)}
    assert token_counts.apply(path, 3, frame(change(1, 0, None, True))) and counted(spark, path) == {("a", "en", "t"): (1, 2), ("b", "en", "t"): (1, 7)}
    assert token_counts.apply(path, 4, frame()) and counted(spark, path) == {("a", "en", "t"): (1, 2), ("b", "en", "t"): (1, 7)}


def test_token_query(spark, documents):
    import base64

    import tiktoken
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    want = {}
    for turn, name in enumerate((TOKENIZER, "byte_bpe_multi_50k.tiktoken")):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"/opt/tokenizers/{name}", "rb"))}
        encoding = tiktoken.Encoding("own", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for r in documents.collect():
            label = labels.get(r.doc_id)
            if label and label.toxic == 1:
                continue
            text = r.text or ""
            if turn == 0 and label and label.quality == 0:
                text = "".join(c for c in text if c not in "#*$%&|<>")
            docs, tokens = want.get((r.source, r.lang, name), (0, 0))
            want[r.source, r.lang, name] = docs + 1, tokens + len(encoding.encode_ordinary(text))
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in QUERIES["op7_token_counts"](spark, SMALL).collect()}
    assert got == want


def test_token_counts_of_odd_documents(odd):
    rows = token_counts.count(odd, TOKENIZER, "/opt/tokenizers").collect()
    assert len(rows) == odd.count() and {r.tokens for r in rows if r.doc_id in (1, 2)} == {0}


def test_pipeline(spark, documents):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = {r.doc_id: r for r in documents.collect()}
    stay = {d: r for d, r in rows.items() if quality.measure((r.text or "").encode())["kept"]}
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, documents, SMALL).collect()} == set(stay)
    ordered = sorted(stay)
    root = brute_groups([stay[d].text for d in ordered])
    stay = {d: stay[d] for i, d in enumerate(ordered) if root[i] == i}
    parts = [decontamination.tokens(r.text) for r in items.collect()]
    clean = {d: r for d, r in stay.items() if all(decontamination.align(decontamination.tokens(r.text), i) < 0.5 for i in parts)}
    out = corpus_pipeline.run(spark, SMALL)
    assert set(documents.columns) <= set(out.columns)
    final = out.collect()
    assert {r.doc_id for r in final} <= set(clean)
    mixed = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(list(clean.values()), documents.schema)).collect()}
    counts = {}
    for r in final:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {d: n for d, n in mixed.items() if n}
    check_shards(final, 8, lambda r: len(r.text.encode()) + 1)


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_any_documents(spark, odd, docs_of, stage):
    name, function = stage
    for df in (odd, docs_of([])):
        out = function(spark, df, SMALL)
        assert set(df.columns) <= set(out.columns)
        assert out.count() <= 3 * df.count()
    assert function(spark, docs_of([]), SMALL).isEmpty()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, duck, name):
    ok, note, _ = compare(spark, duck, SMALL, name)
    assert ok, note


def test_all_are_registered():
    assert [n for n in E.queries() if n.startswith("op")] == list(QUERIES) and "pipeline" in E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_results_have_their_types(spark):
    wanted = {"op1_sharding": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int",
              "op2_suffix_dedup": "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
              "op3_html_text": "page_id long, url string, text string, n_chars long",
              "op4_substring_dedup": "doc_id long, n_words long, n_removed long, kept_sha256 string",
              "op6_mixing": "doc_id long, size long, source_size long, target double, taken long",
              "op8_simhash": "doc_id long, fingerprint string, component_id long",
              "op9_quality_rules": "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"}
    from pyspark.sql.types import StructType
    for name, ddl in wanted.items():
        have = {f.name: f.dataType for f in QUERIES[name](spark, SMALL).schema}
        assert {f.name: f.dataType for f in StructType.fromDDL(ddl)}.items() <= have.items(), name
