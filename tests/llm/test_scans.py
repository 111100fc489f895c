"""Secret scans, bit-plane clustering and importance resampling against brute force."""

import collections
import hashlib
import math
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terralattice.llm import bit_planes, radix, resampling, secrets
from terralattice.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_base(text):
    """(start, kind, end) and, of assignments, where the value starts."""
    out = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), m.start()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), m.start()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def brute_chances(strings):
    """Chance of a character after two, from counts of one, two and three."""
    letters = set(secrets.ALPHABET)
    counts = [collections.Counter() for _ in range(3)]
    for s in strings:
        padded = "\0\0" + "".join(c if c in letters else "\0" for c in s)
        for i in range(2, len(padded)):
            if padded[i] != "\0":
                for order in range(3):
                    counts[order][padded[i - order:i + 1]] += 1
    seen = [collections.Counter() for _ in range(3)]
    for order in range(3):
        for gram, n in counts[order].items():
            seen[order][gram[:-1]] += n

    def log_chance(gram):
        p = 1 / len(letters)
        for order in range(3):
            part = gram[2 - order:]
            p = (counts[order][part] + secrets.STRENGTH * p) / (seen[order][part[:-1]] + secrets.STRENGTH)
        return math.log(p)
    return log_chance


def brute_scan(texts):
    labelled = ([], [])
    for text in texts:
        at = 0
        labelled[1].extend(secrets.drawn(text))
        for start, _, end, value in brute_base(text):
            if max(start, value) >= at:
                labelled[1].append(text[value:end])
                labelled[0].append(text[at:value])
            at = max(at, end)
        labelled[0].append(text[at:])
    ordinary, rand = map(brute_chances, labelled)
    out = []
    for text in texts:
        base = [b[:3] for b in brute_base(text)]
        found = list(base)
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]{12,}", text):
            padded = "\0\0" + m[0]
            ratio = sum(math.floor(1000 * (rand(padded[i - 2:i + 1]) - ordinary(padded[i - 2:i + 1]))) for i in range(2, len(padded)))
            if ratio > 1000 * math.log(1e6) and not any(a < m.end() and z > m.start() for a, _, z in base):
                found.append((m.start(), 3, m.end()))
        out.append(tuple(",".join(f"{secrets.KINDS[k]}:{a}:{z}" for a, k, z in sorted(part)) for part in (base, found)))
    return out


def drawn_string(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.fixture(scope="module")
def leaky(docs_of):
    """Texts of words with strings that no fixed pattern matches, and the traps of the patterns."""
    rng = random.Random(3)
    stems = ["get", "set", "user", "account", "value", "index", "file", "path", "name", "list", "order", "total", "count", "page", "item"]
    rows, planted = [], {}
    for i in range(300):
        words = ["_".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(120)]
        if i % 10 == 0:
            planted[i] = drawn_string(rng, string.ascii_letters + string.digits, 32)
            words[60] = planted[i]
        rows.append((i, " ".join(words)))
    rows += [(1000, 'token=password=abcdefghijklmnop secret : "short" API_KEY:"abcdefghijkl'), (1001, "token:secret : abcdefghijklm"),
             (1002, "AKIAAKIA0123456789 AKIA" + "Z" * 13 + " AKIA" + "Z" * 14), (1003, "é" * 5 + "0123456789abcdef" + "é 0123456789abcdeF"),
             (1004, "toKen = abcdefghijklmnop paſsword=abcdefghijklmnop"), (1005, "passwd='" + "0f" * 20 + "'" + "\x00" + "f" * 16),
             (1006, "x_" + "a1" * 12 + "_Zq9")]
    return docs_of(rows), planted


def test_secrets_are_those_of_brute_force(spark, documents, odd, leaky):
    for df in (documents, odd.where("doc_id is null or doc_id not in (5, 6)"), leaky[0]):
        rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
        want = collections.Counter((r.doc_id, *w) for r, w in zip(rows, brute_scan([r.text for r in rows])))
        got = secrets.scan(df).collect()
        assert collections.Counter((r.doc_id, r.base, r.spans) for r in got) == want
        for r in got:
            kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
            assert [r.n_assign, r.n_access, r.n_hex, r.n_model] == [kinds.count(k) for k in secrets.KINDS]


def test_model_finds_strings_it_was_not_shown(leaky):
    """Trained on one half, read on the other: all planted strings, no ordinary one."""
    docs, planted = leaky
    model = secrets.train(secrets.transition_counts(docs.where("doc_id % 20 = 0")))
    rows = [r for r in secrets.scan(docs.where("doc_id % 20 != 0 and doc_id < 1000"), model).collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: [texts[r.doc_id][int(a):int(z)] for _, a, z in (s.split(":") for s in r.spans.split(","))] for r in rows if r.spans}
    assert found == {i: [s] for i, s in planted.items() if i % 20}


def test_samples_in_parts_count_as_a_whole(documents, monkeypatch):
    whole = sorted(secrets.transition_counts(documents).collect())
    assert sorted(secrets.transition_counts(documents.repartition(7)).collect()) == whole


def test_secret_query(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op11_secret_scans"](spark, SMALL).collect()}
    texts = documents.collect()
    for r, (base, all_) in zip(texts, brute_scan([t.text or "" for t in texts])):
        assert rows[r.doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and rows[r.doc_id].spans == all_


def test_secrets_of_odd_documents(odd, docs_of):
    rows = secrets.scan(odd).collect()
    assert len(rows) == odd.count() and all(r.spans == "" for r in rows if r.doc_id in (1, 2, 3))
    assert secrets.scan(docs_of([])).isEmpty()


def brute_clusters(vectors, n=16, rounds=3):
    """cluster, distance per vector and the centroids, from (vec_id, integers)."""
    def planes(v):
        most = max(x if x >= 0 else -x - 1 for x in v).bit_length()
        return [w - (1 << 64) if w >> 63 else w for w in (sum((x >> i & 1) << k for k, x in enumerate(v)) for i in range(most + 1))]
    order = sorted(vectors, key=lambda v: (hashlib.sha256(f"1:{'' if v[0] is None else v[0]}".encode()).hexdigest(), planes(v[1])))
    centroids = [list(v) for _, v in order[:n]]

    def near():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids)) for _, v in vectors]
    for _ in range(rounds):
        best = near()
        for i in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(vectors, best) if c == i]
            if mine:
                centroids[i] = [sum(column) // len(mine) for column in zip(*mine)]
    return [(c, d) for d, c in near()], centroids


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, inertia string")


def brute_rows(vectors):
    best, centroids = brute_clusters(vectors)
    per, total = collections.Counter(), sum(d for _, d in best)
    for c, d in best:
        per[c] += d
    def fits(x):
        return x if x < 1 << 63 else None
    return collections.Counter((v, c, fits(d), fits(per[c]), fits(total)) for (v, _), (c, d) in zip(vectors, best)), centroids


@pytest.mark.parametrize("most", [0.4, 900.0, 1e9, 2.0 ** 54])
def test_clusters_are_those_of_brute_force(spark, most):
    """Small components, and such as need more planes, and more than 64 bits."""
    rng = random.Random(int(most))
    kept = [(i, [rng.uniform(-most, most) for _ in range(64)]) for i in range(60)]
    kept += [(None, [0.0] * 64), (7, kept[3][1]), (None, [-most] * 64), (90, [0.25] * 63 + [-0.0])]
    bad = [(100, [0.1] * 63), (101, [0.1] * 65), (102, None), (103, []), (104, [0.1] * 63 + [None]), (105, [0.1] * 63 + [math.nan]), (106, [math.inf] + [0.1] * 63),
           (107, [2.0 ** 56] * 64)]
    df = vectors_of(spark, [(i, v, "extra", "extra") for i, v in kept + bad])
    want, centroids = brute_rows([(i, [math.floor(64 * x) for x in v]) for i, v in kept])
    out, found = bit_planes.cluster(df.repartition(5))
    assert collections.Counter(tuple(r) for r in out.collect()) == want and found == centroids


def test_few_or_no_vectors(spark):
    df = vectors_of(spark, [(i, [float(i)] * 64, "", "") for i in range(5)])
    out, centroids = bit_planes.cluster(df)
    assert len(centroids) == 5 and {r.distance for r in out.collect()} == {0}
    out, centroids = bit_planes.cluster(df.where("false"))
    assert out.isEmpty() and centroids == []


def test_planes_keep_products():
    rng = np.random.default_rng(5)
    for low, high in ((-1, 1), (-40, 37), (0, 1), (-2 ** 20, 3), (-2 ** 40, 2 ** 41)):
        a, b = rng.integers(low, high, (2, 9, 64))
        left, right = bit_planes.pack(a), bit_planes.pack(b)
        want = [sum(x * y for x, y in zip(u, v)) for u, v in zip(a.tolist(), b.tolist())]
        assert bit_planes.dots(left, right).tolist() == want == bit_planes.dots(bit_planes.widen(left, 45), right).tolist()
        assert bit_planes.component_sums(left) == a.sum(0).tolist()


def brute_resample(rows, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    def count(texts):
        return collections.Counter(zlib.crc32(w.encode()) % 10000 for t in texts for w in words(t))
    corpus, target = count(t for _, t in rows), count(items)
    s_all, t_all = sum(corpus.values()), sum(target.values())
    out = []
    for doc_id, text in rows:
        found = words(text)
        gains = [math.floor(1000 * math.log((target[b] + 1) * (s_all + 10000) / ((corpus[b] + 1) * (t_all + 10000)))) for b in (zlib.crc32(w.encode()) % 10000 for w in found)]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:10 * len(able) // 100]):
        r[4] = i + 1
    return collections.Counter(map(tuple, out))


def test_resampling(spark, documents, odd):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = [r.text for r in items.collect()]
    got = collections.Counter(tuple(r) for r in QUERIES["op13_resampling"](spark, SMALL).collect())
    assert got == brute_resample([(r.doc_id, r.text) for r in documents.collect()], texts)
    for df in (odd, odd.unionByName(documents, allowMissingColumns=True)):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert collections.Counter(tuple(r) for r in resampling.resample(df, items).collect()) == brute_resample(rows, texts)


def test_resampling_of_empty_tables(docs_of, odd):
    none = docs_of([])
    assert resampling.resample(none, none).isEmpty()
    assert resampling.resample(odd, none).count() == odd.count()


def test_features_of_longer_runs():
    found, n = resampling.features("One two, three".encode(), 3)
    assert n == 3 and sorted(found) == sorted(zlib.crc32(f) % 10000 for f in (b"one", b"two", b"three", b"one two", b"two three", b"one two three"))


@pytest.mark.parametrize("digit_bits, chunk", [(2, 7), (5, 64), (12, 1 << 17)])
def test_radix_ranks(spark, digit_bits, chunk):
    rng = random.Random(digit_bits)
    tables = [[(rng.randint(-5, 5), rng.choice([-9, 0, 3, 900]), i) for i in range(300)], [], [(4, 4, i) for i in range(50)],
              [(rng.choice([-(1 << 63), (1 << 63) - 1, 0, -1]), rng.randint(-3, 3), i) for i in range(40)], [(1, 2, 3)]]
    for rows in tables[:3] if digit_bits == 2 else tables:
        df = spark.createDataFrame(rows, "a long, b long, extra long").repartition(4, "extra")
        got = sorted(radix.ranks(df, ["a", "b"], digit_bits, chunk).collect(), key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(len(rows)))
        assert [(r.a, r.b) for r in got] == sorted((a, b) for a, b, _ in rows)
        assert sorted((r.a, r.b, r.extra) for r in got) == sorted(rows)
