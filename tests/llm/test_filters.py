"""Quality rules, fingerprints, decontamination and page text against brute force."""

import collections
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from terralattice import session
from terralattice.llm import components, decontamination, html_text, quality, simhash, winnow

SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def base_measures(text):
    text = (text or "").encode()
    words = SPLIT.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = collections.Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    lines, seen, again = text.split(b"\n"), set(), 0
    for line in lines:
        if SPLIT.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), len(re.findall(rb"[#*$%&|<>]", text)), again, len(inside),
            len(words) < 20 or 100 * len(inside) > 30 * len(words))


def test_quality_measures(spark, documents, odd):
    for df in (documents, odd):
        texts = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r[0]].append(base_measures(r[1]))
        got = quality.assess(df).collect()
        assert len(got) == df.count()
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in texts[r.doc_id]
            assert not (r.base_failed and r.kept)


def test_quality_verdict(docs_of):
    clean = " ".join(f"word{i}" for i in range(100))
    repeated = " ".join(["the same five words again"] * 3 + [f"w{i}" for i in range(60)])
    lines = "\n".join([f"only line {i} here today" for i in range(6)] + ["one line that comes again"] * 6)
    df = docs_of([(1, clean), (2, repeated), (3, lines), (4, clean + "\nshort line twice\nshort line twice")])
    assert {r.doc_id: r.kept for r in quality.assess(df).collect()} == {1: True, 2: False, 3: False, 4: True}
    assert [r.doc_id for r in quality.keep_good(df).orderBy("doc_id").collect()] == [1, 4]


def test_quality_empty(docs_of):
    assert quality.assess(docs_of([])).isEmpty() and quality.keep_good(docs_of([])).columns == docs_of([]).columns


def brute_fingerprint(text):
    words = SPLIT.findall((text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids):
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("block", [2048, 3])
def test_near_groups(spark, documents, odd, monkeypatch, block):
    """With small blocks, most buckets go the way of crowded ones."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    for df in (documents, odd):
        rows = df.select("doc_id", "text").collect()
        prints = [brute_fingerprint(t) for _, t in rows]
        ids = [-(1 << 63) if d is None else d for d, _ in rows]
        want = sorted((d, p, c) for d, p, c in zip(ids, prints, brute_components(prints, ids)))
        got = sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.fp % (1 << 64), -(1 << 63) if r.component_id is None else r.component_id)
                     for r in simhash.near_groups(df).collect())
        assert got == want


def test_near_groups_of_no_documents(docs_of):
    assert simhash.near_groups(docs_of([])).isEmpty()


def test_masks_cover_every_pair_within_the_radius():
    import random
    rng = random.Random(7)
    masks = simhash.masks(4)
    assert len(masks) == 31
    for _ in range(5000):
        flip = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(flip & m == 0 for m in masks)


def test_components_of_a_long_path(spark):
    n = 300
    links = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    nodes = spark.range(n + 2).withColumnRenamed("id", "node")
    roots = {r.node: r.root for r in components.connected(nodes, links).collect()}
    assert roots == {i: 0 for i in range(n)} | {n: n, n + 1: n + 1}


def brute_align(a, b):
    best, before = 0, [0] * (len(a) + 1)
    for w in b:
        row = [0]
        for j, v in enumerate(a, 1):
            row.append(max(0, before[j - 1] + (2 if v == w else -1), before[j] - 1, row[-1] - 1))
        best, before = max(best, *row), row
    return best / (2 * len(b))


def test_alignment():
    import random
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(1, 30))] for _ in range(2))
        assert decontamination.align(a, b) == pytest.approx(brute_align(a, b))


def test_matches(spark, docs_of):
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa"
    edited = item.replace("delta", "DELTA,").replace("golf", "tango").replace("lima mike", "lima uniform mike")
    noise = " ".join(f"n{i}" for i in range(300))
    df = docs_of([(1, noise), (2, f"{noise} {item} {noise}"), (3, f"{noise}\n{edited}. {noise}"), (4, "alpha bravo charlie " + noise),
                  (5, None), (6, ""), (None, item), (7, item), (7, item)])
    items = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "two words"), (None, "other text that no document holds")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.matches(df, items).collect()}
    assert set(got) == {(2, 10), (3, 10), (None, 10), (7, 10)} and got[2, 10] == 1.0 and 0.75 < got[3, 10] < 1.0
    assert sorted(r.doc_id for r in decontamination.clean(df, items).collect()) == [1, 4, 5, 6]
    assert decontamination.matches(docs_of([]), items).isEmpty() and decontamination.matches(df, items.limit(0)).isEmpty()


def test_matches_find_what_full_alignment_finds(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(documents, items).collect()}
    texts = [(r.doc_id, decontamination.tokens(r.text)) for r in documents.collect()]
    wanted = {(d, r.item_id) for r in items.collect() for d, words in texts if decontamination.align(words, decontamination.tokens(r.text)) >= 0.5}
    assert got == wanted


def edited(rng, words, vocabulary):
    """A copy with words changed, left out, put in and moved to a new line."""
    out, share = [], rng.choice([0.05, 0.2, 0.3, 0.45])
    for w in words:
        kind = rng.random()
        if kind < share / 3:
            continue
        out.append(rng.choice(vocabulary) if kind < share * 2 / 3 else w)
        if kind > 1 - share / 3:
            out.append(rng.choice(vocabulary))
    return out


def test_no_edited_copy_is_lost(spark, docs_of):
    """All pairs of documents and items aligned in whole give the same scores; items share words and pairs."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(120)]
    zipf = [v for i, v in enumerate(vocabulary) for _ in range(120 // (i + 1))]
    items = [(i, [rng.choice(zipf) for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 15, 30, 60]))]) for i in range(60)]
    texts = []
    for _ in range(90):
        noise = [[rng.choice(zipf) for _ in range(rng.randint(0, 60))] for _ in range(2)]
        texts.append(noise[0] + edited(rng, rng.choice(items)[1], vocabulary) + noise[1])
    spread = items[-1][1]
    texts += [[x for w in spread for x in (w, "foreign")], [x for w in spread for x in (w, "foreign", "words")], []]
    want = {}
    for d, words in enumerate(texts):
        for i, item in items:
            score, common = decontamination.aligned(words, item)
            if score >= (0.5 if len(item) > 2 else 1.0) and common >= min(6, len(item)):
                want[d, i] = score
    assert ((len(texts) - 3, items[-1][0]) in want) and len(want) > 100
    df = docs_of([(d, " ".join(words)) for d, words in enumerate(texts)]).repartition(4)
    table = spark.createDataFrame([(i, " ".join(words)) for i, words in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.matches(df, table).collect()}
    assert got == want


def test_passages_do_not_grow_with_unrelated_items(spark, docs_of):
    """Ten times as many items give passages of the copies still, not of every document."""
    rng = random.Random(5)
    zipf = [f"w{i}" for i in range(20_000) for _ in range(20_000 // (i + 1))]
    items = [(i, " ".join(rng.choice(zipf) for _ in range(30))) for i in range(1000)]
    df = docs_of([(d, " ".join(rng.choice(zipf) for _ in range(300))) for d in range(200)] + [(1000 + i, items[i][1]) for i in range(100)])
    counts = []
    for n in (100, 1000):
        held = spark.createDataFrame(items[:n], "item_id long, text string").withColumn("nr", F.col("item_id"))
        docs = df.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("node"), "text")
        seeds = decontamination.rare_seeds(docs, held)
        sized = held.select("nr", F.lit(30).cast("long").alias("words"))
        counts.append(decontamination._near(docs, seeds, sized, 0.5).count())
    assert 100 <= counts[0] < 200 * 2 and counts[1] < 200 * 2 * 2


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></ul></nav><div id="cookie-notice"><p>We use cookies, yes.</p></div>
<div class="layout with-sidebar">%s<div class="sidebar"><p>Side text, which is here.</p></div></div>
<section id="comments"><div class="comment"><p>Nice post, really, I liked it, a lot, and more.</p></div></section>
<form><p>Name <input></form><aside>Aside</aside><footer>&copy; foot</footer>"""


def test_main_text():
    body = "<h2>Head &amp; shoulders</h2><p>First para, with <b>bold</b> &lt;b&gt;.<br>Same block.<p>Second\n  para<ul><li>One<li>Two</ul>"
    want = "Head & shoulders\nFirst para, with bold <b>. Same block.\nSecond para\nOne\nTwo"
    for wrap in ("<article>%s</article>", "<main><article>%s<div class='share'><a>x</a></div></article></main>", "<div class='content'>%s</div>"):
        assert html_text.main_text(PAGE % (wrap % body)) == want
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x") == ""
    assert html_text.main_text("plain &lt; text") == "plain < text"
    assert html_text.main_text("<div>" * 5000 + "<p>deep text, here.</p>") == "deep text, here."


def paragraphs(n, word="Paragraph"):
    return "".join(f"<p>{word} {k} of the article, which has some words, and more.</p>" for k in range(n))


def test_an_article_keeps_what_is_its_own():
    """Lists of links, parts with names like boxes and short parts stay; boxes in an article go."""
    references = "<ol>" + "".join(f"<li><a href=x>Reference number {i}</a> 20{i}</li>" for i in range(5)) + "</ol>"
    text = html_text.main_text(f"<nav><ul>{references}</ul></nav><article>{paragraphs(3)}{references}</article>")
    assert text.count("Paragraph") == 3 and text.count("Reference number") == 5
    text = html_text.main_text(f"<div><section>{paragraphs(9)}</section><section><p>One short part.</p></section><table><tr><td>cell one<td>cell two</table></div>")
    assert text.endswith("\nOne short part.\ncell one\ncell two")
    text = html_text.main_text(f"""<article>{paragraphs(2)}<section id="related-work"><p>Work of others.</p></section><h2 class="social-title">Social</h2>
      <p class="ad">Kept.</p><div class="ad-slot">Buy</div><section id="comments"><p>Nice!</p></section><form>Name</form><div class="share-buttons">x</div></article>""")
    assert text.endswith("Work of others.\nSocial\nKept.")


def test_broken_and_deep_pages_take_linear_time():
    """Ten times the page takes some ten times the time, whatever is never closed."""
    import time
    for part, around in (("<a ", "%s"), ("<div>", "%s<p>deep, text.</p>"), ("<a href=\"x ", "%s>"), ("<!-- ", "%s"), ("</x>", "%s"), ("<article>", "%s<p>x, y.</p>"),
                         ("<", "%s>"), ("a = ", "<p %s>"), ("<p><b>", "%s"), ("<a b='\"'>", "%s"), ("<ul><li>", "%s")):
        took = []
        for n in (2_000, 20_000):
            start = time.process_time()
            html_text.main_text(around % (part * n))
            took.append(time.process_time() - start)
        assert took[1] < 40 * max(took[0], 0.01), (part, took)


def scored(page, commas=True, density=True):
    """Points of containers from their paragraphs, by the rule alone: [(name, own points, kept)]; a page is [(name, [(text, link)])] in one wrapper."""
    points = {}
    for name, parts in page:
        total = linked = 0
        points[name] = 0.0
        for text, link in parts:
            size = len(text + link)
            share = len(link) / size if density else 0.0
            points[name] += (1 + (text.count(",") + link.count(",") if commas else 0) + min(size / 100, 3)) * (1 - share)
            total, linked = total + size, linked + len(link)
        points[name] = points[name], 1 - (linked / total if density else 0.0)
    best = max(points, key=lambda n: points[n][0] * points[n][1])
    return {n for n, (p, d) in points.items() if n == best or p * d >= 0.2 * points[best][0]}


def test_points_decide_where_no_tag_does():
    """Pages of plain containers: those kept are those that the rule keeps, and commas and links matter."""
    rng = random.Random(6)
    differ = {"commas": 0, "density": 0}
    for _ in range(120):
        page = []
        for c in range(rng.randint(4, 6)):
            kind = rng.choice(["prose", "links", "list", "short"])
            parts = []
            for k in range(rng.randint(1, 9)):
                words = [f"c{c}w{k}x{i}" for i in range(rng.randint(3, 40) if kind != "short" else 3)]
                text = (", " if kind == "prose" else " ").join(words)
                parts.append(("see", " " + text) if kind == "links" else (text, ""))
            page.append((f"c{c}", parts))
        body = "".join(f"<div id={name}>" + "".join(f"<p>{text}" + (f"<a href=/x>{link}</a>" if link else "") + "</p>" for text, link in parts) + "</div>" for name, parts in page)
        text = html_text.main_text(f"<body><div id=outer><div id=inner>{body}</div></div></body>")
        lines = set(text.split("\n"))
        kept = {name for name, parts in page if {(t + l).strip() for t, l in parts} <= lines}
        whole = sum(map(len, (p for _, p in page)))
        if kept == {n for n, _ in page} and len(lines) == whole:
            continue  # the wrapper has more points than any one of them
        want = scored(page)
        assert kept == want
        differ["commas"] += scored(page, commas=False) != want
        differ["density"] += scored(page, density=False) != want
    assert min(differ.values()) > 5, differ


def test_extract_rows(spark):
    rows = [(1, "u", "<p>One, two.</p>"), (1, "u", "<p>One, two.</p>"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted(map(tuple, html_text.extract(df).collect()), key=str) == sorted([(1, "u", "One, two."), (1, "u", "One, two."), (None, None, ""), (2, "v", "")], key=str)
    assert html_text.extract(df.limit(0)).isEmpty()


def test_pages_keep_their_articles(spark):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer|$)", r.html, re.S)[1]
        blocks = re.sub(r"<[^>]*>?", "", re.sub(r"</?(?:p|h1)[^>]*>", "\n", body.replace("<br>", " "))).split("\n")
        assert texts[r.page_id] == "\n".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())


@pytest.mark.parametrize("every", [4, 5, 6])
@pytest.mark.parametrize("length", [14, 20, 30, 50])
def test_edited_copies_without_a_verbatim_one(docs_of, spark, length, every):
    """Most n-grams of such an item are in no document, or only in other documents."""
    rows, items, wanted = [], [], set()
    for start in range(every):
        words = [f"i{start}w{k}" for k in range(length)]
        edited = [f"x{k}" if k % every == start else w for k, w in enumerate(words)]
        items.append((start, " ".join(words)))
        rows.append((start, "some words before " + " ".join(edited) + " and some behind"))
        rows += [(100 + start, " ".join(words)), (200 + start, " ".join(words[start + 1:start + 4]))][:start % 3]
    df = docs_of(rows)
    for d, text, *_ in rows:
        wanted |= {(d, i) for i, item in items if decontamination.align(decontamination.tokens(text), decontamination.tokens(item)) >= 0.5}
    assert {(i, i) for i in range(every)} <= wanted
    found = decontamination.matches(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == wanted


def test_stretches_hold_whole_alignments(spark, docs_of):
    """Words of any script count, and a copy with many inserted words is not cut."""
    cyrillic = "один два три четыре пять шесть семь восемь девять десять ноль сто тысяча год день час дом лес река море".split()
    edited = [w if k % 5 else "слово" for k, w in enumerate(cyrillic)]
    words = [f"w{k}" for k in range(40)]
    spread = words[:3] + [x for k in range(3, 40, 2) for x in [*words[k:k + 2], f"y{k}", f"z{k}"]]
    df = docs_of([(1, "начало текста " + " ".join(edited) + " и конец"), (2, " ".join(spread)), (3, " ".join(cyrillic))])
    for item, wanted in ((cyrillic, {1, 3}), (words, {2})):
        items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
        got = {r.doc_id: r.score for r in decontamination.matches(df, items).collect()}
        full = {r.doc_id: decontamination.align(decontamination.tokens(r.text), item) for r in df.collect()}
        assert set(got) == wanted and got == {d: full[d] for d in wanted}


def test_short_items(spark, docs_of):
    """Some common words in a row are no copy of a short question; a short item is found whole."""
    df = docs_of([(1, "we know what is the weather"), (2, "so, What is the capital of Peru? Lima"), (3, "two words here"), (4, "words two here"),
                  (5, "it says zebra."), (6, "ask: what was the best large capital city of old Peru"), (7, "a b c d"), (8, "c b a")])
    items = spark.createDataFrame([(1, "What is the capital of Peru"), (2, "two words"), (3, "Zebra"), (4, "a b c"),
                                   (5, "what is the best large capital city of old peru")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(df, items).collect()}
    assert got == {(2, 1), (3, 2), (5, 3), (7, 4), (6, 5)}


def test_wrappers_of_articles_without_an_article_element():
    body = "".join(f"<p>Paragraph {k} of the article, which has some words, and more.</p>" for k in range(6))
    want = "\n".join(f"Paragraph {k} of the article, which has some words, and more." for k in range(6))
    for wrap in ("<form id=aspnetForm><div>%s</div></form>", "<form><article>%s</article></form>", "<div class='layout sidebar-right'>%s</div>",
                 "<div class='content social'>%s</div>", "<form><div class='page teaser'><div>%s</div></div></form>"):
        assert html_text.main_text("<div>Site title</div>" + wrap % body) == want
    assert html_text.main_text("<h1>Site</h1><div class='teaser'>%s</div><div class='social'>%s</div>" % (body, body)).count("Paragraph") == 12
    comment = "<div id='comments'>" + "<p>Nice post, really, I liked it, a lot, and more of it.</p>" * 20 + "</div>"
    assert html_text.main_text(f"<div>{body}</div>{comment}") == want


@pytest.mark.parametrize("few", [0, session.FEW])
def test_few_links_are_joined_without_a_shuffle(spark, monkeypatch, few):
    monkeypatch.setattr(session, "FEW", few)
    links = spark.createDataFrame([(i, i * 7 % 60 + 1) for i in range(1, 61)] + [(5, 5), (70, 71), (71, 70)], "a long, b long")
    edges = session.gathered(links, "test-links")
    plan = components._small_star(components._large_star(edges))._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange hashpartitioning" in plan) == (few == 0)
    root = {n: n for n in range(1, 72)}
    for _ in root:
        for a, b in links.collect():
            root[a] = root[b] = min(root[a], root[b])
    nodes = spark.createDataFrame([(n,) for n in root], "node long")
    assert {r.node: r.root for r in components.connected(nodes, links).collect()} == root


def test_words_are_those_of_the_pattern():
    for text in ["".join(map(chr, range(128))), "".join(map(chr, range(300))), "Ab_c-9\x1fd \x00e", "Größe ǅ İx", "", None, "   "]:
        assert decontamination.tokens(text) == re.findall(r"\w+", (text or "").lower())


@pytest.mark.parametrize("block", [1, 50, 1 << 16])
@pytest.mark.parametrize("singles", [False, True])
def test_pairs_of_many_texts_are_those_of_each(monkeypatch, block, singles):
    """Texts share a call of the hash; no pair spans two of them."""
    rng = random.Random(8)
    texts = [None, "", "one", "one two", "é ü", *[" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(40))) for _ in range(200)], ""]
    keys = [decontamination.pair_keys(decontamination.tokens(t), singles) for t in texts]
    bits = np.packbits(np.isin(np.arange(decontamination.FILTER_BITS), decontamination._places(np.concatenate([k for k, _ in keys])[::3])), bitorder="little")
    want = sorted((int(k), int(a), i) for i, (key, at) in enumerate(keys) for k, a, p in zip(key, at, decontamination._passing(key, bits)) if p)
    calls, mix = [], winnow.mix
    monkeypatch.setattr(winnow, "mix", lambda values: calls.append(1) or mix(values))
    monkeypatch.setattr(decontamination, "_BLOCK", block)
    found = decontamination._passing_pairs(texts, singles, bits)
    assert sorted(zip(*(c.tolist() for c in found))) == want and len(want) > 100
    assert block < 1 << 16 or len(calls) <= 3
