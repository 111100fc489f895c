"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralattice import session
from terralattice.llm import (bit_planes, decontamination, html_text, line_dedup, mixing, quality, resampling, secrets, sharding, simhash, substring_dedup,
                               suffix_dedup, token_counts)
from terralattice.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return keep


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.text_bytes().alias("size"), F.crc32("text").alias("text_crc32"))
    out = sharding.contiguous_shards(rows, 8, F.col("size"), ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", F.coalesce("text_crc32", F.lit(0)).cast("long").alias("text_crc32"),
                      F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# Every byte string of 50, as hexadecimal text, with the smallest document it starts in.
OP2 = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, nr, substr(h, 2 * nr + 1, 100) AS s FROM (SELECT *, unnest(range(0, length(h) // 2 - 49)) AS nr FROM texts WHERE length(h) >= 100)),
late AS (SELECT doc_id, nr FROM (SELECT doc_id, nr, min(doc_id) OVER (PARTITION BY s) AS first FROM strings) WHERE first < doc_id),
bytes AS (SELECT doc_id, nr, substr(h, 2 * nr + 1, 2) AS b FROM (SELECT *, unnest(range(0, length(h) // 2)) AS nr FROM texts)),
marked AS (
  SELECT b.*, bool_or(l.nr IS NOT NULL) OVER (PARTITION BY b.doc_id ORDER BY b.nr ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM bytes b LEFT JOIN late l ON l.doc_id = b.doc_id AND l.nr = b.nr),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY nr), false) AS starts FROM marked)
SELECT d.doc_id, count(r.b) AS n_bytes, count(*) FILTER (r.gone) AS n_removed, count(*) FILTER (r.starts) AS n_spans,
       sha256(unhex(coalesce(string_agg(r.b, '' ORDER BY r.nr) FILTER (NOT r.gone), ''))) AS kept_sha256
FROM documents d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op2_suffix_dedup", OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


_WORDS = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS nr FROM texts)"""


def _windows(n: int) -> str:
    """Word windows of one length, by their first word."""
    frame = f"OVER (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
    return f"SELECT doc_id, nr, s FROM (SELECT doc_id, nr, string_agg(word, ' ') {frame} AS s, count(*) {frame} AS n FROM words) WHERE n = {n}"


OP4 = _WORDS + f""",
late AS (SELECT doc_id, nr FROM (SELECT doc_id, nr, min(doc_id) OVER (PARTITION BY s) AS first FROM ({_windows(13)})) WHERE first < doc_id),
marked AS (
  SELECT w.*, bool_or(l.nr IS NOT NULL) OVER (PARTITION BY w.doc_id ORDER BY w.nr ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM words w LEFT JOIN late l ON l.doc_id = w.doc_id AND l.nr = w.nr)
SELECT d.doc_id, count(m.word) AS n_words, count(*) FILTER (m.gone) AS n_removed,
       sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.nr) FILTER (NOT m.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op4_substring_dedup", OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS u
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
fill(level) AS (
  SELECT CAST(0 AS DOUBLE)
  UNION
  SELECT CAST(sum(source_size) - coalesce(sum(CASE WHEN weight * level >= 3 * source_size THEN 3 * source_size END), 0) AS DOUBLE)
         / sum(CASE WHEN weight * level < 3 * source_size THEN weight END)
  FROM sources, fill GROUP BY level HAVING sum(CASE WHEN weight * level < 3 * source_size THEN weight END) > 0),
plan AS (
  SELECT source, source_size, CASE WHEN weight * level >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE weight * level END AS target
  FROM sources, (SELECT max(level) AS level FROM fill)),
ranked AS (
  SELECT s.*, p.source_size, p.target, CASE WHEN p.source_size > 0 THEN CAST(floor(p.target / p.source_size) AS BIGINT) ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
copied AS (
  SELECT *, whole + CASE WHEN 2 * before + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS copies FROM ranked)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, source, CAST(copies AS BIGINT) AS copies FROM copied
"""


@query("op6_mixing", OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


TOKENIZERS = "/opt/tokenizers"


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under one tokenizer; then those labelled toxic go and texts of low quality are
    counted anew without symbols; then the rest under a second tokenizer; one batch is sent twice."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    first, second = "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"
    toxic = labels.where("toxic = 1").select("doc_id")
    poor = labels.where("quality = 0 and toxic = 0").select("doc_id").distinct()
    path = session.scratch_path(spark, "token-totals")
    token_counts.apply(path, 1, token_counts.count(docs, first, TOKENIZERS))
    # Texts are counted where they are read; only their counts meet the labels.
    symbols = r"[#*$%&|<>]+"
    revised = docs.where(F.col("text").rlike(symbols)).withColumn("text", F.regexp_replace("text", symbols, ""))
    changed = token_counts.count(revised, first, TOKENIZERS).join(poor, "doc_id", "left_semi").unionByName(token_counts.removals(toxic, first))
    token_counts.apply(path, 2, changed)
    token_counts.apply(path, 3, token_counts.count(docs, second, TOKENIZERS).join(toxic, "doc_id", "left_anti"))
    token_counts.apply(path, 2, changed)
    return token_counts.totals(spark, path)


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _coverage(n: int) -> str:
    """Per document: words in windows of n words found twice or more, and characters in those found before."""
    frame = f"OVER (PARTITION BY w.doc_id ORDER BY w.nr ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""g{n} AS (
  SELECT doc_id, count(*) FILTER (twice) AS words, coalesce(sum(length(word)) FILTER (later), 0) AS chars FROM (
    SELECT w.doc_id, w.word, bool_or(coalesce(x.again > 1, false)) {frame} AS twice, bool_or(coalesce(x.place > 1, false)) {frame} AS later
    FROM words w LEFT JOIN (
      SELECT doc_id, nr, count(*) OVER (PARTITION BY doc_id, s) AS again, row_number() OVER (PARTITION BY doc_id, s ORDER BY nr) AS place
      FROM ({_windows(n)})) x ON x.doc_id = w.doc_id AND x.nr = w.nr)
  GROUP BY doc_id)"""


_LENGTHS = tuple(quality.LIMITS)
OP9 = _WORDS + ",\n" + ",\n".join(map(_coverage, _LENGTHS)) + r""",
lines AS (
  SELECT doc_id, count(*) FILTER (place > 1) AS again, coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (place > 1), 0) AS chars
  FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY nr) AS place
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS nr FROM texts)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) GROUP BY doc_id),
base AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.again, 0) AS n_dup_lines, coalesce(g8.words, 0) AS n_repeat_words, coalesce(l.chars, 0) AS line_chars""" + "".join(
    f", coalesce(g{n}.chars, 0) AS c{n}" for n in _LENGTHS) + """
  FROM texts t LEFT JOIN lines l ON l.doc_id = t.doc_id""" + "".join(f" LEFT JOIN g{n} ON g{n}.doc_id = t.doc_id" for n in _LENGTHS) + """),
shares AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN CAST(line_chars AS DOUBLE) / word_chars ELSE 0 END AS dup_line_share""" + "".join(
    f", CASE WHEN word_chars > 0 THEN CAST(c{n} AS DOUBLE) / word_chars ELSE 0 END AS dup_{n}gram_share" for n in _LENGTHS) + """ FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_share, """ + ", ".join(
    f"dup_{n}gram_share" for n in _LENGTHS) + f""", base_failed,
  NOT base_failed AND dup_line_share <= {quality.LINE_LIMIT}::DOUBLE AND """ + " AND ".join(
    f"dup_{n}gram_share <= {limit}::DOUBLE" for n, limit in quality.LIMITS.items()) + " AS kept FROM shares"


@query("op9_quality_rules", OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


# Windows of two lines stand for longer runs: a line lies in a repeated run if and only if it lies in such a window.
OP10 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr
  FROM documents),
numbered AS (
  SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded,
         sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY nr) AS pos
  FROM lines),
pairs AS (
  SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY nr) AS next FROM numbered WHERE worded),
later AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, pos) > 1 AS again FROM pairs WHERE next IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, pos + step AS pos FROM later, (VALUES (0), (1)) AS s(step) WHERE again)
SELECT d.doc_id, CAST(count(*) FILTER (n.worded) AS BIGINT) AS n_lines, CAST(count(*) FILTER (n.worded AND g.pos IS NOT NULL) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(n.line, chr(10) ORDER BY n.nr) FILTER (g.pos IS NULL), '')) AS kept_sha256
FROM documents d JOIN numbered n USING (doc_id) LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.pos = n.pos
GROUP BY d.doc_id
"""


@query("op10_line_dedup", OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_secret_scans")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_model")


def _op12() -> str:
    """Rounds of nearest centroids and floored means over exact integers; places of a vector are rows."""
    near = """d{r} AS MATERIALIZED (SELECT v.nr, c.cluster, sum((v.q - c.q) * (v.q - c.q)) AS d FROM places v JOIN c{r} c ON c.place = v.place GROUP BY v.nr, c.cluster),
a{r} AS MATERIALIZED (SELECT nr, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM d{r} GROUP BY nr),
"""
    mean = """m{r} AS (SELECT a.cluster, v.place, sum(v.q) AS total, count(*) AS n FROM a{r} a JOIN places v USING (nr) GROUP BY a.cluster, v.place),
c{s} AS MATERIALIZED (
  SELECT c.cluster, c.place, CASE WHEN m.n IS NULL THEN c.q ELSE CAST((total - ((total % n) + n) % n) // n AS BIGINT) END AS q
  FROM c{r} c LEFT JOIN m{r} m USING (cluster, place)),
"""
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS nr, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
places AS MATERIALIZED (
  SELECT nr, unnest(range(1, 65)) AS place, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS q FROM vectors),
first AS (SELECT nr, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), nr) - 1 AS cluster FROM vectors),
c0 AS MATERIALIZED (SELECT f.cluster, p.place, p.q FROM first f JOIN places p USING (nr) WHERE f.cluster < 16),
""" + "".join(near.format(r=r) + mean.format(r=r, s=r + 1) for r in range(3)) + near.format(r=3) + """
named AS (SELECT cluster, sha256(string_agg(CAST(q AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM c3 GROUP BY cluster)
SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, n.centroid_sha256
FROM a3 a JOIN vectors v USING (nr) JOIN named n ON n.cluster = a.cluster
"""


@query("op12_bit_planes", _op12())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, centroids = bit_planes.cluster(table(spark, sf_dir, "embeddings"))
    if not centroids:
        return out.withColumn("centroid_sha256", F.lit(""))
    names = F.array(*[F.lit(bit_planes.digest(c)) for c in centroids])
    return out.withColumn("centroid_sha256", names[F.col("cluster")])


@query("op13_resampling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
