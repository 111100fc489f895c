"""Token totals by source, language and tokenizer, kept up to date by signed deltas.

Inserts, deletes and revised counts become rows that add or take away; totals are
sums of such rows and never need the corpus again. Each batch writes folders of its
own and counts as committed only once its totals are complete, so a batch may be
sent again, after a failure or by mistake, and changes nothing.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralattice import session
from terralattice.llm.common import by_batch, order_id

# Split pattern of the byte-level BPE vocabularies; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

DELTA = "doc long, tokenizer string, source string, lang string, docs long, tokens long"
_GROUP = ["source", "lang", "tokenizer"]


def count(docs: DataFrame, tokenizer: str, folder: str, deleted: bool = False) -> DataFrame:
    """doc_id, source, lang, tokenizer, tokens, deleted: the tokens of each text.

    `tokenizer` names a file of BPE ranks in `folder`, which every executor has;
    the name is the version totals are kept under. Null and empty texts have no
    tokens. Other columns of `docs` are not read.
    """
    path, held = f"{folder}/{tokenizer}", []

    def make(columns):
        if not held:
            import tiktoken

            with open(path, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            held.append(tiktoken.Encoding(tokenizer, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
        tokens = [len(held[0].encode_ordinary(text)) if text else 0 for text in columns["text"]]
        return {n: pa.array(columns[n], t) for n, t in (("doc_id", pa.int64()), ("source", pa.string()), ("lang", pa.string()))} | {"tokens": tokens}
    counted = by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text"),
                       "doc_id long, source string, lang string, tokens long", make)
    return counted.withColumn("tokenizer", F.lit(tokenizer)).withColumn("deleted", F.lit(deleted))


def removals(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Changes that take documents out of a tokenizer's totals; only doc_id is read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"),
                       F.lit(tokenizer).alias("tokenizer"), F.lit(0).cast("long").alias("tokens"), F.lit(True).alias("deleted"))


def committed(spark: SparkSession, path: str) -> list[int]:
    batches = (name for name in session.child_names(spark, f"{path}/totals") if name.startswith("batch="))
    return sorted(int(name.removeprefix("batch=")) for name in batches if "_SUCCESS" in session.child_names(spark, f"{path}/totals/{name}"))


def _read(spark: SparkSession, path: str, kind: str, batches: list[int]) -> DataFrame:
    schema = DELTA if kind == "deltas" else "source string, lang string, tokenizer string, docs long, tokens long"
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{kind}/batch={b}" for b in batches])


def apply(path: str, batch: int, changes: DataFrame) -> bool:
    """Commits a batch of changes to the totals at `path`; False if it was committed before.

    A change inserts a document for a tokenizer, replaces its count, source and
    language, or deletes it. A document that comes more than once in a batch
    counts once: a deletion gives way to a count, and the largest count stays. A
    deletion of a document that is not there does nothing. All documents with a null
    doc_id are one. Null sources and languages are groups like any other.
    """
    spark = changes.sparkSession
    done = committed(spark, path)
    if batch in done:
        return False
    key = ["doc", "tokenizer"]
    last = session.materialize(changes.withColumn("doc", order_id()).groupBy(*key).agg(F.max(F.struct(
        (~F.col("deleted")).alias("there"), "tokens", "source", "lang")).alias("c")).select(*key, "c.*"), "token-changes")  # texts are counted once
    added = last.where("there").select(*key, "source", "lang", F.lit(1).cast("long").alias("docs"), "tokens")
    stored = _read(spark, path, "deltas", done).join(last.select(*key), key, "left_semi")
    signed = added.unionByName(stored.withColumn("docs", -F.col("docs")).withColumn("tokens", -F.col("tokens")))
    net = signed.groupBy(*key, "source", "lang").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs != 0 or tokens != 0")
    net.write.mode("overwrite").parquet(f"{path}/deltas/batch={batch}")
    written = _read(spark, path, "deltas", [batch])
    written.groupBy(*_GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{path}/totals/batch={batch}")
    return True


def totals(spark: SparkSession, path: str) -> DataFrame:
    """source, lang, tokenizer, docs, tokens over all committed batches; groups without documents are left out."""
    rows = _read(spark, path, "totals", committed(spark, path))
    return rows.groupBy(*_GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs != 0")
