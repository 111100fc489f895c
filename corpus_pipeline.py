"""From raw documents to balanced training shards, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; every result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralattice import session
from terralattice.llm import decontamination, mixing, near_copies, quality, sharding
from terralattice.llm.common import order_id, table, text_hash

N_SHARDS = 8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules; null and empty texts do not."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest doc_id and then text; ids may be missing or repeated."""
    marked = docs.select(order_id().alias("id"), text_hash().alias("node"), F.struct(*docs.columns).alias("row"))
    rooted = session.materialize(marked.select("id", "node").distinct().join(near_copies.groups(docs), "node", "left")
                                 .withColumn("root", F.coalesce("root", "node")), "near-rooted")
    least = rooted.join(rooted.groupBy("root").agg(F.min("id").alias("id")), ["root", "id"])
    stay = session.materialize(least.groupBy("root", "id").agg(F.min("node").alias("node"), F.count("*").alias("n")), "near-kept")
    several = least.join(stay.where("n > 1").select("root"), "root", "left_semi")
    if not several.isEmpty():  # one id with several texts of a group
        chosen = (marked.select("id", "node", F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text")).join(several, ["id", "node"])
                  .groupBy("root", "id").agg(F.min_by("node", "text").alias("node")))
        stay = stay.where("n = 1").select("id", "node").unionByName(chosen.select("id", "node"))
    found = marked.join(stay.select("id", "node"), ["id", "node"], "left_semi")
    return found.dropDuplicates(["id", "node"]).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that the sources reach their target weights."""
    whole = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    mixed = mixing.mix(whole, carry=("row",))
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, and the shard and slot of each row; shards are runs by doc_id of near-equal bytes."""
    return sharding.contiguous_shards(docs, N_SHARDS, sharding.text_bytes(), ["doc_id"])


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_dedup), ("decontamination", decontaminate),
          ("mixing", mix_sources), ("sharding", shard)]

ORACLE_SQL = None  # alignment and covering hashes have no SQL form; tests/llm compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
