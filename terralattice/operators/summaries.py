"""Catalog summaries that are kept, not computed anew: a small partial result per batch, folded on read.

A batch of scanned files leaves one row per platform, slot, scene and verdict. Rows
of any batches can be added up, so totals, breakdown and coverage of a catalog read a
few rows per batch and never the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralattice import session
from terralattice.functions import scalars as S

_NAMES = ["platform_id", "orbital_slot", "scene_id"]
_GROUP = [*_NAMES, "valid"]
PARTS = ("platform_id string, orbital_slot string, scene_id string, valid boolean, files long, earliest timestamp_ntz, latest timestamp_ntz, size_mb double")


def parts(scanned: DataFrame) -> DataFrame:
    """Partial results of scanned files: mergeable counts, ends and sums."""
    return scanned.groupBy(*_NAMES, F.col("error_message").isNull().alias("valid")).agg(
        F.count(F.lit(1)).alias("files"), F.min("time_coverage_start").alias("earliest"), F.max("time_coverage_end").alias("latest"),
        F.coalesce(F.sum("file_size_mb"), F.lit(0.0)).alias("size_mb"))


def add_batch(scanned: DataFrame, path: str, batch: str) -> None:
    """Keep the partial results of a batch; the same batch again, replayed or replaced, takes the place of the first."""
    parts(scanned).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def folded(spark: SparkSession, path: str, batches: list[str] | None = None) -> DataFrame:
    """Partial results of all committed batches, or of those named, added up."""
    names = [f"batch={b}" for b in batches] if batches is not None else [n for n in session.child_names(spark, path) if n.startswith("batch=")]
    done = [f"{path}/{n}" for n in names if "_SUCCESS" in session.child_names(spark, f"{path}/{n}")]
    if not done:
        return spark.createDataFrame([], PARTS)
    return spark.read.parquet(*done).groupBy(*_GROUP).agg(
        F.sum("files").alias("files"), F.min("earliest").alias("earliest"), F.max("latest").alias("latest"), F.sum("size_mb").alias("size_mb"))


def compact(spark: SparkSession, path: str, batches: list[str]) -> None:
    """One batch, the last of `batches`, in place of several. Not to be run beside readers or writers."""
    into = batches[-1]
    whole = session.materialize(folded(spark, path, batches), "summary")
    whole.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={into}")
    for b in batches:
        if b != into:
            session.remove(spark, f"{path}/batch={b}")


def totals(kept: DataFrame) -> DataFrame:
    """As `catalog.totals`, from partial results."""
    ok = F.col("valid")
    return kept.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("total_scanned"), F.coalesce(F.sum(F.when(ok, F.col("files"))), F.lit(0)).alias("valid_files"),
        F.coalesce(F.sum(F.when(~ok, F.col("files"))), F.lit(0)).alias("invalid_files"),
        F.min(F.when(ok, F.col("earliest"))).alias("earliest"), F.max(F.when(ok, F.col("latest"))).alias("latest"),
        S.mib_to_gib(F.coalesce(F.sum(F.when(ok, F.col("size_mb"))), F.lit(0.0))).alias("total_size_gb"))


def breakdown(kept: DataFrame) -> DataFrame:
    """As `catalog.breakdown`, from partial results."""
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value")) for c in _NAMES])
    return (kept.where("valid").select("files", F.inline(pairs)).where(F.col("value").isNotNull())
            .groupBy("attribute", "value").agg(F.sum("files").alias("files")))


def coverage(kept: DataFrame) -> DataFrame:
    """Per slot the first start and last end of all files, whatever their verdict, as `store.time_coverage` gives."""
    return kept.groupBy("orbital_slot").agg(F.min("earliest").alias("coverage_start"), F.max("latest").alias("coverage_end"))
