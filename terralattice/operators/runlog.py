"""Processing state as queries over an append-only run log.

`run_log(observation_id, attempt, status, error, ts)`; status is 'done' or 'failed'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terralattice.functions import scalars as S
from terralattice.operators import ordering
from terralattice.schemas import TEXT_TIMES

_FAILED = "failed"


def with_attempts(log: DataFrame, item: str = "observation_id", order: list[str] = ["ts"]) -> DataFrame:
    """Number the attempts of each item from 1."""
    placed = ordering.with_position(log, [item], order, "_pos")
    return placed.withColumn("attempt", (F.col("_pos") + 1).cast("int")).drop("_pos")


def failures(log: DataFrame, max_retries: int = 1, item: str = "observation_id") -> DataFrame:
    """Failures per item and whether it may be tried again (failures <= max_retries)."""
    counted = log.where(F.col("status") == _FAILED).groupBy(item).agg(F.count(F.lit(1)).alias("failures"))
    return counted.withColumn("retry", F.col("failures") <= max_retries)


def retry_inputs(inputs: DataFrame, log: DataFrame, max_retries: int = 1, item: str = "observation_id") -> DataFrame:
    """Inputs to run again: failed, not done since, and within max_retries."""
    eligible = failures(log, max_retries, item).where("retry").select(item)
    done = log.where(F.col("status") == "done").select(item)
    return inputs.join(eligible, item, "left_semi").join(done, item, "left_anti")


def resume_inputs(inputs: DataFrame, log: DataFrame, item: str = "observation_id") -> DataFrame:
    """Inputs not yet done."""
    return inputs.join(log.where(F.col("status") == "done").select(item), item, "left_anti")


def skip_failed(log: DataFrame) -> DataFrame:
    """The log without failures: they are left out on purpose from here on."""
    return log.where(F.col("status") != _FAILED)


def summary(log: DataFrame, item: str = "observation_id") -> DataFrame:
    """One row: processed, failed, distinct failed items, success rate, times."""
    bad = F.col("status") == _FAILED
    counted = log.agg(
        F.count_if(~bad).alias("processed_count"), F.count_if(bad).alias("failed_count"),
        F.countDistinct(F.when(bad, F.col(item))).alias("failed_items"),
        F.max(F.when(~bad, F.col(item))).alias("last_processed"),
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    rate = F.coalesce(F.try_divide(F.col("processed_count").cast("double"),
                                   F.col("processed_count") + F.col("failed_items")), F.lit(0.0))
    elapsed = (S.micros("end_time") - S.micros("start_time")) / 1e6
    return counted.withColumns({"success_rate": rate, "elapsed_seconds": elapsed})


def checkpoint(state: DataFrame) -> DataFrame:
    """A summary row as one JSON text."""
    return state.select(F.to_json(F.struct(*state.columns), TEXT_TIMES).alias("state"))


def restore(text: DataFrame, schema, column: str = "value") -> DataFrame:
    """The summary row of a checkpoint text."""
    return text.select(F.from_json(column, schema, TEXT_TIMES).alias("_s")).select("_s.*")


def batches(df: DataFrame, keys: list[str], order: list[str], interval: int = 500) -> DataFrame:
    """Number rows in time order and mark the batch each belongs to."""
    placed = ordering.with_position(df, keys, order, "time_idx")
    return placed.withColumn("batch", F.floor(F.col("time_idx") / interval)).withColumn(
        "ends_batch", F.pmod(F.col("time_idx") + 1, F.lit(interval)) == 0)


def continuity(df: DataFrame, keys: list[str], batch: str, order: str, time: str) -> DataFrame:
    """Per batch: first and last time, and whether it starts after the previous batch's last."""
    ends = df.groupBy(*keys, batch).agg(F.min_by(time, order).alias("first_time"),
                                        F.max_by(time, order).alias("last_time"))
    stepped = ordering.with_previous(ends, keys, [batch], "last_time", "previous_last")
    return stepped.withColumn("continuous", F.col("previous_last").isNull()
                              | (F.col("first_time") > F.col("previous_last")))
