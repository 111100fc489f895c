"""Incremental gridding and catalog growth with Structured Streaming.

The batch transforms are reused unchanged inside `foreachBatch`; a micro-batch
is one Spark job over all its frames and bands. A batch that is replayed after a
failure adds nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from terralattice import session
from terralattice.operators import store, validate
from terralattice.operators.groups import join_by
from terralattice.sources import tables
from terralattice.sinks import tables as sinks


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def deduplicated(stream: DataFrame, keys: list[str], time: str, lateness: str) -> DataFrame:
    """First row per key; the watermark only bounds how long keys are remembered."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what has arrived, then stop; the next call goes on from there."""
    query = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def grow_catalog(stream: DataFrame, path: str, checkpoint: str, keys: list[str], by: str | None = None) -> StreamingQuery:
    """Append each new catalog record once; with `by`, a batch reads only the partitions it concerns."""
    return run_available(stream, checkpoint, lambda batch, _: sinks.append_new(batch, path, keys, by=by))


def grid_frames(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], error: Callable[[DataFrame], DataFrame],
                path: str, log_path: str, checkpoint: str, frame: list[str], expected_pixels: int | None = None,
                pixel: str = "source_id", strict: bool = False) -> StreamingQuery:
    """Regrid arriving frames; frames that break a rule go to the run log instead.

    `error(batch)` adds `error_message`, null for good rows; one bad row fails
    its frame, and with `strict` the batch. A frame is taken up once it has `expected_pixels` different pixels
    (without that number, as it comes): until then its pixels wait in a table
    beside the log, which each batch writes anew, and join those that follow. More
    pixels than expected fail the frame.

    Every micro-batch writes a folder of its own, named by the query's id in the
    checkpoint and the batch, so a replay replaces it; a query that has lost its
    checkpoint has another id and takes up only frames that the log does not call
    done. The gridded rows are never read back.
    """
    waiting = f"{log_path.rstrip('/')}-waiting"

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"run={_query_id(spark, checkpoint)}/batch={batch_id}"
        earlier = _earlier(spark, log_path, own)
        arrived = batch
        if expected_pixels is not None:
            for folder in _last_folders(spark, waiting, own):
                arrived = arrived.unionByName(spark.read.schema(batch.schema).parquet(folder))
        if earlier is not None:
            arrived = _without(arrived, earlier.where(F.col("status") == "done"), frame)
        if expected_pixels is not None:  # also where replays and pixels that waited repeat each other
            arrived = session.materialize(arrived.dropDuplicates([*frame, pixel]), "arrived")
        checked = error(arrived)
        states = checked.groupBy(*frame).agg(F.max("error_message").alias("error"), F.count(F.lit(1)).alias("_n"))
        if expected_pixels is not None:
            early = states.where(F.col("error").isNull() & (F.col("_n") < expected_pixels))
            join_by(arrived, early.select(*frame, F.lit(1).alias("_early")), frame).drop("_early").write.mode("overwrite").parquet(f"{waiting}/{own}")
            over = F.when(F.col("_n") > expected_pixels, "Unexpected frame shape")
            states = states.withColumn("error", F.coalesce("error", over)).where(F.col("error").isNotNull() | (F.col("_n") == expected_pixels))
        if strict:
            validate.require_none(states.where(F.col("error").isNotNull()), "a frame failed")
        _write(arrived, states.drop("_n"), earlier, transform, path, log_path, own, frame)
    return run_available(stream, checkpoint, each)


def retry_frames(pixels: DataFrame, transform: Callable[[DataFrame], DataFrame], error: Callable[[DataFrame], DataFrame],
                 path: str, log_path: str, frame: list[str], max_retries: int = 1) -> None:
    """Grid once more the frames that have failed at most `max_retries` times and were never done.

    `pixels` hold those frames in whole; others are left out. Attempts are counted
    on in the log. Each call writes a folder of its own.
    """
    spark = pixels.sparkSession
    if not session.child_names(spark, log_path):
        return
    log = spark.read.parquet(log_path)
    tried = log.groupBy(*frame).agg(F.count_if(F.col("status") == "failed").alias("_f"), F.count_if(F.col("status") == "done").alias("_d"))
    eligible = session.materialize(tried.where((F.col("_d") == 0) & (F.col("_f") <= max_retries)).select(*frame), "retries")
    arrived = join_by(pixels, eligible.withColumn("_again", F.lit(1)), frame).drop("_again")
    states = error(arrived).groupBy(*frame).agg(F.max("error_message").alias("error"))
    own = f"run=retry/batch={len(session.child_names(spark, f'{log_path}/run=retry'))}"
    _write(arrived, states, log, transform, path, log_path, own, frame)


def _write(arrived: DataFrame, states: DataFrame, earlier: DataFrame | None, transform: Callable[[DataFrame], DataFrame],
           path: str, log_path: str, own: str, frame: list[str]) -> None:
    """Gridded rows of the good frames first, then the log, which makes them count."""
    good = states.where(F.col("error").isNull()).select(*frame, F.lit(1).alias("_good"))
    transform(join_by(arrived, good, frame).drop("_good")).write.mode("overwrite").parquet(f"{path}/{own}")
    logged = session.materialize(_log_states(states, earlier, frame), "states")  # read before the log is written to
    logged.write.mode("overwrite").parquet(f"{log_path}/{own}")


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint; another checkpoint, another id."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _earlier(spark: SparkSession, log_path: str, own: str) -> DataFrame | None:
    """The log without what this very batch may have written before a failure."""
    if not session.child_names(spark, log_path):
        return None
    run, batch = (part.split("=")[1] for part in own.split("/"))
    return spark.read.parquet(log_path).where(~((F.col("run") == run) & (F.col("batch") == int(batch))))


def _last_folders(spark: SparkSession, path: str, own: str) -> list[str]:
    """Per query, the folder of its last batch before this one: one name per batch is listed."""
    run, batch = own.split("/")
    found = []
    for name in session.child_names(spark, path):
        batches = [int(b.removeprefix("batch=")) for b in session.child_names(spark, f"{path}/{name}") if b.startswith("batch=")]
        before = [b for b in batches if name != run or b < int(batch.removeprefix("batch="))]
        if before:
            found.append(f"{path}/{name}/batch={max(before)}")
    return found


def _without(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of groups that are not known; missing key parts are equal."""
    return join_by(rows, known.select(*keys).distinct().withColumn("_known", F.lit(1)), keys, "left").where("_known is null").drop("_known")


def _log_states(states: DataFrame, earlier: DataFrame | None, frame: list[str]) -> DataFrame:
    """Run-log rows of one batch; attempts count on from earlier batches."""
    attempt = F.lit(1)
    if earlier is not None:
        tried = earlier.groupBy(*frame).agg(F.max("attempt").alias("_tried"))
        states = join_by(states, tried, frame, "left")
        attempt = F.coalesce("_tried", F.lit(0)) + 1
    status = F.when(F.col("error").isNull(), "done").otherwise("failed")
    return states.select(
        *frame, F.concat_ws("/", *[F.col(c).cast("string") for c in frame]).alias("observation_id"),
        attempt.cast("int").alias("attempt"), status.alias("status"), "error", F.current_timestamp().alias("ts"))


def split_late(batch: DataFrame, stored_last: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Mark rows not after the last stored time of their key; a missing key is a key."""
    joined = join_by(batch, stored_last.select(*keys, F.col("last_time").alias("_last")), keys, "left")
    return joined.withColumn("late", F.coalesce(F.col(time) <= F.col("_last"), F.lit(False))).drop("_last")


def finalize(spark: SparkSession, path: str, keys: list[str], time: str = "time", message: str = "finalized") -> None:
    """Closing job: keeps the coverage of each region as stored now, and a line of history."""
    coverage = store.time_coverage(tables.open_region(spark, path), keys, time, time)
    coverage.write.mode("overwrite").parquet(f"{path}/_region/coverage")
    sinks.append_history(spark, path, message)
