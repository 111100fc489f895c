"""Streamed frames in the region store, with keyed state and timers.

Arriving pixels are landed once, in files by batch and date, and never rewritten. A
stateful query over the landed pixels keeps, per date and block of pixels, which of
them have come of each frame; a block that is whole keeps a mark only. Frames whose blocks are all
whole are read from the landed files, gridded and appended to the region. A frame
that is not whole when the watermark passes its time is closed and logged; pixels
that come later go to a table of their own. So state grows with open frames only, and
no batch reads what belongs to others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from terralattice import session
from terralattice.operators.groups import join_by
from terralattice.sinks import tables as sinks
from terralattice.streaming import ingest

FRAME = ["orbital_slot", "obs_date", "time"]
BLOCK = 1 << 20  # pixels of a frame that one key of the state tells apart, 128 KiB while they are open
_EVENTS = "orbital_slot string, obs_date date, time timestamp, block long, state string"
_LOG = "orbital_slot string, obs_date date, time timestamp, status string, error string, run string, batch long, ts timestamp"


def ingest_frames(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], error: Callable[[DataFrame], DataFrame], region: str, schema: T.StructType,
                  base: str, checkpoint: str, expected_pixels: int, patience: str = "1 hour", block: int = BLOCK, max_files: int | None = None) -> None:
    """Take up what has arrived: land it, grid the frames that are whole, close those that waited in vain.

    `stream` has orbital_slot, obs_date, time and source_id (0 to expected_pixels - 1),
    beside the bands. `error(pixels)` adds `error_message`, null for good rows; one bad
    row fails its frame. `transform` gives rows of the region's `schema`. A frame
    waits until a frame `patience` younger has come. Pixels that come twice count
    once; one outside the expected range fails its frame.

    Below `base` lie landed (by run, batch and date), late (pixels of closed frames),
    blocks (whole blocks by date) and log (a row per frame, by date). A replayed
    batch replaces its landed files and finds its frames in log and region; a lost
    checkpoint lands anew only what is not done.
    """
    spark = stream.sparkSession
    ingest.run_available(stream, f"{checkpoint}/land", lambda batch, n: _land(batch, base, _run(spark, f"{checkpoint}/land"), n))
    if not session.child_names(spark, f"{base}/landed"):
        return
    landed = spark.readStream.schema(_landed_schema(stream.schema))
    if max_files is not None:
        landed = landed.option("maxFilesPerTrigger", max_files)
    events = _track(landed.parquet(f"{base}/landed"), expected_pixels, patience, block)
    whole = -(-expected_pixels // block)
    pixels = spark.read.schema(_landed_schema(stream.schema)).parquet(f"{base}/landed").select(*stream.columns)
    query = ingest.run_available(events, f"{checkpoint}/track", lambda batch, n: _settle(
        batch, pixels, transform, error, region, schema, base, _run(spark, f"{checkpoint}/track"), n, whole))
    _note_watermark(spark, query, base)


def frame_log(spark: SparkSession, base: str) -> DataFrame:
    """orbital_slot, obs_date, time, status (done, failed), error: a row per frame, the done one if there is any."""
    rows = _read(spark, f"{base}/log", _LOG)
    return rows.groupBy(*FRAME).agg(F.min("status").alias("status"), F.min_by("error", "status").alias("error"))


def late_pixels(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    return _read(spark, f"{base}/late", _landed_schema(schema)).select(*schema.names)


def closed_until(spark: SparkSession, base: str):
    """The watermark reached: frames of this time and before take no more pixels. None before any."""
    return _read(spark, f"{base}/closed", "until timestamp").agg(F.max("until")).first()[0]


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if session.child_names(spark, path) else spark.createDataFrame([], schema)


def _run(spark: SparkSession, checkpoint: str) -> str:
    return ingest._query_id(spark, checkpoint)


def _landed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != "obs_date"]).add("run", "string").add("batch", "long").add("obs_date", "date")


def _of_dates(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Rows of the dates of `frames`: whole folders are left out by the join."""
    return join_by(rows, frames.select("obs_date").distinct().withColumn("_date", F.lit(1)), ["obs_date"]).drop("_date")


def _land(batch: DataFrame, base: str, run: str, number: int) -> None:
    """Pixels of open frames go to landed, those of failed or closed ones to late; frames that are done need none."""
    spark = batch.sparkSession
    frames = session.materialize(batch.select(*FRAME).distinct(), "arrived-frames")
    states = join_by(frames, _of_dates(frame_log(spark, base), frames), FRAME, "left")
    until = closed_until(spark, base)
    shut = F.lit(False) if until is None else F.col("time") <= F.lit(until)
    states = session.materialize(states.select(*FRAME, F.when(F.col("status") == "done", "done").when(F.col("status").isNotNull() | shut, "late")
                                               .otherwise("open").alias("_state")), "arrived-states")
    marked = join_by(batch, states, FRAME)
    for state, name in (("open", "landed"), ("late", "late")):
        (marked.where(F.col("_state") == state).drop("_state").write.mode("overwrite").partitionBy("obs_date").parquet(f"{base}/{name}/run={run}/batch={number}"))


def _track(landed: DataFrame, expected: int, patience: str, block: int) -> DataFrame:
    """orbital_slot, obs_date, time, block, state: whole, closed (open until its time was up) or over (pixels beyond the frame).

    A key holds the same block of a date's frames, so that small frames do not cost a call each.
    """
    def each(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number = key[2]
        size = min(block, expected - number * block)
        width = -(-max(size, 1) // 8)
        times, bits, marks = (np.frombuffer(held, kind) for held, kind in zip(state.get if state.exists else (b"",) * 3, (np.int64, np.uint8, np.bool_)))
        done = dict(zip(times.tolist(), marks.tolist()))
        opened = [t for t in done if not done[t]]
        seen = dict(zip(opened, bits.copy().reshape(len(opened), width)))
        events: list[tuple[int, str]] = []
        over: set[int] = set()
        for part in () if state.hasTimedOut else parts:
            stamps = part["time"].to_numpy().astype("datetime64[us]").astype(np.int64)
            order = np.argsort(stamps, kind="stable")
            places = part["source_id"].to_numpy()[order] - number * block
            found, first = np.unique(stamps[order], return_index=True)
            for t, at in zip(found.tolist(), np.split(places, first[1:])):
                within = (at >= 0) & (at < size)
                if not within.all():
                    over.add(t)
                if not done.setdefault(t, False):
                    at = at[within]
                    np.bitwise_or.at(seen.setdefault(t, np.zeros(width, np.uint8)), at >> 3, (1 << (at & 7)).astype(np.uint8))
        events += [(t, "over") for t in over]
        for t in [t for t in seen if size > 0 and int(np.bitwise_count(seen[t]).sum()) == size]:
            done[t] = True
            del seen[t]
            events.append((t, "whole"))
        until = state.getCurrentWatermarkMs()
        for t in [t for t in done if t // 1000 < until]:
            del done[t]
            seen.pop(t, None)
            events.append((t, "closed"))
        if done:
            state.update((np.array(list(done), np.int64).tobytes(), b"".join(seen[t].tobytes() for t in done if not done[t]), np.array(list(done.values()), np.bool_).tobytes()))
            state.setTimeoutTimestamp(min(done) // 1000)
        else:
            state.remove()
        if events:
            yield pd.DataFrame({"orbital_slot": key[0], "obs_date": key[1], "time": np.array([t for t, _ in events], "datetime64[us]").astype("datetime64[ns]"),
                                "block": number, "state": [what for _, what in events]})
    keyed = landed.withWatermark("time", patience).select(*FRAME, F.floor(F.col("source_id") / block).alias("block"), "source_id")
    return keyed.groupBy("orbital_slot", "obs_date", "block").applyInPandasWithState(
        each, _EVENTS, "times binary, seen binary, done binary", "append", GroupStateTimeout.EventTimeTimeout)


def _settle(events: DataFrame, pixels: DataFrame, transform, error, region: str, schema, base: str, run: str, number: int, whole: int) -> None:
    """Grid the frames that became whole in this batch, and log them and those closed."""
    spark = events.sparkSession
    events = session.materialize(events, "frame-events")
    if events.isEmpty():
        return
    events.where("state = 'whole'").select(*FRAME, "block").repartition("obs_date").write.mode("append").partitionBy("obs_date").parquet(f"{base}/blocks")
    touched = session.materialize(events.groupBy(*FRAME).agg(F.bool_or(F.col("state") == "closed").alias("closed"), F.bool_or(F.col("state") == "over").alias("over")), "touched")
    logged = _of_dates(frame_log(spark, base), touched).select(*FRAME, "status")
    blocks = _of_dates(_read(spark, f"{base}/blocks", "orbital_slot string, time timestamp, block long, obs_date date"), touched)
    counts = blocks.distinct().groupBy(*FRAME).agg(F.count("*").alias("n"))
    states = join_by(join_by(touched, counts, FRAME, "left"), logged, FRAME, "left").where("status is null")
    states = session.materialize(states.select(*FRAME, F.when(F.col("over"), "Unexpected frame shape").when(F.coalesce("n", F.lit(0)) == whole, "")
                                               .when(F.col("closed"), "Incomplete frame").alias("error")).where("error is not null"), "frame-states")
    ready = states.where("error = ''").select(*FRAME)
    ends = ready.agg(F.min("time"), F.max("time")).first()
    failed = states.where("error <> ''")
    if ends[0] is not None:
        own = _of_dates(pixels, ready).where(F.col("time").between(F.lit(ends[0]), F.lit(ends[1])))
        own = join_by(own, ready.withColumn("_ready", F.lit(1)), FRAME).drop("_ready").dropDuplicates([*FRAME, "source_id"])
        checked = error(own)
        bad = session.materialize(checked.groupBy(*FRAME).agg(F.max("error_message").alias("error")), "checked-frames")
        good = bad.where("error is null").select(*FRAME)
        rows = transform(join_by(checked.drop("error_message"), good.withColumn("_good", F.lit(1)), FRAME).drop("_good"))
        sinks.append_frames(rows, region, schema, good)
        failed = failed.unionByName(bad.where("error is not null")).unionByName(good.withColumn("error", F.lit(None).cast("string")))
    log = failed.select(*FRAME, F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status"), "error",
                        F.lit(run).alias("run"), F.lit(number).cast("long").alias("batch"), F.current_timestamp().alias("ts"))
    log.repartition("obs_date").write.mode("append").partitionBy("obs_date").parquet(f"{base}/log")


def _note_watermark(spark: SparkSession, query: StreamingQuery, base: str) -> None:
    """Keep the largest watermark of a run; it tells late pixels also after a restart or a lost checkpoint."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    if marks:
        spark.createDataFrame([(max(marks),)], "until string").select(F.col("until").cast("timestamp").alias("until")).where(
            "until > timestamp '1970-01-01T00:00:00Z'").write.mode("append").parquet(f"{base}/closed")
