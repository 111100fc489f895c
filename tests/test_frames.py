"""Streams into the region store: state, timers, late pixels, replays."""

import pytest
from pyspark.sql import functions as F

from terralattice import schemas, session
from terralattice.sinks import tables as sinks
from terralattice.sources import tables as T
from terralattice.streaming import frames as Fr, ingest

N = 10  # pixels of a frame
PIXELS = "orbital_slot string, obs_date date, time timestamp, source_id long, cmi_c02 double"


def pixels(spark, minutes, ids=range(N), slot="GOES-East", value=1.0):
    df = spark.createDataFrame([(m, i) for m in minutes for i in ids], "m long, source_id long")
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("m") * 60)
    return df.select(F.lit(slot).cast("string").alias("orbital_slot"), time.cast("date").alias("obs_date"), time.alias("time"), "source_id", F.lit(value).alias("cmi_c02"))


def gridded(px):
    return sinks.stored_rows(px.select("orbital_slot", "time", F.col("source_id").alias("target_id"), F.lit("G16").alias("platform_id"), F.lit(None).cast("string").alias("scan_mode"),
                                       F.lit(0).alias("ilat"), F.col("source_id").alias("ilon"), "cmi_c02", F.lit(0).alias("dqf_c02")), [2])


@pytest.fixture
def world(spark, tmp_path):
    """Arrivals, a region, and a run over what has arrived."""
    src, region, base = (str(tmp_path / n) for n in ("in", "region", "base"))
    schema = schemas.gridded([2])
    sinks.create_store(spark, region, [2])

    class World:
        def arrive(self, df):
            df.coalesce(1).write.mode("append").parquet(src)

        def run(self, checkpoint="ck", block=4, max_files=None, transform=gridded):
            stream = ingest.file_stream(spark, src, spark.read.schema(PIXELS).parquet(src).schema, max_files)
            bad = lambda df: df.withColumn("error_message", F.when(F.col("cmi_c02") < 0, "negative"))
            Fr.ingest_frames(stream, transform, bad, region, schema, base, str(tmp_path / checkpoint), N, "30 minutes", block, max_files)

        def minute(self, t):
            return int((t.timestamp() - 1704067200) // 60)

        def stored(self):
            return {(r["orbital_slot"], self.minute(r["time"])): r["n"] for r in T.open_region(spark, region).groupBy("orbital_slot", "time").agg(F.count("*").alias("n")).collect()}

        def log(self):
            return {(r["orbital_slot"], self.minute(r["time"])): r["error"] or r["status"] for r in Fr.frame_log(spark, base).collect()}

        def late(self):
            return {(r["orbital_slot"], self.minute(r["time"]), r["source_id"]) for r in Fr.late_pixels(spark, base, schemas_of(spark)).collect()}
    return World()


def schemas_of(spark):
    return spark.createDataFrame([], PIXELS).schema


EAST = "GOES-East"


def test_frames_in_parts_expire_or_are_gridded_once(spark, world):
    world.arrive(pixels(spark, [0, 10], range(6)))
    world.arrive(pixels(spark, [0, 20], range(4, N)))  # two pixels of frame 0 come twice
    world.arrive(pixels(spark, [5], slot=None))
    world.arrive(pixels(spark, [15], range(N + 1)))
    world.run()
    assert world.stored() == {(EAST, 0): N, (None, 5): N} and world.log() == {(EAST, 0): "done", (None, 5): "done", (EAST, 15): "Unexpected frame shape"}
    world.run()
    assert world.stored() == {(EAST, 0): N, (None, 5): N}
    world.arrive(pixels(spark, [20], range(4)))  # goes on after a restart
    world.arrive(pixels(spark, [100], value=-1.0))  # closes what is more than 30 minutes older
    world.run()
    done = {(EAST, 0): N, (None, 5): N, (EAST, 20): N}
    assert world.stored() == done and world.log()[EAST, 100] == "negative"
    world.arrive(pixels(spark, [10], range(6, N)))  # late: its frame was closed
    world.arrive(pixels(spark, [0, 30], range(2)))  # done before, and never seen before its time was up
    world.arrive(pixels(spark, [140]))
    world.run()
    assert world.log()[EAST, 10] == "Incomplete frame" and world.stored() == done | {(EAST, 140): N}
    assert world.late() == {(EAST, 10, i) for i in range(6, N)} | {(EAST, 30, i) for i in range(2)}


def test_a_lost_checkpoint_and_a_replay_add_nothing(spark, world):
    world.arrive(pixels(spark, [0, 10]))
    world.arrive(pixels(spark, [20], range(3)))

    def broken(px):
        raise RuntimeError("stopped")
    with pytest.raises(Exception, match="stopped"):
        world.run(transform=broken)
    world.run()
    both = {(EAST, 0): N, (EAST, 10): N}
    assert world.stored() == both
    world.arrive(pixels(spark, [20], range(3, N)))
    world.run(checkpoint="other", max_files=1)
    assert world.stored() == both | {(EAST, 20): N} and set(world.log().values()) == {"done"}


def test_state_ends_with_its_frame(spark, world):
    """Blocks of closed frames leave the state; only open ones stay."""
    from pyspark.sql.streaming import StreamingQuery
    kept = []
    note = Fr._note_watermark
    Fr._note_watermark = lambda s, query, base: (kept.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]), note(s, query, base))
    try:
        for hour in range(3):
            world.arrive(pixels(spark, [60 * hour + m for m in (0, 10, 20)]))
            world.run()
    finally:
        Fr._note_watermark = note
    blocks = 3  # of four pixels, of the ten
    assert all(rows[-1] <= 3 * blocks for rows in kept) and isinstance(kept[0], list) and StreamingQuery


def test_whole_blocks_of_a_date_lie_in_one_file(spark, world, tmp_path):
    world.arrive(pixels(spark, range(0, 50, 10)))
    world.run()
    assert world.stored() == {(EAST, m): N for m in range(0, 50, 10)}
    assert len(list((tmp_path / "base" / "blocks").glob("obs_date=*/*.parquet"))) == 1
