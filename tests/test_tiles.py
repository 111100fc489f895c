"""Array frames against the row form of regridding."""

import math
import random

import pytest
from pyspark.sql import functions as F

from check_queries import plan_of
from terralattice.operators import regrid as R, tiles as Ti, weights as W

NX, NY = 11, 7


def fine_targets(spark):
    """Targets at quarter-pixel steps, some outside."""
    df = spark.range(29 * 45)
    i, j = F.floor(F.col("id") / 45), F.col("id") % 45
    return df.select(F.col("id").alias("target_id"), (0.25 * i - 0.5).alias("ty"), (0.25 * j - 0.5).alias("tx"))


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(1)
    def value(k):
        return rng.choice([math.nan, None, *[rng.uniform(200, 300)] * 9])
    rows = [(k, "a" if k % 2 else None, [value(k) for _ in range(NX * NY)], [rng.choice([0, 1, 2, 3, None, 0, 0, 0]) for _ in range(NX * NY)]) for k in range(5)]
    return spark.createDataFrame(rows, "id long, slot string, cmi array<float>, dqf array<short>")


def flat(df, keys):
    return {tuple(r[k] for k in (*keys, "target_id")): (None if math.isnan(r["cmi"]) else round(r["cmi"], 6), r["dqf"]) for r in df.collect()}


@pytest.mark.parametrize("tile, strict, limit", [(3, False, 1 << 16), (4, True, 7), (64, False, 100)])
def test_tiles_equal_rows(spark, frames, monkeypatch, tile, strict, limit):
    monkeypatch.setattr(Ti, "TARGETS", limit)
    targets = fine_targets(spark)
    w = W.lattice_weights(targets, "tx", "ty", NX, NY).cache()
    keys = ["id", "slot"]
    pixels = frames.select(*keys, F.posexplode(F.arrays_zip("cmi", "dqf")).alias("source_id", "v")).select(
        *keys, F.col("source_id").cast("long").alias("source_id"), "v.cmi", "v.dqf")
    want = flat(R.regrid(pixels, w, keys, ["cmi"], ["dqf"], strict=strict), keys)
    packed = Ti.pack_weights(w, NX, tile)
    done = Ti.regrid_tiles(Ti.array_tiles(frames, keys, ["cmi", "dqf"], NX, NY, tile), packed, keys, ["cmi"], ["dqf"], strict)
    assert flat(Ti.tile_rows(done, keys, ["cmi", "dqf"]), keys) == want
    whole = Ti.regrid_arrays(frames, packed, keys, ["cmi"], ["dqf"], NX, NY, targets.count(), tile, strict)
    everything = flat(whole.select(*keys, F.posexplode(F.arrays_zip("cmi", "dqf")).alias("target_id", "v")).select(*keys, "target_id", "v.cmi", "v.dqf"), keys)
    assert {k: v for k, v in everything.items() if k in want} == want
    assert set(v for k, v in everything.items() if k not in want) == {(None, 3)} and len(everything) == 5 * targets.count()


def test_odd_array_frames(spark, frames):
    w = W.lattice_weights(fine_targets(spark), "tx", "ty", NX, NY)
    packed = Ti.pack_weights(w, NX, 4)
    void = frames.limit(1).withColumn("cmi", F.lit(None).cast("array<double>")).withColumn("dqf", F.lit(None).cast("array<short>"))
    out = Ti.tile_rows(Ti.regrid_tiles(Ti.array_tiles(void, ["id"], ["cmi", "dqf"], NX, NY, 4), packed, ["id"], ["cmi"], ["dqf"]), ["id"], ["cmi", "dqf"])
    assert {(math.isnan(r["cmi"]), r["dqf"]) for r in out.collect()} == {(True, 6)}
    assert Ti.regrid_arrays(frames.limit(0), packed, ["id"], ["cmi"], ["dqf"], NX, NY, 9, 4).isEmpty()
    with pytest.raises(Exception, match="7 x 11 values"):
        Ti.array_tiles(frames.withColumn("cmi", F.slice("cmi", 1, 5)), ["id"], ["cmi"], NX, NY, 4).collect()


def test_a_row_per_tile_is_moved(spark, frames):
    w = W.lattice_weights(fine_targets(spark), "tx", "ty", NX, NY)
    tiles = Ti.array_tiles(frames, ["id"], ["cmi"], NX, NY, 4)
    assert tiles.count() == 5 * 3 * 2 and "Exchange" not in plan_of(tiles)
    assert max(r["n"] for r in tiles.select(F.size("cmi").alias("n")).collect()) == 25
