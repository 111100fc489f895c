"""Axes, grids, projection and fixed-grid weights."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terralattice.functions import projection as P, scalars as S
from terralattice.operators import grid as G, weights as W

SPEC = "axis_id int, lon_min double, lon_max double, lat_min double, lat_max double, resolution double"


def lon_axis(spark, lo, hi, step):
    df = spark.createDataFrame([(0, lo, hi, 0.0, 0.0, step)], SPEC)
    return [r["lon"] for r in G.longitude_axis(df, ["axis_id"]).orderBy("idx").collect()]


def test_plain_axis(spark):
    got = lon_axis(spark, -10.0, 10.0, 0.25)
    assert got == list(np.round(np.arange(-10.0, 10.25, 0.25), 4))


def test_axis_overshoots_like_arange(spark):
    assert lon_axis(spark, -60.0, 60.0, 0.02)[-1] == np.round(np.arange(-60.0, 60.02, 0.02), 4)[-1]


def test_crossing_axis(spark):
    got = lon_axis(spark, 165.0, -115.0, 0.5)
    raw = np.round(np.arange(165.0, 245.5, 0.5), 4)
    assert got == list(np.round((raw + 180) % 360 - 180, 4))
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(got)], "axis_id int, idx int, lon double")
    row = G.axis_checks(df, ["axis_id"], "idx", "lon").first()
    assert row["crossing"] and row["valid"] and not row["monotonic"]


def test_inverted_range_is_empty(spark):
    assert lon_axis(spark, -60.0, -120.0, 0.5) == []


def test_single_value_axis_is_valid(spark):
    df = spark.createDataFrame([(0, 0, 5.0)], "axis_id int, idx int, lon double")
    row = G.axis_checks(df, ["axis_id"], "idx", "lon").first()
    assert row["valid"] and not row["crossing"]


def test_product_grid_is_row_major(spark):
    df = spark.createDataFrame([(0, -1.0, 1.0, 10.0, 11.0, 0.5)], SPEC)
    rows = G.product_grid(df, ["axis_id"]).orderBy("target_id").collect()
    assert [r["target_id"] for r in rows] == list(range(len(rows)))
    n_lon = len({r["ilon"] for r in rows})
    assert all(r["target_id"] == r["ilat"] * n_lon + r["ilon"] for r in rows)


def test_require_rows(spark):
    points = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
    assert G.require_rows(G.within_bounds(points, 0, 5, 0, 5), "none").count() == 1
    with pytest.raises(ValueError, match="none"):
        G.require_rows(G.within_bounds(points, 50, 55, 0, 5), "none")


def test_projection_spot_value(spark):
    lat, lon = P.scan_to_latlon(F.lit(-0.024052), F.lit(0.095340), P.Projection())
    row = spark.range(1).select(lat.alias("lat"), lon.alias("lon")).first()
    assert row["lat"] == pytest.approx(33.846162, abs=1e-6)
    assert row["lon"] == pytest.approx(-84.690932, abs=1e-6)


@pytest.mark.parametrize("origin", [-75.0, -137.2, 140.7])
def test_projection_round_trip(spark, origin):
    p = P.Projection(lon_origin=origin)
    angles = spark.range(301 * 301).select(((F.col("id") % 301 - 150) / 1000.0).alias("x"),
                                           ((F.floor(F.col("id") / 301) - 150) / 1000.0).alias("y"))
    lat, lon = P.scan_to_latlon(F.col("x"), F.col("y"), p)
    ll = angles.select("x", "y", lat.alias("lat"), lon.alias("lon")).where(~F.isnan("lat"))
    bx, by, seen = P.latlon_to_scan(F.col("lat"), F.col("lon"), p)
    row = ll.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(bx - F.col("x"))).alias("ex"),
                 F.max(F.abs(by - F.col("y"))).alias("ey"), F.bool_and(seen).alias("seen"),
                 F.min("lon").alias("lo"), F.max("lon").alias("hi")).first()
    assert row["ex"] < 1e-12 and row["ey"] < 1e-12 and row["seen"]
    assert 0.78 < row["n"] / 301 ** 2 < 0.81 and row["lo"] >= -180 and row["hi"] < 180


@pytest.mark.parametrize("dy,y0", [(-0.001, 0.15), (0.001, -0.15)])
def test_fixed_grid_weights_reproduce_the_target(spark, dy, y0):
    p = P.Projection()
    lattice = W.Lattice(301, 301, -0.15, y0, 0.001, dy)
    spots = spark.range(2000).select(F.col("id").alias("target_id"), ((F.col("id") * 37 % 1000) / 10.0 - 50).alias("lat"),
                                     ((F.col("id") * 53 % 1000) / 10.0 - 125).alias("lon"))
    w = W.geostationary_weights(spots, lattice, p)
    x = F.lit(lattice.x0) + (F.col("source_id") % 301) * lattice.dx
    y = F.lit(lattice.y0) + F.floor(F.col("source_id") / 301) * lattice.dy
    lat, lon = P.scan_to_latlon(x, y, p)
    back = (w.withColumn("slat", lat).withColumn("slon", lon).groupBy("target_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("s"), F.min("w").alias("lo"),
                 F.sum(F.col("w") * F.col("slat")).alias("blat"), F.sum(F.col("w") * F.col("slon")).alias("blon")))
    rows = back.join(spots, "target_id").collect()
    assert len(rows) > 1900
    for r in rows:
        assert r["n"] == 3 and abs(r["s"] - 1) < 1e-12 and r["lo"] >= -1.1e-9
        assert math.isclose(r["blat"], r["lat"], abs_tol=1e-7) and math.isclose(r["blon"], r["lon"], abs_tol=1e-7)


@pytest.mark.parametrize("value,places,want", [(2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (-2.5, 0, -2.0)])
def test_round_half_even(spark, value, places, want):
    assert spark.range(1).select(S.round_half_even(F.lit(value), places)).first()[0] == want == np.round(value, places)
