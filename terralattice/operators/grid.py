"""Target axes and grids, generated row by row from axis parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terralattice.functions import scalars as S
from terralattice.operators import ordering


def axis_length(start: Column, stop: Column, step: Column) -> Column:
    """Number of points in [start, stop) by step; zero when the range is empty."""
    return F.greatest(F.lit(0), F.ceil((stop - start) / step)).cast("long")


def _points(specs: DataFrame, keys: list[str], size: Column) -> DataFrame:
    return (specs.withColumn("_size", size).where(F.col("_size") > 0)
            .withColumn("idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_size") - 1)))
            .drop("_size"))


def _longitudes(step: Column) -> dict[str, Column]:
    """Start, end and kind of a longitude axis; lon_min > lon_max crosses the antimeridian and runs in 0..360."""
    lo, hi = F.col("lon_min"), F.col("lon_max")
    crossing = lo > hi
    return {"_start": F.when(crossing, S.floor_mod(lo, 360.0)).otherwise(lo),
            "_stop": F.when(crossing, S.floor_mod(hi, 360.0)).otherwise(hi) + step, "_crossing": crossing}


def _longitude(idx: Column, step: Column, decimals: int) -> Column:
    """A longitude by its number on the axis, brought back to -180..180."""
    raw = S.round_half_even(F.col("_start") + idx * step, decimals)
    back = S.round_half_even(S.floor_mod(raw + 180.0, 360.0) - 180.0, decimals)
    return F.when(F.col("_crossing"), back).otherwise(raw)


def longitude_axis(specs: DataFrame, keys: list[str], decimals: int = 4) -> DataFrame:
    """Longitudes of every axis in `specs(keys, lon_min, lon_max, resolution)`.

    lon_min > lon_max crosses the antimeridian: the axis runs in 0..360 and is
    brought back to -180..180. The last point may pass lon_max by one step.
    """
    step = F.col("resolution")
    ranged = specs.withColumns(_longitudes(step))
    points = _points(ranged, keys, axis_length(F.col("_start"), F.col("_stop"), step))
    return points.select(*keys, "idx", _longitude(F.col("idx"), step, decimals).alias("lon"))


def automatic_bounds(locations: DataFrame, keys: list[str], decimals: int = 4) -> DataFrame:
    """Bounds of a grid over located source pixels (keys, lat, lon): their least and greatest values, rounded.

    Pixels off the disk, with a null or NaN place, are left out; a group of such
    pixels only has null bounds.
    """
    seen = locations.where(~F.isnan("lat") & ~F.isnan("lon"))
    rounded = [S.round_half_even(f(c).cast("double"), decimals).alias(f"{c}_{n}")
               for c in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))]
    return seen.groupBy(*keys).agg(*rounded)


def latitude_axis(specs: DataFrame, keys: list[str], decimals: int | None = None) -> DataFrame:
    """Latitudes of every axis in `specs(keys, lat_min, lat_max, resolution)`.

    Explicit bounds are not rounded; automatic ones pass `decimals`.
    """
    lo, step = F.col("lat_min"), F.col("resolution")
    points = _points(specs, keys, axis_length(lo, F.col("lat_max") + step, step))
    lat = lo + F.col("idx") * step
    return points.select(*keys, "idx", (lat if decimals is None else S.round_half_even(lat, decimals)).alias("lat"))


def product_grid(specs: DataFrame, keys: list[str], decimals: int = 4) -> DataFrame:
    """All (lat, lon) points of each grid, numbered row-major; grids may cross the antimeridian.

    `specs(keys, lat_min, lat_max, lon_min, lon_max, resolution)`; a column
    `lon_resolution` gives longitudes a step of their own. The rows of a
    grid are spread out before the longitudes are generated under each of them,
    so no pair of tables is joined and one grid does not sit in one task.
    """
    step = F.col("lon_resolution") if "lon_resolution" in specs.columns else F.col("resolution")
    ranged = specs.withColumn("_step", step).withColumns(_longitudes(F.col("_step")))
    sized = ranged.withColumn("n_lon", axis_length(F.col("_start"), F.col("_stop"), F.col("_step"))).where(F.col("n_lon") > 0)
    lats = latitude_axis(sized, [*keys, "_start", "_crossing", "_step", "n_lon"], decimals).withColumnRenamed("idx", "ilat")
    spread = lats.repartition(*keys, "ilat")
    full = spread.withColumn("ilon", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_lon") - 1)))
    return full.select(*keys, (F.col("ilat") * F.col("n_lon") + F.col("ilon")).alias("target_id"),
                       F.col("ilat").cast("int").alias("ilat"), F.col("ilon").cast("int").alias("ilon"),
                       "lat", _longitude(F.col("ilon"), F.col("_step"), decimals).alias("lon"))


def axis_resolution(axis: DataFrame, keys: list[str], idx: str, value: str) -> DataFrame:
    """Absolute mean step of each axis; the mean of steps telescopes to its ends."""
    ends = axis.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(value, idx).alias("_first"), F.max_by(value, idx).alias("_last"))
    step = F.when(F.col("n") > 1, F.abs((F.col("_last") - F.col("_first")) / (F.col("n") - 1)))
    return ends.select(*keys, "n", step.alias("resolution"))


def axis_checks(axis: DataFrame, keys: list[str], idx: str, lon: str) -> DataFrame:
    """Per axis: antimeridian crossing, plain monotonic, and valid longitude axis.

    A crossing axis must increase in 0..360; another must be strictly monotonic
    either way. Axes of one point pass.
    """
    stepped = ordering.with_previous(axis, keys, [idx], lon, "_prev")
    step = F.col(lon) - F.col("_prev")
    east = S.floor_mod(F.col(lon), 360.0) - S.floor_mod(F.col("_prev"), 360.0)
    true = F.lit(True)
    sums = stepped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or(F.coalesce(step < -180.0, F.lit(False))).alias("crossing"),
        F.bool_and(F.coalesce(step > 0, true)).alias("_up"),
        F.bool_and(F.coalesce(step < 0, true)).alias("_down"),
        F.bool_and(F.coalesce(east > 0, true)).alias("_east"))
    monotonic = F.col("_up") | F.col("_down")
    return sums.select(*keys, "n", "crossing", monotonic.alias("monotonic"),
                       F.when(F.col("crossing"), F.col("_east")).otherwise(monotonic).alias("valid"))


def extent(points: DataFrame, keys: list[str]) -> DataFrame:
    return points.groupBy(*keys).agg(
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"))


def within_bounds(points: DataFrame, lon_min: float, lon_max: float, lat_min: float, lat_max: float) -> DataFrame:
    """Points inside a closed bounding box."""
    return points.where(F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Strict mode of filters: raise when nothing is left (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(message)
    return df
