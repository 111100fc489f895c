"""Summaries and attributes of a gridded store's regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terralattice.functions import scalars as S
from terralattice.operators.groups import join_by


def time_coverage(df: DataFrame, keys: list[str], start: str = "time", end: str = "time") -> DataFrame:
    """First start, last end and the seconds between them."""
    cover = df.groupBy(*keys).agg(F.min(start).alias("coverage_start"), F.max(end).alias("coverage_end"))
    micros = S.micros("coverage_end") - S.micros("coverage_start")
    return cover.withColumn("duration_seconds", micros / 1e6)


def observation_count(df: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(time).alias("observations"))


def platforms(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct platforms of each region, one row per platform."""
    return df.select(*keys, "platform_id").where(F.col("platform_id").isNotNull()).distinct()


def source_files(existing: DataFrame, new: DataFrame, keys: list[str], path: str = "file_path") -> DataFrame:
    """Distinct union of a region's source files; rows, so a region may have any number."""
    return existing.select(*keys, path).unionByName(new.select(*keys, path)).distinct()


def source_file_count(files: DataFrame, keys: list[str]) -> DataFrame:
    return files.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_file_count"))


def region_shape(gridded: DataFrame, keys: list[str]) -> DataFrame:
    return gridded.groupBy(*keys).agg(F.countDistinct("ilat").alias("n_lat"), F.countDistinct("ilon").alias("n_lon"))


def region_attributes(extent: DataFrame, lat_resolution: DataFrame, lon_resolution: DataFrame,
                      keys: list[str]) -> DataFrame:
    """Geospatial attribute rows (key, value) of each region."""
    lats = lat_resolution.select(*keys, F.col("resolution").alias("lat_resolution"))
    lons = lon_resolution.select(*keys, F.col("resolution").alias("lon_resolution"))
    joined = join_by(join_by(extent, lats, keys), lons, keys)
    fields = ("lat_min", "lat_max", "lon_min", "lon_max", "lat_resolution", "lon_resolution")
    pairs = F.array(*[F.struct(F.lit(f"geospatial_{c}").alias("key"), F.col(c).alias("value")) for c in fields])
    return joined.select(*keys, F.inline(pairs))


def estimate_size(frames: DataFrame, cells: int, bands: int, compression: float = 4.0) -> DataFrame:
    """Size estimate in GiB from a frame count: float CMI plus one-byte flags."""
    total = frames.agg(F.count(F.lit(1)).alias("timesteps"))
    raw = F.col("timesteps") * F.lit(float(bands) * cells * 5)
    packed = raw / compression / 1024.0 ** 3
    return total.select("timesteps", (raw / 1024.0 ** 3).alias("uncompressed_gb"), packed.alias("compressed_gb"),
                        F.lit(compression).alias("compression_ratio"),
                        (packed / bands if bands else F.lit(0.0)).alias("per_band_gb"))


def set_attributes(current: DataFrame, changes: DataFrame, merge: bool = True) -> DataFrame:
    """Merge or replace the attribute maps of nodes: (node_path, attrs)."""
    fresh = changes.select("node_path", F.col("attrs").alias("_new"))
    joined = current.join(fresh, "node_path", "full")
    empty = F.create_map().cast("map<string,string>")
    old, new = F.coalesce("attrs", empty), F.col("_new")
    merged = S.merge_maps(old, F.coalesce(new, empty)) if merge else F.coalesce(new, old)
    return joined.select("node_path", merged.alias("attrs"))


def delete_attributes(current: DataFrame, keys: list[str]) -> DataFrame:
    return current.withColumn("attrs", S.drop_map_keys(F.col("attrs"), keys))


def history_line(ts: Column, message: Column) -> Column:
    """One line of processing history, ISO-8601 UTC time first."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit(": "), message)
