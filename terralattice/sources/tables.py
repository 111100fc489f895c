"""Reading stored catalogs, weights and gridded tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from terralattice import schemas, session
from terralattice.schemas import TEXT_TIMES

CATALOG_SCHEMAS = {
    "observations": schemas.OBSERVATIONS,
    "band_statistics": schemas.BAND_STATISTICS,
    "data_quality": schemas.DATA_QUALITY,
    "validation_errors": schemas.VALIDATION_ERRORS,
}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything below a path; lists that one folder."""
    return bool(session.child_names(spark, path))


def open_files(spark: SparkSession, paths: list[str], preprocess=None, schema: T.StructType | None = None) -> DataFrame:
    """Pixel files as one table in one scan; bands a file lacks are null.

    With a `schema`, such as schemas.PIXELS, no footer is read to learn the
    columns; without one, all are. `preprocess(df)` is the caller's per-file hook,
    applied to all rows at once.
    """
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths)
    return df if preprocess is None else df.transform(preprocess)


def load_catalog(spark: SparkSession, directory: str, fmt: str = "parquet",
                 tables: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The catalog tables found below a directory; missing ones are empty."""
    out = {}
    for name, schema in (tables or CATALOG_SCHEMAS).items():
        path = f"{directory}/{name}"
        if not exists(spark, path):
            out[name] = spark.createDataFrame([], schema)
        elif fmt == "csv":
            out[name] = spark.read.schema(schema).options(header=True, **TEXT_TIMES).csv(path)
        else:
            out[name] = spark.read.schema(schema).parquet(path)
    return out


def load_weights(spark: SparkSession, path: str, grid_id: str | None = None) -> DataFrame:
    weights = spark.read.schema(schemas.WEIGHTS).parquet(path)
    return weights if grid_id is None else weights.where(F.col("grid_id") == grid_id)


def source_mask(spark: SparkSession, path: str, grid_id: str | None = None) -> DataFrame:
    """grid_id, source_id: the source pixels that weights were made from, as `weights.remap_compacted` asks for them."""
    mask = spark.read.schema("source_id long, grid_id string").parquet(f"{path}/_mask").select("grid_id", "source_id")
    return mask if grid_id is None else mask.where(F.col("grid_id") == grid_id)


def weights_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A row per grid of what its weights were made from."""
    return spark.read.parquet(f"{path}/_about").withColumn("grid_id", F.col("grid_id").cast("string"))


def region_attributes(spark: SparkSession, path: str) -> DataFrame:
    """What a region was declared with: key, value."""
    return spark.read.parquet(f"{path}/_region/attributes")


def region_grid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/_region/grid")


def region_coverage(spark: SparkSession, path: str) -> DataFrame:
    """Time coverage as of the last closing job."""
    return spark.read.parquet(f"{path}/_region/coverage")


def region_history(spark: SparkSession, path: str) -> DataFrame:
    """ts, message, line of all that was done to a region, in no order."""
    return spark.read.parquet(f"{path}/_region/history")


def _region_reader(spark: SparkSession, path: str):
    """A reader with the declared schema, or without one for tables written elsewhere."""
    if not exists(spark, f"{path}/_region/attributes"):
        return spark.read
    declared = region_attributes(spark, path).where(F.col("key") == "schema").first()["value"]
    return spark.read.schema(T.StructType.fromJson(json.loads(declared)))


def box_ranges(grid: DataFrame, box: tuple[float, float, float, float]) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """Index ranges (ilat, ilon) of the grid cells in a box (south, north, west, east); west over east crosses the antimeridian.

    Along each axis the cells of a box are runs; a grid that itself crosses the
    antimeridian may have them in two. Only the ends of the runs reach the driver.
    """
    south, north, west, east = box
    lon = F.col("lon")
    along = {"ilat": F.col("lat").between(south, north), "ilon": lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)}
    found = {}
    for axis, inside in along.items():
        cells = grid.where(inside).select(axis).distinct()  # one row per index of an axis
        step = F.col(axis) - F.row_number().over(W.orderBy(axis))
        runs = cells.withColumn("_run", step).groupBy("_run").agg(F.min(axis).alias("a"), F.max(axis).alias("z"))
        found[axis] = [(r["a"], r["z"]) for r in runs.orderBy("a").collect()]
    return [(lat, lon) for lat in found["ilat"] for lon in found["ilon"]]


def open_region(spark: SparkSession, path: str, columns: list[str] | None = None, start: str | None = None, end: str | None = None,
                box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """A region's table or a part of it.

    The range in time prunes date folders; the box (south, north, west, east), in the
    region's declared grid, is read as ranges of its indices, by which row groups are
    skipped, for rows are stored along a curve through the grid.
    """
    df = _region_reader(spark, path).parquet(path)
    for bound, compare in ((start, "ge"), (end, "le")):
        if bound is not None:
            stamp = F.lit(bound).cast("timestamp")
            day, time = F.col("obs_date"), F.col("time")
            df = df.where((day >= stamp.cast("date")) & (time >= stamp) if compare == "ge"
                          else (day <= stamp.cast("date")) & (time <= stamp))
    if box is not None:
        inside = F.lit(False)
        for (lat0, lat1), (lon0, lon1) in box_ranges(region_grid(spark, path), box):
            inside = inside | F.col("ilat").between(lat0, lat1) & F.col("ilon").between(lon0, lon1)
        df = df.where(inside)
    return df if columns is None else df.select(*columns)


def required_names(present: DataFrame, required: list[str], name: str = "name") -> DataFrame:
    """Required names missing from a listing."""
    wanted = present.sparkSession.createDataFrame([(n,) for n in required], f"{name} string")
    return wanted.join(present.select(name), name, "left_anti")
