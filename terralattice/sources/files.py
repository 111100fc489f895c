"""Finding imagery files and reading what their names say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terralattice import constants as C
from terralattice.functions import scalars as S


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def scan_directory(spark: SparkSession, directory: str, pattern: str = "*.nc", recursive: bool = True) -> DataFrame:
    """Files below a directory by glob: path, name, length, modification time.

    Only file status is read; file contents are never selected. Empty files are
    not listed.
    """
    found = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", str(recursive).lower()).load(directory))
    return found.select(F.col("path").alias("file_path"), base_name(F.col("path")).alias("file_name"),
                        F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def explicit_files(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """A caller's paths, a list or a table with file_path; none at all or a foreign name is an error."""
    listed = paths if isinstance(paths, DataFrame) else spark.createDataFrame([(p,) for p in paths], "file_path string")
    files = listed.select("file_path").withColumn("file_name", base_name(F.col("file_path")))
    foreign = F.coalesce(~F.col("file_name").rlike(C.FILENAME_PATTERN), F.lit(True))
    state = files.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(foreign, F.coalesce("file_name", F.lit("a missing name")))).alias("foreign")).first()
    if not state["n"]:
        raise ValueError("The file list is empty")
    if state["foreign"] is not None:
        raise ValueError(f"Not a product file name: {state['foreign']}")
    return files


def product_files(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Keep names that start like a product file."""
    return files.where(F.col(name).rlike(C.FILENAME_PATTERN))


def parse_names(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Add scene, mode, satellite and the three time stamps as timestamps."""
    part = lambda i: F.regexp_extract(F.col(name), C.FILENAME_PATTERN, i)
    return files.withColumns({
        "scene": part(1), "mode": part(2).cast("int"), "satellite": part(3).cast("int"),
        "start_time": S.product_stamp(part(4)), "end_time": S.product_stamp(part(5)),
        "created_time": S.product_stamp(part(6))})


def in_start_order(files: DataFrame) -> DataFrame:
    return files.orderBy("start_time", "file_name")


def remote_inventory(urls: DataFrame, url: str = "url") -> DataFrame:
    """Satellite, year, day of year and hour from hour-level catalog URLs.

    The path's parts are counted from its end; a shorter path gives nulls.
    """
    parts = F.split(F.parse_url(F.col(url), F.lit("PATH")), "/")
    at = lambda i: F.when(F.size(parts) >= 6, F.try_element_at(parts, F.lit(i)))
    return urls.select(at(-6).alias("satellite"), at(-4).alias("year"), at(-3).alias("day_of_year"),
                       at(-2).alias("hour"), F.col(url).alias("hour_url"))
