"""Arrays to rows and back, at most one image row per array."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def flatten(frames: DataFrame, array: str, nx: int, keys: list[str]) -> DataFrame:
    """One row per element of a row-major array, with its pixel indices."""
    flat = frames.select(*keys, F.posexplode(array).alias("_pos", "value"))
    pos = F.col("_pos").cast("long")
    return flat.select(*keys, pos.alias("source_id"), F.floor(pos / nx).cast("int").alias("iy"),
                       F.pmod(pos, F.lit(nx)).cast("int").alias("ix"), "value")


def image_rows(cells: DataFrame, keys: list[str], row: str, col: str, value: str) -> DataFrame:
    """Gather each image row into an array ordered by column.

    A frame is never gathered whole: the array is bounded by the grid's width.
    """
    pair = F.struct(F.col(col).alias("c"), F.col(value).alias("v"))
    return (cells.groupBy(*keys, row).agg(F.array_sort(F.collect_list(pair)).alias("_cells"))
            .select(*keys, row, F.transform("_cells", lambda p: p["v"]).alias("values")))
