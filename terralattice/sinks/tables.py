"""Writing catalogs, weights and gridded tables so that reruns add nothing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types

from terralattice import constants as C, schemas, session
from terralattice.functions import scalars as S
from terralattice.operators import bands as B, catalog, grid as G, store
from terralattice.operators.groups import join_by
from terralattice.schemas import TEXT_TIMES
from terralattice.sources import tables as T


_FRAME = ["orbital_slot", "obs_date", "time"]
_INDEX, _BEGUN = "_region/frames", "_region/begun"
INDEX_TASKS = 32  # that write the few rows of the many folders of an index
FOLDER_ROWS = 1 << 22  # of a (slot, date) folder in one file; folders with more get a file per hour and square


def write_catalog(tables: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> None:
    """Write the catalog tables anew; empty ones are skipped."""
    for name, df in tables.items():
        if df.isEmpty():
            continue
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.options(header=True, **TEXT_TIMES)
        writer.format(fmt).save(f"{directory}/{name}")


def append_new(new: DataFrame, path: str, keys: list[str], unique: bool = False, by: str | None = None) -> None:
    """Append the rows whose key is not stored yet; create the table when absent.

    The stored keys are read with the columns pruned to the key. `by` names a column that
    the key decides, such as a date: the table is partitioned by it, and only the partitions
    that the new rows concern are read. Repeats inside
    `new` are settled first unless the caller knows that its keys are `unique`.
    """
    spark = new.sparkSession
    fresh = new if unique else catalog.settle(new, keys)
    if T.exists(spark, path):
        stored = spark.read.schema(new.schema).parquet(path) if by else spark.read.parquet(path)
        catalog.same_columns(stored, new)
        known = stored.select(*dict.fromkeys([*keys, *([by] if by else [])]))
        if by:
            known = join_by(known, new.select(by).distinct().withColumn("_part", F.lit(1)), [by]).drop("_part")
        fresh = catalog.not_yet_known(fresh, known, keys).select(*stored.columns)
    writer = (fresh.repartition(by) if by else fresh).write.mode("append")
    (writer.partitionBy(by) if by else writer).parquet(path)


def create_store(spark: SparkSession, path: str, bands, include_dqf: bool = True, overwrite: bool = False,
                 name: str | None = None, grid: DataFrame | None = None, attributes: dict[str, str] | None = None) -> None:
    """Declare a region: its bands, grid and attributes, and an empty gridded table.

    What is declared is kept in `_region` beside the data, where Spark does not
    take it for rows; `sources.tables.open_region` reads the schema from there, so an empty
    region can be opened. `grid(target_id, ilat, ilon, lat, lon)` must have monotonic
    axes; longitudes may cross the antimeridian.
    """
    bands = list(bands)
    if not bands or len(set(bands)) < len(bands) or not set(bands) <= set(C.ALL_BANDS):
        raise ValueError(f"Bands must be different numbers of 1..16, got {bands}")
    if name is not None and not name.strip():
        raise ValueError("A region needs a name")
    schema = schemas.gridded(bands, include_dqf)
    mode = "overwrite" if overwrite else "errorifexists"
    if grid is not None:
        for idx, value in (("ilat", "lat"), ("ilon", "lon")):
            axis = grid.select(F.lit(0).alias("axis"), idx, value).distinct()
            if not axis.isEmpty() and not G.axis_checks(axis, ["axis"], idx, value).first()["valid"]:
                raise ValueError(f"The {value} axis is not monotonic")
    spark.createDataFrame([], schema).write.mode(mode).partitionBy("orbital_slot", "obs_date").parquet(path)
    spark.createDataFrame([], schemas.FRAMES).write.partitionBy(*_FRAME[:2]).parquet(f"{path}/{_INDEX}")
    told = {"region": name or "", "bands": ",".join(map(str, bands))} | (attributes or {})
    rows = spark.createDataFrame([("schema", schema.json()), *told.items()], "key string, value string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/_region/attributes")
    if grid is not None:
        grid.select("target_id", "ilat", "ilon", "lat", "lon").write.mode("overwrite").parquet(f"{path}/_region/grid")


def stored_rows(regridded: DataFrame, bands, include_dqf: bool = True) -> DataFrame:
    """Shape rows as the gridded table stores them."""
    ready = regridded.withColumn("obs_date", F.to_date("time")).withColumn(
        "scan_mode", S.text_or_unknown(F.col("scan_mode")))
    return ready.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                          for f in schemas.gridded(bands, include_dqf).fields])


def frame_index(spark: SparkSession, path: str, frames: DataFrame | None = None) -> DataFrame:
    """orbital_slot, obs_date, time, rows: how many rows the region holds of each frame; of those in `frames` only, if given.

    A row per frame and append that touched it is kept beside the data, in folders
    per (slot, date). A table without an index gets one from its rows, once.
    """
    if not T.exists(spark, f"{path}/{_INDEX}"):
        schema = spark.read.parquet(path).schema
        stored = spark.read.schema(schema).parquet(path).groupBy(*_FRAME).agg(F.count(F.lit(1)).alias("rows"))
        _write_index(session.materialize(stored, "frames"), path, "overwrite")
    kept = spark.read.schema(schemas.FRAMES).parquet(f"{path}/{_INDEX}")
    if frames is not None:
        kept = join_by(kept, frames.select(*_FRAME[:2]).distinct().withColumn("_folder", F.lit(1)), _FRAME[:2]).drop("_folder")
    index = kept.groupBy(*_FRAME).agg(F.max("rows").alias("rows"))  # frames only grow
    return index if frames is None else join_by(index, frames.select(*_FRAME).distinct().withColumn("_asked", F.lit(1)), _FRAME).drop("_asked")


def _write_index(rows: DataFrame, path: str, mode: str) -> None:
    writer = rows.select(*schemas.FRAMES.names).repartition(INDEX_TASKS, *_FRAME[:2]).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*_FRAME[:2]).parquet(f"{path}/{_INDEX}")


def _count_stored(spark: SparkSession, frames: DataFrame, path: str, schema) -> DataFrame:
    """Index rows of `frames` as their data are now."""
    found = _stored(spark, frames, path, schema, _FRAME).groupBy(*_FRAME).agg(F.count(F.lit(1)).alias("rows"))
    return session.materialize(found, "frames")


def settle_appends(spark: SparkSession, path: str, schema) -> None:
    """Bring the index up to date with appends that stopped before they were through: their frames are counted anew."""
    for name in session.child_names(spark, f"{path}/{_BEGUN}"):
        begun = f"{path}/{_BEGUN}/{name}"
        if "_SUCCESS" in session.child_names(spark, begun):  # else no data of it were written
            frames = spark.read.schema(types.StructType(schemas.FRAMES.fields[:3])).parquet(begun)
            _write_index(_count_stored(spark, frames, path, schema), path, "append")
        session.remove(spark, begun)


def missing_frames(frames: DataFrame, path: str, schema, cells: int) -> DataFrame:
    """The frames (orbital_slot, obs_date, time) of which the store holds fewer than `cells` rows.

    Asked before gridding, so that stored frames are not gridded again. Only the
    frame index is read.
    """
    settle_appends(frames.sparkSession, path, schema)
    full = frame_index(frames.sparkSession, path, frames).where(F.col("rows") >= cells)
    return join_by(frames, full, _FRAME, "left").where("rows is null").drop("rows")


def append_frames(rows: DataFrame, path: str, schema, frames: DataFrame | None = None) -> None:
    """Append the rows that the region does not hold yet, by (slot, time, target).

    The frame index tells new frames, whose rows are written as they come, from
    frames that are stored in part: of these alone the stored targets are read, from
    the row groups of their time, and left out. `rows` are evaluated once and kept until
    they are counted and written; `frames` names the frames in them where the caller has
    them at hand.

    The frames are noted before the data are written, and the note goes when the
    index has them; an append that stops in between is settled by the next, so that
    it can be done again in whole.

    The rows of a (slot, date) folder are gathered in one file, those of a folder with
    more than FOLDER_ROWS per hour and square of 1024 x 1024 cells: a hot slot or date
    is spread over many tasks, and small frames of many dates make few files.
    """
    if set(rows.columns) != set(schema.names):
        raise ValueError(f"Band set differs from the store's: {sorted(set(rows.columns) ^ set(schema.names))}")
    spark = rows.sparkSession
    settle_appends(spark, path, schema)
    rows = kept = session.materialize(rows.select(*schema.names), "appended")
    begun = f"{path}/{_BEGUN}/{uuid.uuid4().hex}"
    (rows if frames is None else frames).select(*_FRAME).distinct().write.parquet(begun)
    frames = spark.read.schema(types.StructType(schemas.FRAMES.fields[:3])).parquet(begun)
    partly = session.materialize(frame_index(spark, path, frames), "partly-stored")
    if not partly.isEmpty():
        key = [*_FRAME, "target_id"]
        known = _stored(spark, partly, path, schema, key).withColumn("_known", F.lit(1))
        told = join_by(rows, partly.select(*_FRAME, F.lit(1).alias("_partly")), _FRAME, "left")
        rest = join_by(told.where("_partly is not null"), known, key, "left").where("_known is null")
        rows = told.where("_partly is null").select(*schema.names).unionByName(rest.select(*schema.names))
    _gathered(rows.select(*schema.names), kept).write.mode("append").partitionBy(
        "orbital_slot", "obs_date").option("compression", "zstd").parquet(path)
    _write_index(_count_stored(spark, frames, path, schema), path, "append")
    session.remove(spark, begun)


def append_observations(pixels: DataFrame, path: str, schema, transform: Callable[[DataFrame], DataFrame],
                        bands: list[int], expected_pixels: int, cells: int) -> DataFrame:
    """Check, grid and append observations; returns (orbital_slot, obs_date, time, error_message) of those refused.

    `pixels` are wide rows with orbital_slot, obs_date and time. A frame must have
    a value or a flag of exactly the store's bands, and `expected_pixels` pixels. Frames stored
    in whole are left out before gridding.
    """
    present = F.array_compact(F.array(*[F.when(F.count(F.coalesce(
        *[F.col(c).cast("double") for c in (f"cmi_c{b:02d}", f"dqf_c{b:02d}") if c in pixels.columns])) > 0, F.lit(b))
        for b in B.available_bands(pixels)]))
    frames = session.materialize(pixels.groupBy(*_FRAME).agg(F.count(F.lit(1)).alias("n"), present.alias("bands")), "frames")
    error = (F.when(F.col("bands") != F.array(*[F.lit(b) for b in sorted(bands)]), F.concat(F.lit("Band set differs: "), F.array_join("bands", ",")))
             .when(F.col("n") != expected_pixels, "Unexpected frame shape"))
    checked = frames.select(*_FRAME, error.alias("error_message"))
    good = checked.where("error_message is null").select(*_FRAME)
    new = session.materialize(missing_frames(good, path, schema, cells), "new-frames")
    append_frames(transform(join_by(pixels, new.withColumn("_new", F.lit(1)), _FRAME).drop("_new")), path, schema, new)
    return checked.where("error_message is not null")


def _stored(spark: SparkSession, frames: DataFrame, path: str, schema, columns: list[str]) -> DataFrame:
    """Stored columns of the rows of `frames`; folders, and row groups by time, that hold none are skipped."""
    wanted = frames.select(*_FRAME).distinct()
    ends = wanted.agg(F.min("time").alias("first"), F.max("time").alias("last")).first()
    stored = spark.read.schema(schema).parquet(path)
    if ends["first"] is not None and wanted.where("time is null").isEmpty():
        stored = stored.where(F.col("time").between(F.lit(ends["first"]), F.lit(ends["last"])))
    return join_by(stored.select(*dict.fromkeys([*_FRAME, *columns])), wanted.withColumn("_frame", F.lit(1)), _FRAME).select(*columns)


def place_order(ilat: Column, ilon: Column) -> Column:
    """Place of a grid cell on a curve that keeps neighbours together: the bits of row and column in turn."""
    def spread(i: Column) -> Column:  # 16 bits, a gap behind each
        v = F.pmod(i.cast("long"), F.lit(1 << 16))
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v
    return F.shiftleft(spread(ilat), 1).bitwiseOR(spread(ilon))


def _gathered(rows: DataFrame, counted: DataFrame, most: int = FOLDER_ROWS) -> DataFrame:
    """Rows by folder, those of a folder with more than `most` by hour and square of 1024 x 1024 cells too, along the curve within.

    So files and row groups hold a small window in space. `counted` holds the rows, or more, in a stored table.
    """
    crowded = counted.groupBy(*_FRAME[:2]).agg(F.count(F.lit(1)).alias("_crowd")).where(F.col("_crowd") > most)
    hour, curve = F.date_trunc("hour", "time"), place_order(F.col("ilat"), F.col("ilon"))
    placed = rows.withColumn("_square", F.shiftright(curve, 20)).withColumn("_place", curve)
    told = join_by(placed, F.broadcast(crowded), _FRAME[:2], "left")
    apart = lambda c: F.when(F.col("_crowd").isNotNull(), c)
    ordered = told.repartition("orbital_slot", "obs_date", apart(hour), apart(F.col("_square"))).sortWithinPartitions("orbital_slot", "obs_date", "_square", "_place", "time")
    return ordered.drop("_square", "_place", "_crowd")


def overwrite_dates(rows: DataFrame, path: str) -> None:
    """Replace the (slot, date) folders that `rows` touches, in the frame index too; others stay."""
    spark = rows.sparkSession
    written = session.materialize(rows, "replacement")
    counts = session.materialize(written.groupBy(*_FRAME).agg(F.count(F.lit(1)).alias("rows")), "frames")
    (_gathered(written, written).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("orbital_slot", "obs_date").parquet(path))
    if T.exists(spark, f"{path}/{_INDEX}"):
        _write_index(counts, path, "overwrite")


def append_history(spark: SparkSession, path: str, message: str) -> None:
    """Add a line to a region's history."""
    now = spark.range(1).select(F.current_timestamp().alias("ts"), F.lit(message).alias("message"))
    now.withColumn("line", store.history_line(F.col("ts"), F.col("message"))).write.mode("append").parquet(f"{path}/_region/history")


def replace_selection(stored: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows with the rows of `changed` put in their place."""
    catalog.same_columns(stored, changed)
    return catalog.not_yet_known(stored, changed, keys).unionByName(changed)


def save_bucketed(df: DataFrame, table: str, buckets: int = 64, path: str | None = None, by: tuple[str, ...] = ("source_id",)) -> None:
    """Weights or pixels as a table bucketed and sorted on the source pixel: such tables with as many buckets join without a shuffle.

    The number of buckets should give files of a few hundred MB, one each; a frame's pixels
    are spread over all of them, so no time or slot is hot. Where there are more frames
    than that allows for the pixels of a grid, `by` names `part` before the source pixel: pixels hold a
    part of the frames each, weights are there once per part, and `regrid` joins on both.
    """
    writer = df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def write_weights(weights: DataFrame, path: str, metadata: DataFrame | None = None, mask: DataFrame | None = None) -> None:
    """Weights as files, kept per grid, with a row of metadata per grid beside them, and the source pixels (grid_id, source_id) they were made from."""
    (weights.repartition("grid_id", F.floor(F.col("target_id") / (1 << 20))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("grid_id").parquet(path))
    if metadata is not None:
        (metadata.repartition("grid_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("grid_id").parquet(f"{path}/_about"))
    if mask is not None:
        (mask.select("grid_id", "source_id").distinct().repartition("grid_id", F.floor(F.col("source_id") / (1 << 20))).sortWithinPartitions("grid_id", "source_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("grid_id").parquet(f"{path}/_mask"))


def export_failed(log: DataFrame, path: str) -> None:
    log.where(F.col("status") == "failed").write.mode("overwrite").options(**TEXT_TIMES).json(path)


def import_failed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_LOG).options(**TEXT_TIMES).json(path)
