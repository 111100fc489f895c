"""Frames as arrays: a block of pixels per row, gathered with a block of weights per row.

A frame is cut into tiles of pixels that overlap by one row and column; the weights
of all targets whose vertices lie in a tile are kept beside it in compressed form:
target ids, three positions within the tile and three weights each. Regridding is
then one join that moves a row per tile, not one per pixel, and one gather per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from terralattice import constants as C
from terralattice.operators.regrid import tile_weights
from terralattice.operators.weights import VERTICES

TARGETS = 1 << 16  # of a tile in one row; more go to further rows


def _tiles(n: int, tile: int) -> int:
    return -(-n // tile)


def _width(tx: Column, nx: int, tile: int) -> Column:
    """Columns of a tile: one more than its size, less at the right edge."""
    return F.least(F.lit(tile + 1), F.lit(nx) - tx * tile)


def array_tiles(frames: DataFrame, keys: list[str], arrays: list[str], nx: int, ny: int, tile: int = 128) -> DataFrame:
    """keys, tile and a block of each array: the pixels of 2-d frames, cut where they are read.

    `arrays` are row-major with ny * nx values each; one of another length fails,
    a null one stays null. Missing values become NaN.
    """
    sized = frames
    for a in arrays:
        fits = F.col(a).isNull() | (F.size(a) == nx * ny)
        sized = sized.withColumn(a, F.when(fits, F.col(a).cast("array<double>")).otherwise(
            F.raise_error(F.concat(F.lit(f"{a} must have {ny} x {nx} values, not "), F.size(a).cast("string")))))
    wide = _tiles(nx, tile)

    def block(t: Column) -> Column:
        ty, tx = F.floor(t / wide), F.pmod(t, F.lit(wide))
        rows = F.sequence(ty * tile, F.least((ty + 1) * tile, F.lit(ny - 1)))
        cut = lambda a: F.flatten(F.transform(rows, lambda y: F.slice(F.col(a), (y * nx + tx * tile + 1).cast("int"), _width(tx, nx, tile).cast("int"))))
        return F.struct(t.cast("long").alias("tile"), *[cut(a).alias(a) for a in arrays])
    # All blocks of a frame are made in one expression, so that its arrays are not copied for each.
    return sized.select(*keys, F.inline(F.transform(F.sequence(F.lit(0), F.lit(wide * _tiles(ny, tile) - 1)), block)))


def pack_weights(weights: DataFrame, nx: int, tile: int = 128) -> DataFrame:
    """tile, part, target_id, position, w, dominant, max_w: the weights of a tile as arrays, made once per grid.

    Per target three positions within the tile's block and three weights in a row,
    and the place of the dominant one. Vertices must lie within one pixel beyond
    the tile, as with `regrid_tiled`.
    """
    placed = tile_weights(weights, nx, tile)
    wide = _tiles(nx, tile)
    iy, ix = F.floor(F.col("source_id") / nx), F.pmod(F.col("source_id"), F.lit(nx))
    ty, tx = F.floor(F.col("tile") / wide), F.pmod(F.col("tile"), F.lit(wide))
    position = ((iy - ty * tile) * _width(tx, nx, tile) + ix - tx * tile).cast("int")
    vertex = F.struct("rank", position.alias("position"), "w", "dominant")
    targets = placed.groupBy("tile", "target_id").agg(F.max("max_w").alias("max_w"), F.array_sort(F.collect_list(vertex)).alias("v"))
    crowded = targets.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    parted = targets.join(crowded, "tile").withColumn("part", F.pmod(F.xxhash64("target_id"), (F.col("n") / TARGETS).cast("int") + 1).cast("int"))
    first = F.array_position(F.col("v.dominant"), True) - 1
    one = F.struct("target_id", F.col("v.position").alias("position"), F.col("v.w").alias("w"),
                   first.cast("int").alias("dominant"), "max_w")
    packed = parted.groupBy("tile", "part").agg(F.array_sort(F.collect_list(one)).alias("t"))
    of = lambda f: F.col(f"t.{f}")  # of all the tile's targets
    return packed.select("tile", "part", of("target_id").alias("target_id"), F.flatten(of("position")).alias("position"), F.flatten(of("w")).alias("w"),
                         of("dominant").alias("dominant"), of("max_w").alias("max_w"))


def _lists(column: pa.Array, kind) -> list[np.ndarray | None]:
    return [None if v.values is None else v.values.to_numpy(zero_copy_only=False).astype(kind, copy=False) for v in column]


def gather_values(values: np.ndarray, position: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted sums; a missing vertex makes a target NaN, even at weight 0."""
    return (values[position] * w).sum(axis=1)


def gather_flags(values: np.ndarray, position: np.ndarray, w: np.ndarray, dominant: np.ndarray, max_w: np.ndarray, strict: bool) -> np.ndarray:
    """Flags by the rules of `regrid.classify_flag`, of covered targets."""
    met = values[position]
    direct = max_w >= C.DIRECT_HIT_WEIGHT
    blend = np.where(direct, met[np.arange(len(met)), dominant], (met * w).sum(axis=1))
    nearest = np.rint(np.nan_to_num(blend, nan=C.NAN_FLAG))
    whole = direct | (met.min(axis=1) == met.max(axis=1)) if strict else np.abs(blend - nearest) < C.INTEGER_EPSILON
    return np.where(np.isnan(blend), C.NAN_FLAG, np.where(whole, nearest, C.MIXED_FLAG)).astype(np.int16)


def regrid_tiles(tiles: DataFrame, packed: DataFrame, keys: list[str], cmi: list[str], dqf: list[str] = [], strict: bool = False) -> DataFrame:
    """keys, tile, part, target_id and an array of results per band, for the covered targets of every frame.

    Results equal those of `regrid`. `tiles` are from `array_tiles`, `packed` from
    `pack_weights` with the same tile size. A null array counts as without values.
    """
    joined = tiles.select("tile", *keys, *cmi, *dqf).join(packed, "tile")
    fields = [joined.schema[k] for k in (*keys, "tile", "part", "target_id")]
    fields += [T.StructField(c, T.ArrayType(T.DoubleType())) for c in cmi] + [T.StructField(c, T.ArrayType(T.ShortType())) for c in dqf]
    schema = to_arrow_schema(T.StructType(fields))
    kept = [*keys, "tile", "part", "target_id"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = {n: _lists(batch.column(n), np.float64) for n in (*cmi, *dqf, "w", "max_w")}
            held |= {n: _lists(batch.column(n), np.int64) for n in ("position", "dominant")}
            made: dict[str, list] = {n: [] for n in (*cmi, *dqf)}
            for i in range(batch.num_rows):
                position, w = held["position"][i].reshape(-1, VERTICES), held["w"][i].reshape(-1, VERTICES)
                empty = np.full(int(position.max(initial=0)) + 1, np.nan)
                for n in cmi:
                    made[n].append(gather_values(empty if held[n][i] is None else held[n][i], position, w))
                for n in dqf:
                    made[n].append(gather_flags(empty if held[n][i] is None else held[n][i], position, w, held["dominant"][i], held["max_w"][i], strict))
            yield pa.RecordBatch.from_arrays([*[batch.column(n).cast(schema.field(n).type) for n in kept],
                                              *[pa.array(made[n], schema.field(n).type) for n in (*cmi, *dqf)]], schema=schema)
    return joined.mapInArrow(each, T.StructType(fields))


def tile_rows(gridded: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A row per target from arrays per tile."""
    return gridded.select(*keys, F.inline(F.arrays_zip("target_id", *columns)))


def whole_arrays(gridded: DataFrame, keys: list[str], cmi: list[str], dqf: list[str], n_targets: int) -> DataFrame:
    """keys and one array per band over target ids 0 to n_targets - 1; NaN and flag 3 outside the coverage.

    For frames that came as one array and go out as one; others stay in tiles.
    """
    fields = [gridded.schema[k] for k in keys]
    fields += [T.StructField(c, gridded.schema[c].dataType) for c in (*cmi, *dqf)]
    schema = to_arrow_schema(T.StructType(fields))

    def each(part: pa.Table) -> pa.Table:
        out = {c: np.full(n_targets, np.nan) for c in cmi} | {c: np.full(n_targets, C.OUTSIDE_FLAG, np.int16) for c in dqf}
        at = part.column("target_id").combine_chunks().flatten().to_numpy()
        for c in out:
            out[c][at] = part.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({**{k: part.column(k).slice(0, 1).cast(schema.field(k).type) for k in keys},
                         **{c: pa.array([v], schema.field(c).type) for c, v in out.items()}}, schema=schema)
    return gridded.select(*keys, "target_id", *cmi, *dqf).groupBy(*keys).applyInArrow(each, T.StructType(fields))


def regrid_arrays(frames: DataFrame, packed: DataFrame, keys: list[str], cmi: list[str], dqf: list[str], nx: int, ny: int, n_targets: int,
                  tile: int = 128, strict: bool = False) -> DataFrame:
    """2-d array frames in, one array over all targets per frame and band out."""
    tiles = array_tiles(frames, keys, [*cmi, *dqf], nx, ny, tile)
    return whole_arrays(regrid_tiles(tiles, packed, keys, cmi, dqf, strict), keys, cmi, dqf, n_targets)


def regrid_cubes(cubes: DataFrame, packed: DataFrame, keys: list[str], cmi: list[str], dqf: list[str], nx: int, ny: int, n_targets: int,
                 tile: int = 128, strict: bool = False) -> DataFrame:
    """3-d arrays (time, y * x) in, arrays (time, target) out; a cube is cut into its frames and put together in order of time.

    All cubes of a row have as many time steps; a cube without steps is left out.
    """
    bands = [*cmi, *dqf]
    steps = cubes.select(*keys, F.posexplode(F.arrays_zip(*bands)).alias("_step", "_frame")).select(*keys, "_step", *[f"_frame.{b}" for b in bands])
    done = regrid_arrays(steps, packed, [*keys, "_step"], cmi, dqf, nx, ny, n_targets, tile, strict)
    in_order = done.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_step", *bands))).alias("_steps"))
    return in_order.select(*keys, *[F.col(f"_steps.{b}").alias(b) for b in bands])
