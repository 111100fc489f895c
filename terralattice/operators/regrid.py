"""Barycentric regridding as one join and one aggregation over all bands.

Every output value is a weighted sum over the three vertices of its target. CMI
keeps NaN (a NaN vertex makes the target NaN, even at weight 0). Quality flags
follow the flag rules in `classify_flag`. A target outside the coverage, or one
whose vertices are not all present in a frame, has NaN CMI.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terralattice import constants as C
from terralattice.functions import scalars as S
from terralattice.operators.weights import VERTICES


def classify_flag(covered: Column, blend: Column, equal: Column | None = None) -> Column:
    """Flag of a target from the blend of its vertices' flags.

    Outside -> 3; NaN -> 6; a whole blend -> that flag; anything between -> 5.
    `blend` is the weighted sum, or just the dominant vertex's flag on a direct
    hit. `equal` (strict mode) asks for equal flags in place of a whole blend.
    """
    nearest = F.rint(F.nanvl(blend, F.lit(float(C.NAN_FLAG))))
    whole = F.abs(blend - nearest) < C.INTEGER_EPSILON if equal is None else equal
    return (F.when(~covered, C.OUTSIDE_FLAG)
            .when(F.isnan(blend), C.NAN_FLAG)
            .when(whole, nearest)
            .otherwise(C.MIXED_FLAG)).cast("short")


def _direct(max_w: str) -> Column:
    return F.col(max_w) >= C.DIRECT_HIT_WEIGHT


def _aggregates(cmi: list[str], dqf: list[str], strict: bool) -> list[Column]:
    """One sum per CMI column and one per flag column, plus three shared counts.

    On a direct hit only the dominant vertex's flag counts, so that the same sum
    serves both flag rules.
    """
    w, dominant = F.col("w"), F.col("dominant")
    out = [F.count(w).alias("_n"), F.max("max_w").alias("_max_w"), F.count_if(dominant).alias("_n_dominant")]
    out += [F.sum(w * S.as_value(F.col(c))).alias(f"_s_{c}") for c in cmi]
    for c in dqf:
        value = S.as_value(F.col(c))
        share = F.when(~_direct("max_w"), w * value).when(dominant, value).otherwise(0.0)
        out.append(F.sum(share).alias(f"_s_{c}"))
        if strict:
            out += [F.min(value).alias(f"_lo_{c}"), F.max(value).alias(f"_hi_{c}")]
    return out


def _results(cmi: list[str], dqf: list[str], strict: bool) -> list[Column]:
    whole = F.col("_n") == VERTICES
    missing = F.lit(S.NAN)
    values = [F.when(whole, F.col(f"_s_{c}")).otherwise(missing).alias(c) for c in cmi]
    known = whole | (_direct("_max_w") & (F.col("_n_dominant") > 0))
    for c in dqf:
        blend = F.when(known, F.col(f"_s_{c}")).otherwise(missing)
        equal = _direct("_max_w") | (F.col(f"_lo_{c}") == F.col(f"_hi_{c}")) if strict else None
        values.append(classify_flag(F.col("_max_w").isNotNull(), blend, equal).alias(c))
    return values


ROWS = 1 << 18  # wanted rows of one task


def _grid_of(weights: DataFrame) -> list[str]:
    """Weights of several grids in one table tell them apart by grid_id."""
    return ["grid_id"] if "grid_id" in weights.columns else []


def regrid(pixels: DataFrame, weights: DataFrame, frame: list[str], cmi: list[str],
           dqf: list[str] = [], strict: bool = False, every: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Covered targets of every frame; works with any weights.

    `frame` names the columns that identify a frame. `weights` come from
    `weights.prepare`. One equi-join on the source pixel, then one aggregation
    that carries all bands; partial sums combine before the shuffle. AQE turns
    the join into a broadcast when the weights' real size allows it and splits
    a hot source pixel otherwise.

    Weights with grid_id hold several grids: pixels that have a grid_id go to
    their own grid, others to each, and results carry it.

    `every` = (frames, targets) asks for all targets of all these frames: NaN and
    flag 3 outside the coverage, flag 6 where a frame lacks the pixels. The wanted
    rows join the same aggregation, so they are shuffled once, to tasks of about ROWS rows.

    Where weights and pixels have a `part`, as tables that were bucketed in parts do,
    pixels meet the weights of their part, which are the same in all.
    """
    grid = _grid_of(weights)
    own = [g for g in (*grid, "part") if g in pixels.columns and g in weights.columns]
    met = pixels.select(*own, *frame, "source_id", *cmi, *dqf).join(weights, [*own, "source_id"])
    if every is not None:
        met = met.select(*grid, *frame, "target_id", "w", "dominant", "max_w", *cmi, *dqf).unionByName(
            _wanted(*every, weights, grid, frame), allowMissingColumns=True)
        parts = -(-every[0].count() * every[1].count() // ROWS)
        met = met.repartition(max(1, parts), *grid, *frame, "target_id")
    summed = met.groupBy(*grid, *frame, "target_id").agg(*_aggregates(cmi, dqf, strict))
    return summed.select(*grid, *frame, "target_id", *_results(cmi, dqf, strict))


def _wanted(frames: DataFrame, targets: DataFrame, weights: DataFrame, grid: list[str], frame: list[str], blocks: int = 32) -> DataFrame:
    """A row without values for every wanted target of every frame, with the target's largest weight."""
    covered = weights.groupBy(*grid, "target_id").agg(F.max("max_w").alias("max_w"))
    known = targets.select(*grid, "target_id").join(covered, [*grid, "target_id"], "left")
    return _frames_with_targets(frames, known, [g for g in grid if g in frames.columns], frame, blocks)


def _tiles_of(at: Column, tile: int) -> Column:
    """Tiles along one axis whose window (tile size plus one) holds the index."""
    home = F.floor(at / tile)
    return F.sequence(F.greatest(F.floor((at - 1) / tile), F.lit(0)), home)


def _tile_number(ty: Column, tx: Column, nx: int, tile: int) -> Column:
    return ty * (-(-nx // tile)) + tx


def tile_weights(weights: DataFrame, nx: int, tile: int = 32) -> DataFrame:
    """Give every target the number of the lattice tile of its lowest row and column.

    Done once and stored with the weights. Vertices must lie within one pixel
    beyond the tile; weights built on the cells of a lattice do. Others are
    refused, not dropped.
    """
    iy, ix = F.floor(F.col("source_id") / nx), F.pmod(F.col("source_id"), F.lit(nx))
    target = [*_grid_of(weights), "target_id"]
    home = weights.groupBy(*target).agg(
        F.min(iy).alias("_y0"), F.max(iy).alias("_y1"), F.min(ix).alias("_x0"), F.max(ix).alias("_x1"))
    ty, tx = F.floor(F.col("_y0") / tile), F.floor(F.col("_x0") / tile)
    fits = (F.col("_y1") - ty * tile <= tile) & (F.col("_x1") - tx * tile <= tile)
    number = F.when(fits, _tile_number(ty, tx, nx, tile)).otherwise(
        F.raise_error(F.lit("a target reaches beyond its tile; use regrid() for these weights")))
    return weights.join(home.select(*target, number.alias("tile")), target).select(*weights.columns, "tile")


def regrid_tiled(pixels: DataFrame, tiled: DataFrame, frame: list[str], cmi: list[str],
                 dqf: list[str] = [], nx: int = 0, tile: int = 32, salts: int = 1,
                 strict: bool = False) -> DataFrame:
    """As `regrid`, with a single shuffle of the pixels; `tiled` is from `tile_weights`.

    Both sides are partitioned by part = (tile, salt), edge pixels going to every
    tile that needs them. The join on (part, pixel) and the aggregation per
    target both find their rows already together, so the joined rows, three per
    target and far wider than the input, are never shuffled. `salts` spreads the
    frames of one tile; the weights are repeated once per salt. Needs a session
    that lets a join reuse a partitioning on part of its keys
    (`session.gridding_session`); elsewhere it is right but shuffles again.
    """
    iy, ix = F.floor(F.col("source_id") / nx), F.pmod(F.col("source_id"), F.lit(nx))
    salt = F.pmod(F.xxhash64(*frame), F.lit(salts))
    grid = _grid_of(tiled)
    own = [g for g in grid if g in pixels.columns]
    sent = (pixels.select(*own, *frame, "source_id", *cmi, *dqf)
            .withColumn("_ty", F.explode(_tiles_of(iy, tile)))
            .withColumn("_tx", F.explode(_tiles_of(ix, tile)))
            .withColumn("_part", _tile_number(F.col("_ty"), F.col("_tx"), nx, tile) * salts + salt)
            .drop("_ty", "_tx").repartition("_part"))
    held = (tiled.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            .withColumn("_part", F.col("tile") * salts + F.col("_salt")).drop("tile", "_salt", "rank")
            .repartition("_part"))
    met = sent.join(held, ["_part", *own, "source_id"])
    summed = met.groupBy(*grid, *frame, "_part", "target_id").agg(*_aggregates(cmi, dqf, strict))
    return summed.select(*grid, *frame, "target_id", *_results(cmi, dqf, strict))


def _frames_with_targets(frames: DataFrame, targets: DataFrame, own: list[str], frame: list[str], blocks: int) -> DataFrame:
    """Every wanted (frame, target) row, as an equi-join on a block number.

    Frames and targets are both cut into `blocks`; each frame is sent to all
    target blocks and each target to all frame blocks, so the rows come from
    blocks * blocks equal groups, whatever the numbers of frames and targets.
    `own`: frames with a grid_id get the targets of their grid only.
    """
    block = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(blocks)).cast("int")
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = frames.select(*own, *frame, block(*frame).alias("_fb")).withColumn("_tb", all_blocks)
    right = targets.withColumn("_tb", block("target_id")).withColumn("_fb", all_blocks)
    return left.join(right, [*own, "_fb", "_tb"]).drop("_fb", "_tb")


def observation_rows(regridded: DataFrame, observations: DataFrame, frame: list[str]) -> DataFrame:
    """Regridded frames with the platform and scan mode of their observation."""
    keys = observations.select(*frame, "platform_id", S.text_or_unknown(F.col("scan_mode")).alias("scan_mode"))
    return regridded.join(keys, frame)
