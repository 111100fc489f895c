"""Interpolation weights: a sparse matrix in coordinate form.

One row per (target, vertex): `target_id, rank, source_id, w, dominant, max_w`,
three rows per covered target and none outside the source coverage. The dominant
vertex and the largest weight are what every later use needs and what never
changes between frames; builders give them along, `prepare` adds them to imported
weights.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from terralattice import constants as C
from terralattice.functions import projection as P

VERTICES = 3


@dataclass(frozen=True)
class Lattice:
    """Source pixel lattice in scan angle; row-major ids iy * nx + ix."""

    nx: int
    ny: int
    x0: float
    y0: float
    dx: float
    dy: float

    @property
    def counter_clockwise(self) -> bool:
        """Is (row, col), (row, col+1), (row+1, col) counter-clockwise in lon/lat?"""
        return self.dx * self.dy > 0


def prepare(weights: DataFrame, grid_id: str | None = None) -> DataFrame:
    """Add `dominant` (largest weight, lowest rank on ties) and `max_w`.

    The three rows of a target are folded into one array and unfolded again:
    one shuffle, bounded groups, no window.
    """
    keys = ["target_id"] if grid_id is None else [grid_id, "target_id"]
    vertex = F.struct((-F.col("w")).alias("_neg"), "rank", "source_id", "w")
    folded = weights.groupBy(*keys).agg(F.array_sort(F.collect_list(vertex)).alias("_v"))
    return (folded.select(*keys, F.posexplode("_v").alias("_place", "_one"), F.col("_v")[0]["w"].alias("max_w"))
            .select(*keys, F.col("_one.rank").alias("rank"), F.col("_one.source_id").alias("source_id"),
                    F.col("_one.w").alias("w"), (F.col("_place") == 0).alias("dominant"), "max_w"))


def lattice_weights(targets: DataFrame, tx: str, ty: str, nx: int, ny: int,
                    keys: list[str] = ["target_id"]) -> DataFrame:
    """Weights for targets given in pixel coordinates of a regular lattice; `keys` are carried along.

    Every cell is cut along the diagonal between its two mixed corners. A
    narrow transformation: no join and no shuffle.
    """
    x, y = F.col(tx), F.col(ty)
    x0 = F.least(F.floor(x), F.lit(nx - 2)).cast("long")
    y0 = F.least(F.floor(y), F.lit(ny - 2)).cast("long")
    inside = targets.where(x.between(0, nx - 1) & y.between(0, ny - 1)).withColumns(
        {"_x0": x0, "_y0": y0, "_fx": x - x0, "_fy": y - y0})
    fx, fy = F.col("_fx"), F.col("_fy")
    at = lambda dy, dx: (F.col("_y0") + dy) * nx + F.col("_x0") + dx
    lower = _vertices((at(0, 0), 1 - fx - fy), (at(0, 1), fx), (at(1, 0), fy))
    upper = _vertices((at(1, 1), fx + fy - 1), (at(1, 0), 1 - fx), (at(0, 1), 1 - fy))
    return inside.select(*keys, F.inline(F.when(fx + fy <= 1, lower).otherwise(upper)))


def _vertices(*pairs: tuple[Column, Column]) -> Column:
    """Rows of one target; the dominant vertex has the largest weight, the lowest rank on ties."""
    largest = F.greatest(*[w for _, w in pairs])
    first = reduce(lambda later, i: F.when(pairs[i][1] == largest, i).otherwise(later), range(len(pairs) - 2, -1, -1), F.lit(len(pairs) - 1))
    return F.array(*[F.struct(F.lit(i).alias("rank"), s.cast("long").alias("source_id"), w.alias("w"),
                              (first == i).alias("dominant"), largest.alias("max_w")) for i, (s, w) in enumerate(pairs)])


def geostationary_weights(targets: DataFrame, lattice: Lattice, p: P.Projection,
                          keys: list[str] = ["target_id"], tolerance: float = 1e-9) -> DataFrame:
    """Weights of (lat, lon) targets in a fixed-grid pixel lattice.

    The lattice is regular in scan angle, so the cell of a target is computed,
    not searched, and the corners of a cell are computed too: no join. Triangles
    are straight in lat/lon while cell edges are not, so the 3 x 3 cells around a
    target are tried; each cell is cut along its locally Delaunay diagonal, and
    at the limb, where a corner is off the disk, along the one that leaves a whole
    triangle. Of the (cell, triangle) pairs that hold a target the first is kept, by an
    aggregate over the one or two rows left per target.
    """
    x, y, visible = P.latlon_to_scan(F.col("lat"), F.col("lon"), p)
    located = targets.withColumns({"_x": x, "_y": y, "_seen": visible}).where("_seen").select(
        *keys, F.col("lat").alias("_lat"), P.wrap_lon(F.col("lon") - F.lit(p.lon_origin)).alias("_lon"),
        F.floor((F.col("_x") - F.lit(lattice.x0)) / F.lit(lattice.dx)).cast("long").alias("_cx"),
        F.floor((F.col("_y") - F.lit(lattice.y0)) / F.lit(lattice.dy)).cast("long").alias("_cy"))
    cell = located.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(8)))).withColumns({
        "_iy": F.col("_cy") + F.floor(F.col("_k") / 3) - 1, "_ix": F.col("_cx") + F.col("_k") % 3 - 1})
    cell = cell.where(F.col("_iy").between(0, lattice.ny - 2) & F.col("_ix").between(0, lattice.nx - 2))

    # The four corners, step by step so that each step is computed once.
    angle = {f"_x{i}": F.lit(lattice.x0) + (F.col("_ix") + i) * F.lit(lattice.dx) for i in (0, 1)}
    angle |= {f"_y{i}": F.lit(lattice.y0) + (F.col("_iy") + i) * F.lit(lattice.dy) for i in (0, 1)}
    trig = {f"_{name}{c[1:]}": fn(F.col(c)) for c in angle for name, fn in (("s", F.sin), ("c", F.cos))}
    of = lambda i, j: (F.col(f"_sx{j}"), F.col(f"_cx{j}"), F.col(f"_sy{i}"), F.col(f"_cy{i}"))
    places = [(i, j) for i in (0, 1) for j in (0, 1)]
    far = {f"_d{i}{j}": P.reach(*of(i, j), p) for i, j in places}
    ground = {}
    for i, j in places:
        ground[f"_lat{i}{j}"], ground[f"_lon{i}{j}"] = P.ground(F.col(f"_d{i}{j}"), *of(i, j), p)
    cell = cell.withColumns(angle).withColumns(trig).withColumns(far).withColumns(ground)

    turned = _in_circle(*[(F.col(f"_lat{i}{j}"), F.col(f"_lon{i}{j}")) for i, j in places])
    inward = turned > 0 if lattice.counter_clockwise else turned < 0
    lost = F.isnan("_lat01") | F.isnan("_lat10")
    cell = cell.withColumn("_flip", (inward & ~F.isnan(turned)) | lost)

    # Triangles 0 and 1: two corners are fixed, the third depends on the diagonal.
    fixed, third = (("00", "01"), ("11", "10")), (("11", "10"), ("00", "01"))
    pick = lambda n, f: F.when(F.col("_flip"), F.col(f"_{f}{third[n][0]}")).otherwise(F.col(f"_{f}{third[n][1]}"))
    cell = cell.withColumns({f"_{f}_c{n}": pick(n, f) for n in (0, 1) for f in ("lat", "lon")})
    sides = {}
    for n in (0, 1):
        for v, f, i in (("ax", "lon", 0), ("ay", "lat", 0), ("bx", "lon", 1), ("by", "lat", 1)):
            sides[f"_{v}{n}"] = F.col(f"_{f}{fixed[n][i]}") - F.col(f"_{f}_c{n}")
        sides[f"_u{n}"] = F.col("_lon") - F.col(f"_lon_c{n}")
        sides[f"_v{n}"] = F.col("_lat") - F.col(f"_lat_c{n}")
    cell = cell.withColumns(sides)
    cross = lambda n, a, b, c, d: F.col(f"_{a}{n}") * F.col(f"_{b}{n}") - F.col(f"_{c}{n}") * F.col(f"_{d}{n}")
    cell = cell.withColumns({f"_det{n}": F.nullif(cross(n, "ax", "by", "ay", "bx"), F.lit(0.0)) for n in (0, 1)})
    cell = cell.withColumns({f"_{w}{n}": cross(n, *sides) / F.col(f"_det{n}") for n in (0, 1)
                             for w, sides in (("p", ("u", "by", "v", "bx")), ("q", ("ax", "v", "ay", "u")))})
    at = lambda ij: (F.col("_iy") + int(ij[0])) * lattice.nx + F.col("_ix") + int(ij[1])
    triangle = lambda n: F.struct(
        (F.col("_k") * 2 + n).alias("place"), at(fixed[n][0]).alias("s0"), at(fixed[n][1]).alias("s1"),
        F.when(F.col("_flip"), at(third[n][0])).otherwise(at(third[n][1])).alias("s2"),
        F.col(f"_p{n}").alias("w0"), F.col(f"_q{n}").alias("w1"))
    tried = cell.select(*keys, F.inline(F.array(triangle(0), triangle(1))))

    # Off-disk corners give NaN, which sorts above every number: bound both sides.
    held = tried.where(F.col("w0").between(-tolerance, 2.0) & F.col("w1").between(-tolerance, 2.0)
                       & (F.col("w0") + F.col("w1") <= 1.0 + tolerance))
    best = held.groupBy(*keys).agg(F.min(F.struct("place", "s0", "s1", "s2", "w0", "w1")).alias("_t"))
    t = lambda f: F.col(f"_t.{f}")
    return best.select(*keys, F.inline(_vertices(
        (t("s0"), t("w0")), (t("s1"), t("w1")), (t("s2"), 1 - t("w0") - t("w1")))))


def _in_circle(a: tuple, b: tuple, c: tuple, d: tuple) -> Column:
    """Sign tells whether d is inside the circle through a, b, c; points are (lat, lon)."""
    (ay, ax), (by, bx), (cy, cx) = [(p[0] - d[0], p[1] - d[1]) for p in (a, b, c)]
    a2, b2, c2 = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
    return ax * (by * c2 - b2 * cy) - ay * (bx * c2 - b2 * cx) + a2 * (bx * cy - by * cx)


def remap_compacted(weights: DataFrame, valid_sources: DataFrame) -> DataFrame:
    """Imported weights whose vertex ids count valid pixels only -> lattice ids."""
    from terralattice.operators import ordering
    numbered = ordering.with_position(valid_sources.select("source_id"), [], ["source_id"],
                                      "_vertex")
    return (weights.withColumnRenamed("source_id", "_vertex")
            .join(numbered, "_vertex").drop("_vertex"))


def per_target(weights: DataFrame, keys: list[str] = []) -> DataFrame:
    """One row per covered target with its largest and smallest weight."""
    return weights.groupBy(*keys, "target_id").agg(F.max("w").alias("max_w"), F.min("w").alias("min_w"))


def with_coverage(targets: DataFrame, weights: DataFrame, keys: list[str] = []) -> DataFrame:
    """Every target with its weight extremes; null outside the coverage."""
    return targets.join(per_target(weights, keys), [*keys, "target_id"], "left")


def interpolation_class(max_w: Column) -> Column:
    """0 direct hit, 1 interpolated, 2 no coverage."""
    return (F.when(max_w.isNull(), 2).when(max_w >= C.DIRECT_HIT_WEIGHT, 0).otherwise(1)).cast("int")


def weight_statistics(targets: DataFrame, weights: DataFrame, keys: list[str] = []) -> DataFrame:
    """Coverage, direct-hit share and weight statistics, one row per grid."""
    merged = with_coverage(targets, weights, keys)
    direct = F.when(F.col("max_w") >= C.DIRECT_HIT_WEIGHT, 1.0).when(F.col("max_w").isNotNull(), 0.0)
    zero = F.lit(0.0)
    stats = merged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_target_points"),
        F.count("max_w").alias("n_valid_points"),
        F.coalesce(F.avg(direct), zero).alias("direct_hit_fraction"),
        F.coalesce(1.0 - F.avg(direct), zero).alias("interpolated_fraction"),
        F.avg("max_w").alias("max_weight_mean"), F.stddev_pop("max_w").alias("max_weight_std"),
        F.avg("min_w").alias("min_weight_mean"), F.stddev_pop("min_w").alias("min_weight_std"))
    return stats.withColumn("coverage_fraction", F.coalesce(
        F.try_divide(F.col("n_valid_points").cast("double"), F.col("n_target_points")), zero))


def provenance(targets: DataFrame, weights: DataFrame, reference_band: int = 7, keys: list[str] = []) -> DataFrame:
    """How a grid was regridded, one row per grid."""
    stats = weight_statistics(targets, weights, keys)
    return stats.select(
        *keys, F.lit("barycentric").alias("method"), F.lit("geostationary").alias("source_projection"),
        F.lit("delaunay").alias("triangulation"),
        F.lit(C.DIRECT_HIT_WEIGHT).alias("direct_hit_threshold"),
        F.lit(C.INTEGER_EPSILON).alias("integer_epsilon"),
        "coverage_fraction", "direct_hit_fraction", "interpolated_fraction",
        F.lit(reference_band).alias("reference_band"))
