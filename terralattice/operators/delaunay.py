"""Exact interpolation triangles where the lattice bends: at the limb of the disk.

The Delaunay triangle around a target is the facet below it of the lattice points
lifted to the paraboloid: of all triangles of points that hold the target, the one
whose lifted plane is lowest there. That is a linear programme with three
constraints, solved by pivoting from any triangle that holds the target: the point
furthest below the plane comes in, and of the three corners the one goes that keeps
the target inside. Targets are solved together, each among the lattice points around
its cell; the window grows until the triangle stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from terralattice.functions import projection as P
from terralattice.operators import weights as Wt

FIRST, LAST = 4, 64  # cells on each side of the first and the largest window
FAR = 1e6  # height of the corners that stand for no point, in units of the window
CHUNK = 2_000_000  # lattice points looked at together
PIVOTS = 500


def ground(x: np.ndarray, y: np.ndarray, p: P.Projection) -> tuple[np.ndarray, np.ndarray]:
    """(lat, longitude east of the sub-point), degrees, of scan angles; NaN off the disk. As `projection.relative_latlon`."""
    sx, cx, sy, cy = np.sin(x), np.cos(x), np.sin(y), np.cos(y)
    a = sx * sx + cx * cx * (cy * cy + p.flat2 * sy * sy)
    b = -2.0 * p.orbit * cx * cy
    with np.errstate(invalid="ignore"):
        d = (-b - np.sqrt(b * b - 4.0 * a * (p.orbit ** 2 - p.r_eq ** 2))) / (2.0 * a)
        px, py, pz = d * cx * cy, -d * sx, d * cx * sy
        inward = p.orbit - px
        return np.degrees(np.arctan(p.flat2 * pz / np.sqrt(inward * inward + py * py))), np.degrees(-np.arctan(py / inward))


def _lowest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the three points whose triangle holds the origin and is lowest, and their weights; points are NaN where there is none.

    Corners -1 to -3 stand for no point; a row that keeps one lies outside its points.
    """
    n, k = x.shape
    scale = np.nanmax(np.hypot(x, y), axis=1, initial=1e-300)[:, None]
    far = np.array([[0.0, 2.0], [-1.8, -1.0], [1.8, -1.0]]) * 1e3
    px = np.concatenate([np.where(np.isnan(x), 0.0, x / scale), np.broadcast_to(far[:, 0], (n, 3))], axis=1)
    py = np.concatenate([np.where(np.isnan(y), 0.0, y / scale), np.broadcast_to(far[:, 1], (n, 3))], axis=1)
    z = np.concatenate([np.where(np.isnan(x), np.inf, (x * x + y * y) / scale ** 2), np.full((n, 3), FAR)], axis=1)
    corner = np.tile(np.arange(k, k + 3), (n, 1))
    share = np.zeros((n, 3))
    open_ = np.arange(n)
    for _ in range(PIVOTS):
        rows = open_[:, None]
        c = corner[open_]
        base = np.stack([np.ones(c.shape), px[rows, c], py[rows, c]], axis=1)  # columns are corners
        inverse = np.linalg.inv(base)
        share[open_] = inverse[:, :, 0]
        plane = np.einsum("ij,ijk->ik", z[rows, c], inverse)
        below = z[open_] - (plane[:, :1] + plane[:, 1:2] * px[open_] + plane[:, 2:] * py[open_])
        below[np.arange(len(open_))[:, None], c] = 0.0
        new = below.argmin(axis=1)
        going = below[np.arange(len(open_)), new] < -1e-12
        if not going.any():
            break
        open_, inverse, c, new = open_[going], inverse[going], c[going], new[going]
        at = np.einsum("ijk,ik->ij", inverse, np.stack([np.ones(len(new)), px[open_, new], py[open_, new]], axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(at > 1e-12, np.maximum(share[open_], 0.0) / at, np.inf)
        corner[open_, ratio.argmin(axis=1)] = new
    return np.where(corner < k, corner, k - 1 - corner), share


def triangles(lat: np.ndarray, lon: np.ndarray, cy: np.ndarray, cx: np.ndarray, lattice: Wt.Lattice, p: P.Projection,
              most: int = LAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Source pixels and weights of the triangle around each target, and which targets have one."""
    source, share = np.full((len(lat), 3), -1, np.int64), np.zeros((len(lat), 3))
    left, reach = np.arange(len(lat)), min(FIRST, most)
    while len(left):
        side = np.arange(-reach, reach + 2)
        again = []
        for part in np.array_split(left, max(1, len(left) * len(side) ** 2 // CHUNK)):
            iy, ix = np.broadcast_arrays(cy[part, None, None] + side[:, None], cx[part, None, None] + side[None, :])
            iy, ix = iy.reshape(len(part), -1), ix.reshape(len(part), -1)
            glat, glon = ground(lattice.x0 + ix * lattice.dx, lattice.y0 + iy * lattice.dy, p)
            glat = np.where((iy < 0) | (iy >= lattice.ny) | (ix < 0) | (ix >= lattice.nx), np.nan, glat)
            glon = np.where(np.isnan(glat), np.nan, glon)
            corner, w = _lowest(glon - lon[part, None], glat - lat[part, None])
            ids = np.where(corner >= 0, np.take_along_axis(iy * lattice.nx + ix, np.maximum(corner, 0), axis=1), -1)
            same = (np.sort(ids, axis=1) == np.sort(source[part], axis=1)).all(axis=1) & (ids >= 0).all(axis=1)
            source[part], share[part] = ids, w
            again.append(part[~same])
        left = np.concatenate(again) if reach < most else left[:0]
        reach = min(2 * reach, most)
    return source, share, (source >= 0).all(axis=1)


def exact_weights(targets: DataFrame, lattice: Wt.Lattice, p: P.Projection, keys: list[str] = ["target_id"], most: int = LAST) -> DataFrame:
    """Weights of (lat, lon) targets by exact Delaunay triangles of the lattice points in lat/lon, as `geostationary_weights` gives.

    Visible targets within the hull of the points around them have weights, others
    none. A triangle has its corners within `most` cells of the target. Targets are
    solved where they are read; no row is moved.
    """
    x, y, visible = P.latlon_to_scan(F.col("lat"), F.col("lon"), p)
    located = targets.withColumns({"_x": x, "_y": y, "_seen": visible}).where("_seen").select(
        *keys, F.col("lat").cast("double").alias("_lat"), P.wrap_lon(F.col("lon") - F.lit(p.lon_origin)).cast("double").alias("_lon"),
        F.floor((F.col("_y") - F.lit(lattice.y0)) / F.lit(lattice.dy)).cast("long").alias("_cy"),
        F.floor((F.col("_x") - F.lit(lattice.x0)) / F.lit(lattice.dx)).cast("long").alias("_cx"))
    fields = [located.schema[k] for k in keys] + [T.StructField(f"s{i}", T.LongType()) for i in range(3)] + [T.StructField(f"w{i}", T.DoubleType()) for i in range(3)]
    schema = to_arrow_schema(T.StructType(fields))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                source, share, found = triangles(*[batch.column(c).to_numpy() for c in ("_lat", "_lon", "_cy", "_cx")], lattice, p, most)
                kept = batch.filter(pa.array(found))
                arrays = [pa.array(source[found][:, i]) for i in range(3)] + [pa.array(share[found][:, i]) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*[kept.column(k).cast(schema.field(k).type) for k in keys], *arrays], schema=schema)
    solved = located.mapInArrow(each, T.StructType(fields))
    return solved.select(*keys, F.inline(Wt._vertices(*[(F.col(f"s{i}"), F.col(f"w{i}")) for i in range(3)])))


def full_disk_weights(targets: DataFrame, lattice: Wt.Lattice, p: P.Projection, keys: list[str] = ["target_id"], limb: float = 0.12) -> DataFrame:
    """Computed weights up to `limb` radians from the sub-point and exact triangles beyond, so that no target inside the hull is lost."""
    x, y, _ = P.latlon_to_scan(F.col("lat"), F.col("lon"), p)
    outer = x * x + y * y > limb * limb
    return Wt.geostationary_weights(targets.where(~outer), lattice, p, keys).unionByName(exact_weights(targets.where(outer), lattice, p, keys))
