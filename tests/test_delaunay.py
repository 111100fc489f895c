"""Exact triangles against the definition: no lattice point in the circle around them, none that holds a target missed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terralattice.functions.projection import Projection
from terralattice.operators import delaunay as D, weights as W

P = Projection()
N = 61
EDGE = 0.151
LATTICE = W.Lattice(N, N, -EDGE, EDGE, 2 * EDGE / (N - 1), -2 * EDGE / (N - 1))


def lattice_points():
    iy, ix = np.divmod(np.arange(N * N), N)
    lat, lon = D.ground(LATTICE.x0 + ix * LATTICE.dx, LATTICE.y0 + iy * LATTICE.dy, P)
    return lon, lat


def limb_targets(spark, n=400):
    """Targets beyond 0.125 rad, seen and unseen."""
    rng = np.random.default_rng(3)
    angle, radius = rng.uniform(0, 2 * np.pi, n), rng.uniform(0.125, 0.1515, n)
    lat, lon = D.ground(radius * np.cos(angle), radius * np.sin(angle), P)
    ok = ~np.isnan(lat)
    return spark.createDataFrame([(i, float(a), float(o) + P.lon_origin) for i, (a, o) in enumerate(zip(lat[ok], lon[ok]))], "target_id long, lat double, lon double")


def hull_holds(points, target):
    """Whether a target lies in the hull: no gap of half a turn in the directions of the points from it."""
    d = points - target
    turn = np.sort(np.arctan2(d[:, 1], d[:, 0]))
    return np.diff(np.append(turn, turn[0] + 2 * np.pi)).max() < np.pi


def test_triangles_are_delaunay(spark):
    targets = limb_targets(spark)
    got = {}
    for r in D.exact_weights(targets, LATTICE, P, most=N).collect():
        got.setdefault(r["target_id"], []).append(r)
    lon, lat = lattice_points()
    seen = ~np.isnan(lat)
    points = np.stack([lon[seen], lat[seen]], axis=1)
    lost = 0
    for t in targets.collect():
        at = np.array([t["lon"] - P.lon_origin, t["lat"]])
        if not hull_holds(points, at):
            assert t["target_id"] not in got
            lost += 1
            continue
        rows = sorted(got[t["target_id"]], key=lambda r: r["rank"])
        ids, w = [r["source_id"] for r in rows], np.array([r["w"] for r in rows])
        corners = np.stack([lon[ids], lat[ids]], axis=1)
        assert w.min() > -1e-9 and abs(w.sum() - 1) < 1e-9 and np.abs(w @ corners - at).max() < 1e-6
        a = np.concatenate([2 * corners, np.ones((3, 1))], axis=1)
        centre = np.linalg.solve(a, (corners ** 2).sum(axis=1))
        radius2 = centre[2] + centre[0] ** 2 + centre[1] ** 2
        assert (((points - centre[:2]) ** 2).sum(axis=1) > radius2 * (1 - 1e-6) - 1e-9).all()
    assert lost >= 1 and len(got) > 200


def test_a_window_is_as_good_as_the_whole_lattice(spark):
    targets = limb_targets(spark, 300)
    whole = {(r["target_id"], r["source_id"]): r["w"] for r in D.exact_weights(targets, LATTICE, P, most=N).collect()}
    part = {(r["target_id"], r["source_id"]): r["w"] for r in D.exact_weights(targets, LATTICE, P, most=16).collect()}
    same = set(whole) & set(part)
    assert len(same) > 0.98 * len(whole) and all(abs(whole[k] - part[k]) < 1e-4 for k in same)


def test_both_ways_meet(spark):
    """Within the computed part exact triangles give the same weights; the whole disk has both."""
    rng = np.random.default_rng(8)
    spots = spark.createDataFrame([(i, float(a), float(o) + P.lon_origin) for i, (a, o) in enumerate(zip(rng.uniform(-45, 45, 200), rng.uniform(-45, 45, 200)))],
                                  "target_id long, lat double, lon double")
    rows = lambda df: {(r["target_id"], r["source_id"]): r["w"] for r in df.where("w > 1e-6").collect()}
    plain, exact, both = rows(W.geostationary_weights(spots, LATTICE, P)), rows(D.exact_weights(spots, LATTICE, P)), rows(D.full_disk_weights(spots, LATTICE, P, limb=0.1))
    assert set(plain) == set(exact) == set(both) and all(abs(plain[k] - exact[k]) < 1e-6 and abs(plain[k] - both[k]) < 1e-6 for k in plain)


def test_no_targets(spark):
    none = limb_targets(spark, 5).limit(0)
    assert D.full_disk_weights(none, LATTICE, P).isEmpty()
    hidden = spark.createDataFrame([(1, 0.0, 105.0)], "target_id long, lat double, lon double")
    assert D.full_disk_weights(hidden, LATTICE, P).isEmpty()
    assert D.full_disk_weights(hidden, LATTICE, P).columns == W.geostationary_weights(hidden, LATTICE, P).columns
