"""Imagery queries: grids, weights, regridding, bands, statistics, recipes, store, streams."""

from __future__ import annotations


from pyspark.sql import functions as F

from terralattice import constants as C, dims, schemas, session
from terralattice.functions import projection as P, recipes, scalars as S
from terralattice.operators import (bands as B, catalog, delaunay as De, grid as G, ordering, regrid as R, reshape,
                                    statistics as St, store, tiles as Ti, validate, weights as Wt)
from terralattice.plans import fixtures as X
from terralattice.plans.registry import query
from terralattice.sinks import tables as sinks
from terralattice.sources import tables as T
from terralattice.streaming import frames as Fr, ingest

with_ctes = X.with_ctes
_FRAME = ["vec_id", "band"]


def _r6(c: str, name: str | None = None):
    return F.round(S.nan_to_null(F.col(c)), 6).alias(name or c)


def _sql6(e: str) -> str:
    return f"round(CASE WHEN NOT isnan({e}) THEN {e} END, 6)"


# --- regridding -------------------------------------------------------------


def regridded(spark, d, strict: bool = False):
    """Both products of every frame of the derived raster, on all targets."""
    pixels, w = X.raster(spark, d), X.weights(spark)
    frames = X.table(spark, d, "embeddings").select("vec_id", (F.col("label") + 7).cast("int").alias("band"))
    return R.regrid(pixels, w, _FRAME, ["cmi"], ["dqf"], strict=strict, every=(frames, X.targets(spark)))


@query("agg02_regrid_cmi", with_ctes("regridded", f"""
SELECT vec_id, band, target_id, {_sql6('cmi')} AS cmi FROM regridded"""))
def regrid_cmi(spark, d):
    return regridded(spark, d).select("vec_id", "band", "target_id", _r6("cmi"))


@query("scl07_regrid_dqf", with_ctes("regridded", "SELECT vec_id, target_id, dqf FROM regridded"))
def _(spark, d):
    return regridded(spark, d).select("vec_id", "target_id", "dqf")


@query("scl07_regrid_dqf_strict", with_ctes("raster weights", """
SELECT r.vec_id, w.target_id, CAST(CASE WHEN max(w.max_w) >= 0.999 THEN CASE WHEN bool_or(w.dominant AND isnan(r.dqf)) THEN 6
    ELSE max(CASE WHEN w.dominant THEN r.dqf END) END
  WHEN bool_or(isnan(r.dqf)) THEN 6 WHEN min(r.dqf) = max(r.dqf) THEN min(r.dqf) ELSE 5 END AS SMALLINT) AS dqf
FROM raster r JOIN weights w USING (source_id) GROUP BY r.vec_id, w.target_id"""))
def _(spark, d):
    found = R.regrid(X.raster(spark, d), X.weights(spark), _FRAME, [], ["dqf"], strict=True)
    return found.select("vec_id", "target_id", "dqf")


@query("jon01_gather_tiled", with_ctes("regridded", f"""
SELECT vec_id, band, target_id, {_sql6('cmi')} AS cmi, dqf FROM regridded WHERE target_id IN (SELECT target_id FROM weights)"""))
def _(spark, d):
    own = session.gridding_session(spark)
    tiled = R.tile_weights(X.weights(own), X.NX, tile=4)
    found = R.regrid_tiled(X.raster(own, d), tiled, _FRAME, ["cmi"], ["dqf"], nx=X.NX, tile=4, salts=4)
    return found.select("vec_id", "band", "target_id", _r6("cmi"), "dqf")


@query("jon02_all_targets", with_ctes("regridded", """
SELECT vec_id, band, count(*) AS targets, count(*) FILTER (isnan(cmi)) AS missing, count(*) FILTER (dqf = 3) AS outside
FROM regridded GROUP BY 1, 2"""))
def _(spark, d):
    pixels, w = X.raster(spark, d), X.weights(spark)
    full = R.regrid(pixels, w, _FRAME, ["cmi"], ["dqf"], every=(pixels.select(*_FRAME).distinct(), X.targets(spark)))
    return full.groupBy(*_FRAME).agg(F.count(F.lit(1)).alias("targets"), F.count_if(F.isnan("cmi")).alias("missing"),
                                     F.count_if(F.col("dqf") == 3).alias("outside"))


@query("jon01_two_grids", with_ctes("raster weights", """
, grids AS (SELECT 'fine' AS grid_id, target_id, source_id, w, dominant, max_w FROM weights UNION ALL SELECT 'coarse', target_id, source_id, w, dominant, max_w FROM weights WHERE target_id % 2 = 0)
SELECT b.grid_id, r.vec_id, b.target_id, round(CASE WHEN NOT isnan(sum(b.w*r.cmi)) THEN sum(b.w*r.cmi) END, 6) AS cmi
FROM raster r JOIN grids b ON b.source_id = r.source_id AND b.grid_id = CASE WHEN r.vec_id % 3 = 0 THEN 'fine' ELSE 'coarse' END GROUP BY 1, 2, 3"""))
def _(spark, d):
    w = X.weights(spark)
    both = w.withColumn("grid_id", F.lit("fine")).unionByName(w.where("target_id % 2 = 0").withColumn("grid_id", F.lit("coarse")))
    pixels = X.raster(spark, d).withColumn("grid_id", F.when(F.col("vec_id") % 3 == 0, "fine").otherwise("coarse"))
    return R.regrid(pixels, both, ["vec_id"], ["cmi"]).select("grid_id", "vec_id", "target_id", _r6("cmi"))


@query("jon01_two_grids_tiled", with_ctes("regridded weights", """
SELECT g.grid_id, r.vec_id, r.target_id, round(CASE WHEN NOT isnan(r.cmi) THEN r.cmi END, 6) AS cmi, r.dqf
FROM regridded r, (VALUES ('fine', 1), ('coarse', 2)) AS g(grid_id, step)
WHERE r.target_id % g.step = 0 AND r.target_id IN (SELECT target_id FROM weights)"""))
def _(spark, d):
    own = session.gridding_session(spark)
    w = X.weights(own)
    both = w.withColumn("grid_id", F.lit("fine")).unionByName(w.where("target_id % 2 = 0").withColumn("grid_id", F.lit("coarse")))
    found = R.regrid_tiled(X.raster(own, d), R.tile_weights(both, X.NX, tile=4), ["vec_id"], ["cmi"], ["dqf"], nx=X.NX, tile=4, salts=4)
    return found.select("grid_id", "vec_id", "target_id", _r6("cmi"), "dqf")


_BUCKETED_FRAMES = 4096  # in eight buckets


def _sum16(alias: str, b: int) -> str:
    return f"round(CASE WHEN NOT isnan(sum(w * {alias}.cmi_c{b:02d})) THEN sum(w * {alias}.cmi_c{b:02d}) END, 6) AS cmi_c{b:02d}"


@query("jon01_bucketed_join", with_ctes("raster weights", f"""
SELECT r.vec_id, w.target_id, round(CASE WHEN NOT isnan(sum(w.w*r.cmi)) THEN sum(w.w*r.cmi) END, 6) AS cmi
FROM raster r JOIN weights w USING (source_id) GROUP BY 1, 2"""))
def bucketed_join(spark, d):
    """Weights and pixels stored with the same buckets, so that their join moves neither."""
    own, names = session.gridding_session(spark), {}
    parts = max(1, -(-X.table(own, d, "embeddings").count() // _BUCKETED_FRAMES))
    w = X.weights(own).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pixels = X.raster(own, d).select("vec_id", "source_id", "cmi", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"))
    for label, df in (("weights", w), ("pixels", pixels)):
        path = session.scratch_path(own, f"bucketed_{label}")
        names[label] = path.rsplit("/", 1)[1].replace("-", "_")
        sinks.save_bucketed(df, names[label], 8 * parts, path, ("part", "source_id"))
    return R.regrid(own.table(names["pixels"]), own.table(names["weights"]).hint("merge"), ["vec_id"], ["cmi"]).select("vec_id", "target_id", _r6("cmi"))


@query("snk09_source_mask", with_ctes("raster", """
SELECT 'g' || band AS grid_id, source_id FROM raster WHERE NOT isnan(cmi) GROUP BY 1, 2"""))
def _(spark, d):
    path = session.scratch_path(spark, "masked-weights")
    mask = X.raster(spark, d).where(~F.isnan("cmi")).select(F.concat(F.lit("g"), F.col("band").cast("string")).alias("grid_id"), "source_id")
    sinks.write_weights(X.weights(spark).withColumn("grid_id", F.lit("g7")), path, mask=mask)
    return T.source_mask(spark, path)


def _array_frames(spark, d):
    """The derived raster as one row-major array per frame and product."""
    pixels = X.raster(spark, d)
    whole = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("source_id", c))), lambda p: p[c])
    return pixels.groupBy("vec_id", "band").agg(whole("cmi").alias("cmi"), whole("dqf").alias("dqf"))


def _by_target(arrays, keys):
    flat = arrays.select(*keys, F.posexplode(F.arrays_zip("cmi", "dqf")).alias("target_id", "_v"))
    return flat.select(*keys, F.col("target_id").cast("long").alias("target_id"), F.round(S.nan_to_null(F.col("_v.cmi")), 6).alias("cmi"), F.col("_v.dqf").alias("dqf"))


@query("udf02_array_frames", with_ctes("regridded", f"SELECT vec_id, band, target_id, {_sql6('cmi')} AS cmi, dqf FROM regridded"))
def _(spark, d):
    own = session.gridding_session(spark)
    packed = session.materialize(Ti.pack_weights(X.weights(own), X.NX, 4), "packed-weights")
    return _by_target(Ti.regrid_arrays(_array_frames(own, d), packed, _FRAME, ["cmi"], ["dqf"], X.NX, X.NY, 289, 4), _FRAME)


@query("udf02_array_cubes", with_ctes("regridded", f"""
SELECT vec_id // 16 AS cube, row_number() OVER (PARTITION BY vec_id // 16, target_id ORDER BY vec_id) - 1 AS step, target_id, {_sql6('cmi')} AS cmi, dqf
FROM regridded"""))
def _(spark, d):
    """Frames of sixteen vectors as one array over time."""
    own = session.gridding_session(spark)
    frames = _array_frames(own, d).groupBy(F.floor(F.col("vec_id") / 16).alias("cube")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "cmi", "dqf"))).alias("f"))
    cubes = frames.select("cube", F.transform("f", lambda f: f["cmi"]).alias("cmi"), F.transform("f", lambda f: f["dqf"]).alias("dqf"))
    packed = session.materialize(Ti.pack_weights(X.weights(own), X.NX, 4), "packed-weights")
    out = Ti.regrid_cubes(cubes, packed, ["cube"], ["cmi"], ["dqf"], X.NX, X.NY, 289, 4)
    steps = out.select("cube", F.posexplode(F.arrays_zip("cmi", "dqf")).alias("step", "_v")).select("cube", F.col("step").cast("long").alias("step"), "_v.cmi", "_v.dqf")
    return _by_target(steps, ["cube", "step"])


@query("udf03_regrid_all_bands", with_ctes("pixels16", """
, small AS (SELECT unnest([0, 0, 0, 1, 1, 1]) AS target_id, unnest([0, 1, 2, 3, 2, 1]) AS source_id, unnest([0.5, 0.25, 0.25, 1.0, 0.0, 0.0]::DOUBLE[]) AS w)
SELECT p.vec_id, target_id, """ + ", ".join(_sum16("p", b) for b in C.ALL_BANDS) + """
FROM pixels16 p JOIN small USING (source_id) GROUP BY 1, 2"""))
def _(spark, d):
    own = session.gridding_session(spark)
    point = lambda i, s, t: F.when(F.col("id") == i, s).otherwise(t).cast("double")
    spots = own.range(2).select(F.col("id").alias("target_id"), point(0, 0.25, 1).alias("tx"), point(0, 0.25, 1).alias("ty"))
    w = Wt.lattice_weights(spots, "tx", "ty", 2, 2)
    cmi = [f"cmi_c{b:02d}" for b in C.ALL_BANDS]
    found = R.regrid(X.pixels16(own, d), w, ["vec_id"], cmi)
    return found.select("vec_id", F.col("target_id").cast("int").alias("target_id"), *[_r6(c) for c in cmi])


def _flag_sql(b: int) -> str:
    blend = f"q{b}"
    return (f"CAST(CASE WHEN m IS NULL THEN 3 WHEN m >= 0.999 THEN d{b} WHEN abs({blend} - round_even({blend}, 0)) < 1e-6 "
            f"THEN round_even({blend}, 0) ELSE 5 END AS SMALLINT) AS dqf_c{b:02d}")


# A whole observation: 16 bands and 16 flags on all targets, with platform and scan mode.
@query("udf03_whole_observation", with_ctes("pixels16", """
, small AS (SELECT i*5+j AS target_id, CAST(-0.5+0.5*i AS DOUBLE) AS ty, CAST(-0.5+0.5*j AS DOUBLE) AS tx FROM range(5) a(i), range(5) b(j))
, w2 AS (""" + X.weights_sql("small", 2) + """)
, g AS (SELECT p.vec_id, w2.target_id, """ + ", ".join(
    f"sum(w*cmi_c{b:02d}) AS s{b}, sum(w*dqf_c{b:02d}) AS q{b}, max(CASE WHEN dominant THEN dqf_c{b:02d} END) AS d{b}" for b in C.ALL_BANDS) + """
  FROM pixels16 p JOIN w2 USING (source_id) GROUP BY 1, 2)
SELECT e.vec_id, 'G1' || (6 + e.vec_id % 4) AS platform_id, CASE WHEN e.vec_id % 2 = 0 THEN 'ABI Mode 6' ELSE 'unknown' END AS scan_mode, t.target_id, """ + ", ".join(
    f"round(CASE WHEN NOT isnan(s{b}) THEN s{b} END, 6) AS cmi_c{b:02d}, {_flag_sql(b)}" for b in C.ALL_BANDS) + """
FROM embeddings e CROSS JOIN small t LEFT JOIN (SELECT target_id, max(max_w) AS m FROM w2 GROUP BY 1) c ON c.target_id = t.target_id
LEFT JOIN g ON g.vec_id = e.vec_id AND g.target_id = t.target_id"""))
def _(spark, d):
    own = session.gridding_session(spark)
    targets = X.small_targets(own)
    cmi, dqf = [[f"{kind}_c{b:02d}" for b in C.ALL_BANDS] for kind in ("cmi", "dqf")]
    frames = X.table(own, d, "embeddings").select("vec_id")
    found = R.regrid(X.pixels16(own, d), Wt.lattice_weights(targets, "tx", "ty", 2, 2), ["vec_id"], cmi, dqf, every=(frames, targets))
    seen = frames.select("vec_id", F.concat(F.lit("G1"), (6 + F.col("vec_id") % 4).cast("string")).alias("platform_id"),
                         F.when(F.col("vec_id") % 2 == 0, "ABI Mode 6").alias("scan_mode"))
    return R.observation_rows(found, seen, ["vec_id"]).select("vec_id", "platform_id", "scan_mode", "target_id", *[_r6(c) for c in cmi], *dqf)


@query("udf04_preprocess_hook", with_ctes("pixels16", f"""
SELECT vec_id, source_id, {_sql6('cmi_c13 - 273.15')} AS cmi_c13 FROM pixels16"""))
def _(spark, d):
    celsius = lambda df: df.withColumn("cmi_c13", F.col("cmi_c13") - 273.15)
    return X.pixels16(spark, d).transform(celsius).select("vec_id", "source_id", _r6("cmi_c13"))


# --- weights ----------------------------------------------------------------


_COVER = """, merged AS (SELECT s.target_id, s.grid, max(w.w) AS max_w, min(w.w) AS min_w
  FROM stations s LEFT JOIN station_weights w USING (target_id) GROUP BY 1, 2)
"""


@query("jon03_station_weights", with_ctes("station_weights", """
SELECT target_id, rank, source_id, w, dominant, max_w FROM station_weights"""))
def _(spark, d):
    return X.station_weights(spark, d).select("target_id", "rank", "source_id", "w", "dominant", "max_w")


@query("win07_dominant_vertex", with_ctes("station_weights", "SELECT target_id, source_id, w FROM station_weights WHERE dominant"))
def _(spark, d):
    return X.station_weights(spark, d).where("dominant").select("target_id", "source_id", "w")


@query("win07_imported_weights", with_ctes("station_weights", "SELECT target_id, rank, source_id, w, dominant, max_w FROM station_weights"))
def _(spark, d):
    imported = X.station_weights(spark, d).select("target_id", "rank", "source_id", "w")
    ranked = Wt.prepare(imported)
    return ranked.select("target_id", "rank", "source_id", "w", "dominant", "max_w")


@query("snk09_persisted_weights", with_ctes("station_weights", _COVER + """
SELECT CAST(grid AS VARCHAR) AS grid_id, 'barycentric' AS method, CAST(7 AS INT) AS reference_band, count(max_w) * 3 AS rows,
  round(count(max_w) / CAST(count(*) AS DOUBLE), 9) AS coverage_fraction FROM merged GROUP BY 1"""))
def _(spark, d):
    path = session.scratch_path(spark, "grids")
    s, w = X.stations(spark, d), X.station_weights(spark, d)
    told = Wt.provenance(s.select("target_id", "grid"), w, 7, ["grid"]).withColumn("grid_id", F.col("grid").cast("string"))
    sinks.write_weights(w.withColumn("grid_id", F.col("grid").cast("string")).drop("grid"), path, told.drop("grid"))
    rows = T.load_weights(spark, path).groupBy("grid_id").agg(F.count("*").alias("rows"))
    return T.weights_metadata(spark, path).join(rows, "grid_id").select(
        "grid_id", "method", "reference_band", "rows", F.round("coverage_fraction", 9).alias("coverage_fraction"))


@query("src11_weights_roundtrip", with_ctes("station_weights", "SELECT target_id, rank, source_id, w FROM station_weights"))
def _(spark, d):
    path = session.scratch_path(spark, "weights")
    sinks.write_weights(X.station_weights(spark, d).drop("grid").withColumn("grid_id", F.lit("stations")), path)
    return T.load_weights(spark, path, "stations").select("target_id", "rank", "source_id", "w")


@query("agg03_coverage", with_ctes("station_weights", _COVER + """
SELECT grid, count(*) AS n_target_points, count(max_w) AS n_valid_points, round(count(max_w) / CAST(count(*) AS DOUBLE), 9) AS coverage_fraction
FROM merged GROUP BY grid"""))
def _(spark, d):
    s = X.stations(spark, d)
    w = X.station_weights(spark, d)
    stats = Wt.weight_statistics(s.select("target_id", "grid"), w, ["grid"])
    return stats.select("grid", "n_target_points", "n_valid_points", F.round("coverage_fraction", 9).alias("coverage_fraction"))


@query("agg05_weight_statistics", with_ctes("station_weights", _COVER + """
SELECT grid, round(avg(max_w), 9) AS max_weight_mean, round(stddev_pop(max_w), 9) AS max_weight_std,
  round(avg(min_w), 9) AS min_weight_mean, round(stddev_pop(min_w), 9) AS min_weight_std,
  round(avg(CASE WHEN max_w >= 0.999 THEN 1.0::DOUBLE WHEN max_w IS NOT NULL THEN 0 END), 9) AS direct_hit_fraction,
  round(1 - avg(CASE WHEN max_w >= 0.999 THEN 1.0::DOUBLE WHEN max_w IS NOT NULL THEN 0 END), 9) AS interpolated_fraction
FROM merged GROUP BY grid"""))
def _(spark, d):
    s = X.stations(spark, d)
    w = X.station_weights(spark, d)
    names = ("max_weight_mean", "max_weight_std", "min_weight_mean", "min_weight_std", "direct_hit_fraction", "interpolated_fraction")
    return Wt.weight_statistics(s.select("target_id", "grid"), w, ["grid"]).select(
        "grid", *[F.round(c, 9).alias(c) for c in names])


@query("prj15_provenance", with_ctes("station_weights", _COVER + """
SELECT grid, 'barycentric' AS method, 0.999::DOUBLE AS direct_hit_threshold, CAST(7 AS INT) AS reference_band,
  round(count(max_w) / CAST(count(*) AS DOUBLE), 9) AS coverage_fraction FROM merged GROUP BY grid"""))
def _(spark, d):
    s = X.stations(spark, d)
    w = X.station_weights(spark, d)
    p = Wt.provenance(s.select("target_id", "grid"), w, 7, ["grid"])
    return p.select("grid", "method", "direct_hit_threshold", "reference_band",
                    F.round("coverage_fraction", 9).alias("coverage_fraction"))


@query("scl08_interpolation_map", with_ctes("station_weights", _COVER + """
SELECT target_id, CAST(CASE WHEN max_w IS NULL THEN 2 WHEN max_w >= 0.999 THEN 0 ELSE 1 END AS INT) AS interpolation FROM merged"""))
def _(spark, d):
    merged = Wt.with_coverage(X.stations(spark, d), X.station_weights(spark, d))
    return merged.select("target_id", Wt.interpolation_class(F.col("max_w")).alias("interpolation"))


@query("scl09_coverage_map", with_ctes("station_weights", _COVER + "SELECT target_id, max_w IS NOT NULL AS covered FROM merged"))
def _(spark, d):
    merged = Wt.with_coverage(X.stations(spark, d), X.station_weights(spark, d))
    return merged.select("target_id", F.col("max_w").isNotNull().alias("covered"))


@query("flt12_outside_targets", with_ctes("stations", """
SELECT target_id FROM stations WHERE NOT (tx BETWEEN 0 AND 7 AND ty BETWEEN 0 AND 7)"""))
def _(spark, d):
    return catalog.not_yet_known(X.stations(spark, d), X.station_weights(spark, d), ["target_id"]).select("target_id")


# --- projection and grids ---------------------------------------------------

_P = P.Projection()
_F2 = f"CAST({_P.flat2!r} AS DOUBLE)"
_H, _ORIGIN = f"CAST({_P.orbit!r} AS DOUBLE)", f"CAST({_P.lon_origin!r} AS DOUBLE)"


def _latlon_sql(source: str, keys: str, x: str, y: str) -> str:
    """Inverse navigation in SQL: keys, lat, dlon."""
    return f"""
SELECT {keys}, degrees(atan({_F2}*sz/sqrt((h-sx)*(h-sx)+sy*sy))) AS lat, degrees(-atan(sy/(h-sx))) AS dlon
FROM (SELECT {keys}, h, rs*cos({x})*cos({y}) AS sx, -rs*sin({x}) AS sy, rs*cos({x})*sin({y}) AS sz
  FROM (SELECT *, CASE WHEN b*b-4*a*c < 0 THEN CAST('NaN' AS DOUBLE) ELSE (-b-sqrt(greatest(b*b-4*a*c, 0)))/(2*a) END AS rs
    FROM (SELECT *, {_H} AS h, pow(sin({x}),2)+pow(cos({x}),2)*(pow(cos({y}),2)+{_F2}*pow(sin({y}),2)) AS a,
      -2*{_H}*cos({x})*cos({y}) AS b, CAST({_P.orbit ** 2 - _P.r_eq ** 2!r} AS DOUBLE) AS c FROM {source})))"""


@query("scl01_fixed_grid_to_latlon", with_ctes("scan_pixels", f"""
, ll AS ({_latlon_sql('scan_pixels', 'o_orderkey', 'x', 'y')})
SELECT o_orderkey, {_sql6('lat')} AS lat, {_sql6('dlon + ' + _ORIGIN)} AS lon FROM ll"""))
def _(spark, d):
    p = X.scan_pixels(spark, d)
    lat, lon = P.scan_to_latlon(F.col("x"), F.col("y"), _P)
    return p.select("o_orderkey", lat.alias("lat"), lon.alias("lon")).select("o_orderkey", _r6("lat"), _r6("lon"))


@query("scl01_roundtrip", with_ctes("scan_pixels", f"""
, ll AS ({_latlon_sql('scan_pixels', 'o_orderkey, x, y', 'x', 'y')})
SELECT o_orderkey, round(x, 9) AS x, round(y, 9) AS y, true AS visible FROM ll WHERE NOT isnan(lat)"""))
def _(spark, d):
    lat, lon = P.scan_to_latlon(F.col("x"), F.col("y"), _P)
    ll = X.scan_pixels(spark, d).select("o_orderkey", lat.alias("lat"), lon.alias("lon")).where(~F.isnan("lat"))
    x, y, seen = P.latlon_to_scan(F.col("lat"), F.col("lon"), _P)
    return ll.select("o_orderkey", F.round(x, 9).alias("x"), F.round(y, 9).alias("y"), seen.alias("visible"))


@query("scl21_pixel_weight", with_ctes("scan_pixels", "SELECT o_orderkey, round(cos(x)*cos(y), 9) AS weight FROM scan_pixels"))
def _(spark, d):
    return X.scan_pixels(spark, d).select("o_orderkey", F.round(S.pixel_weight(F.col("x"), F.col("y")), 9).alias("weight"))


@query("flt11_on_disk_pixels", with_ctes("scan_pixels", f"""
, ll AS ({_latlon_sql('scan_pixels', 'o_orderkey', 'x', 'y')})
SELECT o_orderkey FROM ll WHERE NOT isnan(lat) AND NOT isnan(dlon)"""))
def _(spark, d):
    lat, lon = P.scan_to_latlon(F.col("x"), F.col("y"), _P)
    return X.scan_pixels(spark, d).where(S.finite(lat) & S.finite(lon)).select("o_orderkey")


@query("flt13_bounding_box", with_ctes("scan_pixels", f"""
, ll AS ({_latlon_sql('scan_pixels', 'o_orderkey', 'x', 'y')})
SELECT o_orderkey FROM ll WHERE lat BETWEEN -20.05 AND 30.05 AND dlon + {_ORIGIN} BETWEEN -100.05 AND -60.05"""))
def _(spark, d):
    lat, lon = P.scan_to_latlon(F.col("x"), F.col("y"), _P)
    points = X.scan_pixels(spark, d).select("o_orderkey", lat.alias("lat"), lon.alias("lon"))
    return G.within_bounds(points, -100.05, -60.05, -20.05, 30.05).select("o_orderkey")


_LATTICE = Wt.Lattice(nx=543, ny=543, x0=-0.15176, y0=0.15176, dx=0.00056, dy=-0.00056)
_EB = f"CAST({1.0 - 1.0 / _P.flat2!r} AS DOUBLE)"
_CORNERS_SQL = f"""
, forward AS (SELECT target_id, lat, lon - {_ORIGIN} - 360*floor((lon - {_ORIGIN} + 180)/360) AS dlon FROM places)
, seen AS (SELECT *, {_H} - rc*cos(pc)*cos(radians(dlon)) AS sx, -rc*cos(pc)*sin(radians(dlon)) AS sy, rc*sin(pc) AS sz
  FROM (SELECT *, CAST({_P.r_pol!r} AS DOUBLE)/sqrt(1-{_EB}*cos(pc)*cos(pc)) AS rc FROM (SELECT *, atan(tan(radians(lat))/{_F2}) AS pc FROM forward)))
, cell AS (SELECT target_id, lat, dlon, CAST(floor((asin(-sy/sqrt(sx*sx+sy*sy+sz*sz)) - ({_LATTICE.x0!r}::DOUBLE))/({_LATTICE.dx!r}::DOUBLE)) AS BIGINT) AS cx,
    CAST(floor((atan(sz/sx) - ({_LATTICE.y0!r}::DOUBLE))/({_LATTICE.dy!r}::DOUBLE)) AS BIGINT) AS cy
  FROM seen WHERE {_H}*({_H}-sx) >= sy*sy + {_F2}*sz*sz)
, cand AS (SELECT target_id, lat AS tlat, dlon AS tlon, k, cy + k//3 - 1 AS iy, cx + k%3 - 1 AS ix FROM cell, range(9) r(k))
, pts AS (SELECT DISTINCT iy + a AS py, ix + b AS px FROM cand, range(2) ra(a), range(2) rb(b)
  WHERE iy + a BETWEEN 0 AND {_LATTICE.ny - 1} AND ix + b BETWEEN 0 AND {_LATTICE.nx - 1})
, ang AS (SELECT py, px, {_LATTICE.x0!r}::DOUBLE + px*{_LATTICE.dx!r}::DOUBLE AS x, {_LATTICE.y0!r}::DOUBLE + py*({_LATTICE.dy!r}::DOUBLE) AS y FROM pts)
, node AS ({_latlon_sql('ang', 'py, px', 'x', 'y')})
, quad AS (SELECT c.*, q00.lat AS la00, q00.dlon AS lo00, q01.lat AS la01, q01.dlon AS lo01, q10.lat AS la10, q10.dlon AS lo10, q11.lat AS la11, q11.dlon AS lo11
  FROM cand c LEFT JOIN node q00 ON q00.py=c.iy AND q00.px=c.ix LEFT JOIN node q01 ON q01.py=c.iy AND q01.px=c.ix+1
  LEFT JOIN node q10 ON q10.py=c.iy+1 AND q10.px=c.ix LEFT JOIN node q11 ON q11.py=c.iy+1 AND q11.px=c.ix+1)
, circ AS (SELECT *, (lo00-lo11) AS ax, (la00-la11) AS ay, (lo01-lo11) AS bx, (la01-la11) AS by_, (lo10-lo11) AS gx, (la10-la11) AS gy FROM quad)
, flip AS (SELECT *, coalesce(ax*(by_*(gx*gx+gy*gy) - (bx*bx+by_*by_)*gy) - ay*(bx*(gx*gx+gy*gy) - (bx*bx+by_*by_)*gx)
   + (ax*ax+ay*ay)*(bx*gy - by_*gx) < 0, false) OR la01 IS NULL OR isnan(la01) OR la10 IS NULL OR isnan(la10) AS f FROM circ)
, tri AS (
  SELECT target_id, tlat, tlon, 2*k AS place, iy*{_LATTICE.nx}+ix AS s0, iy*{_LATTICE.nx}+ix+1 AS s1,
    CASE WHEN f THEN (iy+1)*{_LATTICE.nx}+ix+1 ELSE (iy+1)*{_LATTICE.nx}+ix END AS s2,
    la00 AS aa, lo00 AS ao, la01 AS ba, lo01 AS bo, CASE WHEN f THEN la11 ELSE la10 END AS ca, CASE WHEN f THEN lo11 ELSE lo10 END AS co FROM flip
  UNION ALL
  SELECT target_id, tlat, tlon, 2*k+1, (iy+1)*{_LATTICE.nx}+ix+1, (iy+1)*{_LATTICE.nx}+ix,
    CASE WHEN f THEN iy*{_LATTICE.nx}+ix ELSE iy*{_LATTICE.nx}+ix+1 END,
    la11, lo11, la10, lo10, CASE WHEN f THEN la00 ELSE la01 END, CASE WHEN f THEN lo00 ELSE lo01 END FROM flip)
, bary AS (SELECT *, ((tlon-co)*(ba-ca) - (tlat-ca)*(bo-co))/det AS w0, ((ao-co)*(tlat-ca) - (aa-ca)*(tlon-co))/det AS w1
  FROM (SELECT *, (ao-co)*(ba-ca) - (aa-ca)*(bo-co) AS det FROM tri) WHERE det <> 0 AND NOT isnan(det))
, hit AS (SELECT target_id, s0, s1, s2, w0, w1, 1-w0-w1 AS w2 FROM bary WHERE w0 >= -1e-9 AND w1 >= -1e-9 AND 1-w0-w1 >= -1e-9
  QUALIFY row_number() OVER (PARTITION BY target_id ORDER BY place) = 1)
SELECT target_id, unnest([0, 1, 2])::INT AS rank, unnest([s0, s1, s2]) AS source_id, round(unnest([w0, w1, w2]), 6) AS w FROM hit"""


# A property the weights must have, told without them: the weighted vertices lie on the target.
def _reproduced_sql(limit: float) -> str:
    return with_ctes("places", _CORNERS_SQL[:_CORNERS_SQL.index(", cell AS")] + f"""
, near AS (SELECT target_id, {_H}*({_H}-sx) >= sy*sy + {_F2}*sz*sz
  AND pow(asin(-sy/sqrt(sx*sx+sy*sy+sz*sz)), 2) + pow(atan(sz/sx), 2) <= {limit} AS near FROM seen)
SELECT target_id, near, round(CASE WHEN near THEN lat END, 6) AS lat, round(CASE WHEN near THEN lon - {_ORIGIN} - 360*floor((lon - {_ORIGIN} + 180)/360) END, 6) AS lon
FROM places JOIN near USING (target_id)""")


def _reproduced(spark, d, make, limit: float):
    """Targets from the weighted places of their vertices, out to a scan angle."""
    targets = X.places(spark, d)
    x, y, visible = P.latlon_to_scan(F.col("lat"), F.col("lon"), _P)
    near = targets.select("target_id", (visible & (x * x + y * y <= limit)).alias("near"))
    w = make(targets, _LATTICE, _P)
    iy, ix = F.floor(F.col("source_id") / _LATTICE.nx), F.col("source_id") % _LATTICE.nx
    lat, lon = P.scan_to_latlon(F.lit(_LATTICE.x0) + ix * F.lit(_LATTICE.dx), F.lit(_LATTICE.y0) + iy * F.lit(_LATTICE.dy), _P)
    east = P.wrap_lon(lon - F.lit(_P.lon_origin))
    met = w.groupBy("target_id").agg(F.sum(F.col("w") * lat).alias("lat"), F.sum(F.col("w") * east).alias("lon"))
    shown = lambda c: F.when(F.col("near"), F.round(c, 6)).alias(c)
    return near.join(met, "target_id", "left").select("target_id", "near", shown("lat"), shown("lon"))


@query("jon03_weights_reproduce_targets", _reproduced_sql(0.0144))
def _(spark, d):
    return _reproduced(spark, d, Wt.geostationary_weights, 0.0144)


@query("jon03_full_disk_weights", _reproduced_sql(0.0225))
def _(spark, d):
    """Computed cells up to 0.1 rad and exact triangles from there to the limb."""
    return _reproduced(spark, d, lambda *a: De.full_disk_weights(*a, limb=0.1), 0.0225)


@query("jon03_geostationary_weights", with_ctes("places", _CORNERS_SQL))
def _(spark, d):
    w = Wt.geostationary_weights(X.places(spark, d), _LATTICE, _P)
    return w.select("target_id", "rank", "source_id", F.round("w", 6).alias("w"))


_AXIS = """, spans AS (SELECT axis_id, resolution, lon_min > lon_max AS crossing,
    CASE WHEN lon_min > lon_max THEN lon_min - 360*floor(lon_min/360) ELSE lon_min END AS start,
    CASE WHEN lon_min > lon_max THEN lon_max - 360*floor(lon_max/360) ELSE lon_max END + resolution AS stop FROM axes)
, lons AS (SELECT axis_id, idx, CASE WHEN crossing THEN round_even(((raw + 180) - 360*floor((raw + 180)/360)) - 180, 4) ELSE raw END AS lon
  FROM (SELECT axis_id, crossing, idx, round_even(start + idx*resolution, 4) AS raw
    FROM (SELECT *, unnest(range(0, greatest(0, CAST(ceil((stop - start)/resolution) AS BIGINT)))) AS idx FROM spans)))
"""


def _lons(spark, d):
    return G.longitude_axis(X.axes(spark, d), ["axis_id"])


@query("scl02_longitude_axes", with_ctes("axes", _AXIS + "SELECT axis_id, idx, round(lon, 6) AS lon FROM lons"))
def _(spark, d):
    return _lons(spark, d).select("axis_id", "idx", F.round("lon", 6).alias("lon"))


_LATS = """, lats AS (SELECT axis_id, idx, lat_min + idx*resolution AS lat FROM (
  SELECT *, unnest(range(0, greatest(0, CAST(ceil((lat_max + resolution - lat_min)/resolution) AS BIGINT)))) AS idx FROM axes))
"""


@query("scl03_latitude_axes", with_ctes("axes", _LATS + "SELECT axis_id, idx, round(lat, 6) AS lat FROM lats"))
def _(spark, d):
    return G.latitude_axis(X.axes(spark, d), ["axis_id"]).select("axis_id", "idx", F.round("lat", 6).alias("lat"))


@query("scl04_round_half_even", """
SELECT event_id, round_even((event_id % 4001) / 8::DOUBLE, 2) AS rounded FROM events""")
def _(spark, d):
    return X.table(spark, d, "events").select(
        "event_id", S.round_half_even((F.col("event_id") % 4001) / F.lit(8.0), 2).alias("rounded"))


@query("win03_antimeridian_crossing", with_ctes("axes", _AXIS + """
, steps AS (SELECT axis_id, lon - lag(lon) OVER (PARTITION BY axis_id ORDER BY idx) AS step FROM lons)
SELECT axis_id, coalesce(bool_or(step < -180), false) AS crossing FROM steps GROUP BY axis_id"""))
def _(spark, d):
    return G.axis_checks(_lons(spark, d), ["axis_id"], "idx", "lon").select("axis_id", "crossing")


@query("win04_longitude_monotonic", with_ctes("axes", _AXIS + """
, bent AS (SELECT axis_id, idx, CASE WHEN axis_id % 5 = 0 AND idx = 2 THEN lon - 10 WHEN axis_id % 7 = 0 THEN -lon ELSE lon END AS lon FROM lons)
, steps AS (SELECT axis_id, lon - lag(lon) OVER o AS step,
    (lon - 360*floor(lon/360)) - lag(lon - 360*floor(lon/360)) OVER o AS east FROM bent WINDOW o AS (PARTITION BY axis_id ORDER BY idx))
SELECT axis_id, count(*) AS n, CASE WHEN coalesce(bool_or(step < -180), false) THEN coalesce(bool_and(east > 0), true)
  ELSE coalesce(bool_and(step > 0), true) OR coalesce(bool_and(step < 0), true) END AS valid FROM steps GROUP BY axis_id"""))
def _(spark, d):
    lon = F.col("lon")
    bent = (F.when((F.col("axis_id") % 5 == 0) & (F.col("idx") == 2), lon - 10)
            .when(F.col("axis_id") % 7 == 0, -lon).otherwise(lon))
    return G.axis_checks(_lons(spark, d).withColumn("lon", bent), ["axis_id"], "idx", "lon").select("axis_id", "n", "valid")


@query("win02_latitude_monotonic", with_ctes("axes", _LATS + """
, bent AS (SELECT axis_id, idx, CASE WHEN axis_id % 5 = 0 AND idx = 2 THEN lat - 10 WHEN axis_id % 3 = 0 THEN -lat ELSE lat END AS lat FROM lats)
, steps AS (SELECT axis_id, lat - lag(lat) OVER (PARTITION BY axis_id ORDER BY idx) AS step FROM bent)
SELECT axis_id, coalesce(bool_and(step > 0), true) OR coalesce(bool_and(step < 0), true) AS monotonic FROM steps GROUP BY axis_id"""))
def _(spark, d):
    lat = F.col("lat")
    bent = (F.when((F.col("axis_id") % 5 == 0) & (F.col("idx") == 2), lat - 10)
            .when(F.col("axis_id") % 3 == 0, -lat).otherwise(lat))
    axis = G.latitude_axis(X.axes(spark, d), ["axis_id"]).withColumn("lat", bent)
    return G.axis_checks(axis, ["axis_id"], "idx", "lat").select("axis_id", "monotonic")


@query("agg06_grid_resolution", with_ctes("axes", _LATS + """
SELECT axis_id, n, CASE WHEN n > 1 THEN round(abs((hi - lo)/(n - 1)), 6) END AS resolution
FROM (SELECT axis_id, count(*) AS n, min_by(lat, idx) AS lo, max_by(lat, idx) AS hi FROM lats GROUP BY axis_id)"""))
def _(spark, d):
    axis = G.latitude_axis(X.axes(spark, d), ["axis_id"])
    return G.axis_resolution(axis, ["axis_id"], "idx", "lat").withColumn("resolution", F.round("resolution", 6))


# Every latitude of an axis with every longitude of the same axis, both from their own definitions.
_GRIDS = _AXIS + _LATS.replace("lat_min + idx*resolution", "round_even(lat_min + idx*resolution, 4)") + """
, cells AS (SELECT a.axis_id, a.idx*n_lon + o.idx AS target_id, CAST(a.idx AS INT) AS ilat, CAST(o.idx AS INT) AS ilon, lat, lon
  FROM lats a JOIN (SELECT *, count(*) OVER (PARTITION BY axis_id) AS n_lon FROM lons) o USING (axis_id))
"""


def _grids(spark, d):
    return G.product_grid(X.axes(spark, d), ["axis_id"])


@query("jon09_target_grids", with_ctes("axes", _GRIDS + """
SELECT axis_id, target_id, ilat, ilon, lat, lon FROM cells"""))
def _(spark, d):
    return _grids(spark, d)


@query("jon09_grids_of_two_resolutions", with_ctes("axes", _AXIS.replace("FROM axes)", "FROM wide)").replace(", spans", """, wide AS (
  SELECT * REPLACE (resolution * 2 AS resolution) FROM axes), spans""") + _GRIDS[len(_AXIS):] + """
SELECT axis_id, count(*) AS cells, count(DISTINCT lon) AS n_lon, round(sum(lat), 3) AS lat_sum, round(sum(lon), 3) AS lon_sum FROM cells GROUP BY 1"""))
def _(spark, d):
    specs = X.axes(spark, d).withColumn("lon_resolution", F.col("resolution") * 2)
    cells = G.product_grid(specs, ["axis_id"])
    return cells.groupBy("axis_id").agg(F.count("*").alias("cells"), F.countDistinct("lon").alias("n_lon"),
                                        F.round(F.sum("lat"), 3).alias("lat_sum"), F.round(F.sum("lon"), 3).alias("lon_sum"))


@query("prj18_grid_shape", with_ctes("axes", _GRIDS + """
SELECT axis_id, count(DISTINCT ilat) AS n_lat, count(DISTINCT ilon) AS n_lon FROM cells GROUP BY axis_id"""))
def _(spark, d):
    return store.region_shape(_grids(spark, d), ["axis_id"])


@query("agg09_spatial_extent", with_ctes("axes", _GRIDS + """
SELECT axis_id, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max FROM cells GROUP BY axis_id"""))
def _(spark, d):
    return G.extent(_grids(spark, d), ["axis_id"])


@query("prj14_region_attributes", with_ctes("axes", _GRIDS + """
, ext AS (SELECT axis_id, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
    count(DISTINCT ilat) AS nlat, count(DISTINCT ilon) AS nlon, min_by(lat, ilat) AS lat0, max_by(lat, ilat) AS lat1,
    min_by(lon, ilon) AS lon0, max_by(lon, ilon) AS lon1 FROM cells GROUP BY axis_id)
SELECT axis_id, unnest(['geospatial_lat_min','geospatial_lat_max','geospatial_lon_min','geospatial_lon_max','geospatial_lat_resolution','geospatial_lon_resolution']) AS key,
  round(unnest([lat_min, lat_max, lon_min, lon_max, CASE WHEN nlat > 1 THEN abs(lat1-lat0)/(nlat-1) END, CASE WHEN nlon > 1 THEN abs(lon1-lon0)/(nlon-1) END]), 6) AS value FROM ext"""))
def _(spark, d):
    cells = _grids(spark, d)
    axis = lambda i, c: G.axis_resolution(cells.select("axis_id", i, c).distinct(), ["axis_id"], i, c)
    attrs = store.region_attributes(G.extent(cells, ["axis_id"]), axis("ilat", "lat"), axis("ilon", "lon"), ["axis_id"])
    return attrs.withColumn("value", F.round("value", 6))


# --- bands ------------------------------------------------------------------


@query("prj01_select_band", with_ctes("pixels16", f"SELECT vec_id, source_id, {_sql6('cmi_c07')} AS cmi, dqf_c07 AS dqf FROM pixels16"))
def _(spark, d):
    return B.select_band(X.pixels16(spark, d), 7, ["vec_id", "source_id"], dqf=True).select("vec_id", "source_id", _r6("cmi"), "dqf")


def _long_sql() -> str:
    parts = [f"SELECT vec_id, source_id, {b} AS band, cmi_c{b:02d} AS cmi, dqf_c{b:02d} AS dqf FROM pixels16" for b in C.ALL_BANDS]
    return ", long AS (" + " UNION ALL ".join(parts) + ")\n"


@query("prj02_bands_long", with_ctes("pixels16", _long_sql() + f"SELECT vec_id, source_id, band, {_sql6('cmi')} AS cmi, dqf FROM long"))
def _(spark, d):
    return B.to_long(X.pixels16(spark, d), ["vec_id", "source_id"], with_dqf=True).select("vec_id", "source_id", "band", _r6("cmi"), "dqf")


@query("prj03_bands_present", with_ctes("raster", "SELECT DISTINCT band FROM raster"))
def _(spark, d):
    return B.bands_in_rows(X.raster(spark, d))


@query("prj04_band_kind", with_ctes("measure", """
SELECT CASE WHEN band < 7 THEN 'reflectance' ELSE 'brightness_temperature' END AS kind, count(*) AS pixels FROM measure GROUP BY 1"""))
def _(spark, d):
    return X.measure(spark, d).groupBy(B.kind(F.col("band")).alias("kind")).agg(F.count(F.lit(1)).alias("pixels"))


_VALUES = ", ".join(f"({b}, '{n}', {w}::DOUBLE, {lo}::DOUBLE, {hi}::DOUBLE)" for b, n, w, lo, hi in C.BANDS)
_BANDS_SQL = f", bands AS (SELECT * FROM (VALUES {_VALUES}) t(band, name, wavelength, lo, hi))\n"


@query("prj05_band_metadata", with_ctes("raster", _BANDS_SQL + """
SELECT r.band, b.name, 'C' || lpad(CAST(r.band AS VARCHAR), 2, '0') AS band_id, b.wavelength, 'K' AS units, count(*) AS pixels
FROM raster r LEFT JOIN bands b USING (band) GROUP BY ALL"""))
def _(spark, d):
    counted = X.raster(spark, d).groupBy("band").agg(F.count(F.lit(1)).alias("pixels"))
    return B.with_metadata(counted, spark).select("band", "name", "band_id", "wavelength", "units", "pixels")


@query("prj05_all_bands", with_ctes("pixels16", _BANDS_SQL + """
SELECT b.band, b.name, 'C' || lpad(CAST(b.band AS VARCHAR), 2, '0') AS band_id, b.wavelength, CASE WHEN b.band < 7 THEN '1' ELSE 'K' END AS units,
  (SELECT count(*) FROM pixels16) AS pixels FROM bands b"""))
def _(spark, d):
    counted = B.to_long(X.pixels16(spark, d), ["vec_id"]).groupBy("band").agg(F.count(F.lit(1)).alias("pixels"))
    return B.with_metadata(counted, spark).select("band", "name", "band_id", "wavelength", "units", "pixels")


@query("prj06_metadata_override", with_ctes("measure", _BANDS_SQL + """
, counted AS (SELECT band, count(*) AS pixels FROM measure GROUP BY band)
SELECT CAST(c.band AS INT) AS band, CASE WHEN c.band = 3 THEN 'Vegetation' ELSE b.name END AS name,
  CASE WHEN c.band = 3 THEN NULL ELSE b.wavelength END AS wavelength, pixels
FROM counted c JOIN bands b USING (band)"""))
def _(spark, d):
    override = spark.range(1).select(F.lit("3").alias("band"), F.lit("Vegetation").alias("name"))
    merged = B.override_metadata(dims.bands(spark), override)
    counted = X.measure(spark, d).groupBy(F.col("band").cast("int").alias("band")).agg(F.count(F.lit(1)).alias("pixels"))
    return counted.join(F.broadcast(merged), "band").select("band", "name", "wavelength", "pixels")


@query("jon05_band_metadata_on_pixels", with_ctes("raster", _BANDS_SQL + f"""
SELECT r.vec_id, r.source_id, b.name, b.wavelength, {_sql6('r.cmi')} AS cmi FROM raster r LEFT JOIN bands b USING (band)"""))
def _(spark, d):
    return B.with_metadata(X.raster(spark, d), spark).select("vec_id", "source_id", "name", "wavelength", _r6("cmi"))


@query("jon04_cmi_with_dqf", with_ctes("pixels16", _long_sql() + """
SELECT band, dqf, count(*) AS pixels, round(avg(cmi), 6) AS mean FROM long WHERE NOT isnan(cmi) GROUP BY band, dqf"""))
def _(spark, d):
    long = B.to_long(X.pixels16(spark, d), ["vec_id", "source_id"], with_dqf=True)
    good = long.where(~F.isnan("cmi"))
    return good.groupBy("band", "dqf").agg(F.count(F.lit(1)).alias("pixels"), F.round(F.avg("cmi"), 6).alias("mean"))


@query("flt15_outside_valid_range", with_ctes("measure", _BANDS_SQL + """
SELECT CAST(m.band AS INT) AS band, count(*) AS outside FROM measure m JOIN bands b USING (band) WHERE NOT (m.cmi BETWEEN b.lo AND b.hi) GROUP BY 1"""))
def _(spark, d):
    return B.outside_valid_range(X.measure(spark, d), spark).groupBy(F.col("band").cast("int").alias("band")).agg(
        F.count(F.lit(1)).alias("outside"))


_PRODUCT_VALUES = ", ".join(f"({b}, '{p}')" for b, ps in C.BAND_PRODUCTS.items() for p in ps)
_PRODUCTS_SQL = f", products AS (SELECT * FROM (VALUES {_PRODUCT_VALUES}) t(band, product))\n"


def _product_rows(spark, d):
    counted = X.raster(spark, d).groupBy("band").agg(F.count(F.lit(1)).alias("pixels"))
    return counted.join(F.broadcast(dims.band_products(spark)), "band")


@query("jon10_bands_to_products", with_ctes("raster", _PRODUCTS_SQL + """
SELECT product, count(*) AS bands, CAST(sum(pixels) AS BIGINT) AS pixels FROM (SELECT band, count(*) AS pixels FROM raster GROUP BY band) JOIN products USING (band) GROUP BY product"""))
def _(spark, d):
    return _product_rows(spark, d).groupBy("product").agg(F.count(F.lit(1)).alias("bands"), F.sum("pixels").alias("pixels"))


@query("agg14_bands_for_product", with_ctes("raster", _PRODUCTS_SQL + """
SELECT band, count(*) AS pixels FROM raster WHERE band IN (SELECT band FROM products WHERE product = 'Fire/hotspot characterization') GROUP BY band"""))
def _(spark, d):
    wanted = B.bands_for_product(spark, "Fire/hotspot characterization")
    return X.raster(spark, d).join(F.broadcast(wanted), "band", "left_semi").groupBy("band").agg(F.count(F.lit(1)).alias("pixels"))


@query("agg14_products_for_band", with_ctes("raster", _PRODUCTS_SQL + """
SELECT r.band, string_agg(DISTINCT product, '|' ORDER BY product) AS products FROM (SELECT DISTINCT band FROM raster) r JOIN products USING (band) GROUP BY r.band"""))
def _(spark, d):
    return _product_rows(spark, d).groupBy("band").agg(
        F.array_join(F.array_sort(F.collect_set("product")), "|").alias("products"))


@query("prj14_array_attributes", with_ctes("raster", _BANDS_SQL + """
SELECT 'CMI_C' || lpad(CAST(band AS VARCHAR), 2, '0') AS node_path,
  'ABI Cloud and Moisture Imagery brightness temperature at top of atmosphere - ' || name AS long_name,
  'DQF_C' || lpad(CAST(band AS VARCHAR), 2, '0') AS ancillary, pixels
FROM (SELECT band, count(*) AS pixels FROM raster GROUP BY band) JOIN bands USING (band)"""))
def _(spark, d):
    path = F.concat(F.lit("CMI_C"), F.lpad(F.col("band").cast("string"), 2, "0"))
    counted = X.raster(spark, d).groupBy(path.alias("node_path")).agg(F.count(F.lit(1)).alias("pixels"))
    rows = B.array_attributes(spark)
    wide = rows.groupBy("node_path").agg(F.max(F.when(F.col("key") == "long_name", F.col("value"))).alias("long_name"),
                                         F.max(F.when(F.col("key") == "ancillary_variables", F.col("value"))).alias("ancillary"))
    return counted.join(F.broadcast(wide), "node_path").select("node_path", "long_name", "ancillary", "pixels")


@query("scl10_flag_names", with_ctes("measure", """
SELECT CAST(dqf AS INT) AS dqf, CASE dqf WHEN 0 THEN 'GOOD' WHEN 1 THEN 'CONDITIONALLY_USABLE' WHEN 2 THEN 'OUT_OF_RANGE'
  WHEN 3 THEN 'NO_VALUE' ELSE 'FOCAL_PLANE_TEMP_EXCEEDED' END AS flag_name, count(*) AS pixels FROM measure GROUP BY dqf"""))
def _(spark, d):
    counted = X.measure(spark, d).groupBy("dqf").agg(F.count(F.lit(1)).alias("pixels"))
    return B.flag_names(counted, spark).select("dqf", "flag_name", "pixels")


@query("prj08_coordinates", with_ctes("raster", """
SELECT vec_id, iy, ix, TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 10 MINUTE AS time, round(ix*0.001::DOUBLE - 0.0035::DOUBLE, 6) AS x, round(0.0035::DOUBLE - iy*0.001::DOUBLE, 6) AS y,
  TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 10 MINUTE AS bounds_start,
  TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 10 MINUTE + INTERVAL 9 MINUTE AS bounds_end FROM raster"""))
def _(spark, d):
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 600)
    bounds = F.struct(time.alias("start"), (time + F.expr("INTERVAL '9' MINUTE")).alias("end"))
    r = X.raster(spark, d).select("vec_id", "iy", "ix", time.alias("time"), (F.col("ix") * 0.001 - 0.0035).alias("x"),
                                  (0.0035 - F.col("iy") * 0.001).alias("y"), bounds.alias("time_bounds"))
    return r.select("vec_id", "iy", "ix", "time", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"),
                    F.col("time_bounds.start").alias("bounds_start"), F.col("time_bounds.end").alias("bounds_end"))


@query("prj09_projection_by_slot", with_ctes("obs", """
SELECT observation_id, CASE orbital_slot WHEN 'GOES-East' THEN -75.0::DOUBLE WHEN 'GOES-West' THEN -137.0 END AS lon_origin,
  CASE WHEN orbital_slot IN ('GOES-East','GOES-West') THEN 35786023.0::DOUBLE END AS h FROM obs"""))
def _(spark, d):
    slot = F.col("orbital_slot")
    east, west = P.Projection(lon_origin=-75.0).as_struct(), P.Projection(lon_origin=-137.0).as_struct()
    o = X.obs(spark, d).withColumn("projection", F.when(slot == "GOES-East", east).when(slot == "GOES-West", west))
    return o.select("observation_id", F.col("projection.lon_origin").alias("lon_origin"), F.col("projection.h").alias("h"))


@query("src06_open_mixed_bands", with_ctes("pixels16", f"""
SELECT vec_id, source_id, CASE WHEN vec_id % 2 = 0 THEN {_sql6('cmi_c02')} END AS cmi_c02, {_sql6('cmi_c13')} AS cmi_c13 FROM pixels16"""))
def _(spark, d):
    p = X.pixels16(spark, d)
    full, thermal = session.scratch_path(spark, "full"), session.scratch_path(spark, "thermal")
    p.where(F.col("vec_id") % 2 == 0).select("vec_id", "source_id", "cmi_c02", "cmi_c13").write.parquet(full)
    p.where(F.col("vec_id") % 2 == 1).select("vec_id", "source_id", "cmi_c13").write.parquet(thermal)
    schema = p.select("vec_id", "source_id", "cmi_c02", "cmi_c13").schema
    return T.open_files(spark, [full, thermal], schema=schema).select("vec_id", "source_id", _r6("cmi_c02"), _r6("cmi_c13"))


@query("jon06_selected_pixels", with_ctes("raster", """
SELECT vec_id, count(*) AS pixels FROM raster WHERE vec_id IN (SELECT event_id FROM events WHERE event_type = 'view') GROUP BY vec_id"""))
def _(spark, d):
    wanted = X.table(spark, d, "events").where(F.col("event_type") == "view").select(F.col("event_id").alias("vec_id"))
    return catalog.selected_pixels(X.raster(spark, d), wanted, "vec_id").groupBy("vec_id").agg(F.count(F.lit(1)).alias("pixels"))


@query("scl25_flatten", with_ctes("raster", "SELECT vec_id, source_id, iy, ix FROM raster"))
def _(spark, d):
    return reshape.flatten(X.table(spark, d, "embeddings"), "embedding", 8, ["vec_id"]).select("vec_id", "source_id", "iy", "ix")


@query("scl25_image_rows", with_ctes("raster", """
SELECT vec_id, iy, string_agg(CASE WHEN isnan(dqf) THEN '-' ELSE CAST(CAST(dqf AS INT) AS VARCHAR) END, ',' ORDER BY ix) AS flags FROM raster GROUP BY vec_id, iy"""))
def _(spark, d):
    text = F.when(F.isnan("dqf"), "-").otherwise(F.nanvl("dqf", F.lit(0.0)).cast("int").cast("string"))
    rows = reshape.image_rows(X.raster(spark, d).withColumn("t", text), ["vec_id"], "iy", "ix", "t")
    return rows.select("vec_id", "iy", F.array_join("values", ",").alias("flags"))


# --- statistics -------------------------------------------------------------


@query("agg01_band_statistics", with_ctes("raster", """
, s AS (SELECT band, count(*) AS n, min(cmi) AS lo, max(cmi) AS hi, avg(cmi) AS mean, stddev_pop(cmi) AS sd FROM raster WHERE NOT isnan(cmi) GROUP BY band)
SELECT s.band, n, round(lo, 6) AS min, round(hi, 6) AS max, round(mean, 6) AS mean, round(sd, 6) AS std_dev, o.outlier_count
FROM s JOIN (SELECT r.band, count(*) FILTER (abs(r.cmi - s.mean) > 2 * s.sd) AS outlier_count
  FROM raster r JOIN s USING (band) WHERE NOT isnan(r.cmi) GROUP BY r.band) o USING (band)"""))
def _(spark, d):
    stats = St.band_statistics(X.raster(spark, d), ["band"], spread=2.0)
    return stats.select("band", "n", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std_dev")], "outlier_count")


@query("agg01_large_statistics", with_ctes("measure", """
SELECT CAST(band AS INT) AS band, count(*) AS n, round(min(cmi), 6) AS min, round(max(cmi), 6) AS max, round(avg(cmi), 6) AS mean, round(stddev_pop(cmi), 6) AS std_dev
FROM measure GROUP BY band"""))
def _(spark, d):
    stats = St.band_statistics(X.measure(spark, d), ["band"])
    return stats.select(F.col("band").cast("int").alias("band"), "n", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std_dev")])


@query("agg19_percentile", with_ctes("measure", """
SELECT CAST(band AS INT) AS band, count(*) AS n, round(quantile_cont(cmi, 0.7), 6) AS percentile FROM measure GROUP BY band"""))
def _(spark, d):
    p = St.percentile_exact(X.measure(spark, d), ["band"], "cmi", 0.7)
    return p.select(F.col("band").cast("int").alias("band"), "n", F.round("percentile", 6).alias("percentile"))


@query("scl20_ir_normalization", with_ctes("raster", f"""
, q AS (SELECT band, min(cmi) AS lo, max(cmi) AS hi, quantile_cont(cmi, 0.7) AS p FROM raster WHERE NOT isnan(cmi) GROUP BY band)
, k AS (SELECT band, lo, hi, CASE WHEN b1 >= hi THEN hi - 0.01*(hi-lo) ELSE b1 END AS bp FROM (SELECT *, CASE WHEN p <= lo THEN lo + 0.01*(hi-lo) ELSE p END AS b1 FROM q))
SELECT vec_id, source_id, CASE WHEN isnan(cmi) THEN NULL WHEN cmi <= bp THEN round((cmi-lo)/(bp-lo)*0.9, 6) ELSE round(0.9 + (cmi-bp)/(hi-bp)*0.1, 6) END AS normalized
FROM raster JOIN k USING (band)"""))
def _(spark, d):
    return St.ir_normalize(X.raster(spark, d), ["band"], "cmi").select("vec_id", "source_id", _r6("normalized"))


@query("scl20_ir_inverse", with_ctes("raster", f"SELECT vec_id, source_id, {_sql6('cmi')} AS cmi FROM raster"))
def _(spark, d):
    n = St.ir_normalize(X.raster(spark, d), ["band"], "cmi")
    back = St.ir_inverse(F.col("normalized"), F.col("vmin"), F.col("bp"), F.col("vmax"))
    return n.select("vec_id", "source_id", back.alias("cmi")).select("vec_id", "source_id", _r6("cmi"))


# --- recipes ----------------------------------------------------------------


def _channel_sql(row: tuple) -> str:
    _, _, _, terms, unit, low, high, gamma, invert = row
    v = " + ".join(f"({f}::DOUBLE) * cmi_c{b:02d}" for b, f in terms.items())
    v = f"({v})"
    if unit == "pct":
        v = f"({v} * 100)"
    if unit == "C" and len(terms) == 1:
        v = f"({v} - 273.15::DOUBLE)"
    clip = lambda e, lo, hi: f"(CASE WHEN isnan({e}) THEN {e} ELSE least(greatest({e}, {lo}::DOUBLE), {hi}::DOUBLE) END)"
    if unit is not None:
        v = f"(({clip(v, low, high)} - ({low}::DOUBLE)) / ({high}::DOUBLE - ({low}::DOUBLE)))"
    if invert:
        v = f"(1 - {v})"
    if gamma is not None:
        v = f"pow({clip(v, 0.0, 1.0)}, {1.0 / gamma!r}::DOUBLE)"
    return clip(v, 0.0, 1.0)


def _register_composite(name: str) -> None:
    rows = {row[2]: row for row in C.COMPOSITES if row[0] == name}
    nested = ", ".join(f"{_channel_sql(rows[c])} AS {c}" for c in recipes.CHANNELS)
    outer = ", ".join(f"round(CASE WHEN NOT isnan({c}) THEN {c} END, 6) AS {c}" for c in recipes.CHANNELS)

    @query(f"scl17_rgb_{name}", with_ctes("pixels16", f"SELECT vec_id, source_id, {outer} FROM (SELECT vec_id, source_id, {nested} FROM pixels16)"))
    def _(spark, d):
        rgb = recipes.composite(X.pixels16(spark, d), name, ["vec_id", "source_id"])
        return rgb.select("vec_id", "source_id", *[_r6(c) for c in recipes.CHANNELS])


for _name in recipes.composite_names():
    _register_composite(_name)


def _register_difference(name: str) -> None:
    _, a, b, *_ = next(row for row in C.DIFFERENCES if row[0] == name)

    @query(f"scl18_diff_{name}", with_ctes("pixels16", f"SELECT vec_id, source_id, {_sql6(f'(cmi_c{a:02d} - cmi_c{b:02d})')} AS difference FROM pixels16"))
    def _(spark, d):
        return recipes.difference(X.pixels16(spark, d), name, ["vec_id", "source_id"]).select("vec_id", "source_id", _r6("difference"))


for _name in recipes.difference_names():
    _register_difference(_name)


@query("scl19_sign_classes", with_ctes("pixels16", """
SELECT vec_id, source_id, CASE WHEN isnan(cmi_c13) THEN NULL WHEN cmi_c13 > cmi_c15 THEN 'positive' WHEN cmi_c13 < cmi_c15 THEN 'negative' END AS moisture,
  CASE WHEN isnan(cmi_c05) THEN NULL WHEN cmi_c05 > cmi_c02 THEN 'positive' WHEN cmi_c05 < cmi_c02 THEN 'negative' END AS snow,
  CASE WHEN isnan(cmi_c13) THEN NULL WHEN cmi_c13 < cmi_c07 AND vec_id % 2 = 0 THEN 'day_negative' WHEN cmi_c13 < cmi_c07 THEN 'night_negative'
    WHEN cmi_c13 > cmi_c07 AND vec_id % 2 = 1 THEN 'night_positive' END AS fog FROM pixels16"""))
def _(spark, d):
    p = X.pixels16(spark, d)
    minus = lambda a, b: F.col(f"cmi_c{a:02d}") - F.col(f"cmi_c{b:02d}")
    return p.select("vec_id", "source_id", recipes.sign_class(minus(13, 15), "split_window").alias("moisture"),
                    recipes.sign_class(minus(5, 2), "split_snow").alias("snow"),
                    recipes.sign_class(minus(13, 7), "night_fog", F.col("vec_id") % 2 == 0).alias("fog"))


@query("scl11_rescale_gamma_stack", with_ctes("measure", """
SELECT l_orderkey, l_linenumber, round(v, 6) AS scaled, round(pow(v, 1/1.7::DOUBLE), 6) AS brightened, round(1 - v, 6) AS inverted
FROM (SELECT l_orderkey, l_linenumber, (least(greatest(cmi, 210), 280) - 210) / 70 AS v FROM measure)"""))
def _(spark, d):
    v = S.rescale(F.col("cmi"), 210.0, 280.0)
    return X.measure(spark, d).select("l_orderkey", "l_linenumber", F.round(v, 6).alias("scaled"),
                                      F.round(S.apply_gamma(v, 1.7), 6).alias("brightened"), F.round(1.0 - v, 6).alias("inverted"))


@query("scl13_stack_rgb", with_ctes("pixels16", """
SELECT vec_id, source_id, round(CASE WHEN NOT isnan(r) THEN least(greatest(r, 0), 1) END, 6) AS r, round(CASE WHEN NOT isnan(g) THEN least(greatest(g, 0), 1) END, 6) AS g,
  round(CASE WHEN NOT isnan(b) THEN least(greatest(b, 0), 1) END, 6) AS b FROM (SELECT vec_id, source_id, cmi_c02*2 - 0.5 AS r, cmi_c03 AS g, cmi_c01 - 0.4 AS b FROM pixels16)"""))
def _(spark, d):
    raw = {"r": F.col("cmi_c02") * 2.0 - 0.5, "g": F.col("cmi_c03"), "b": F.col("cmi_c01") - 0.4}
    stacked = X.pixels16(spark, d).select("vec_id", "source_id", *[S.clip(v, 0.0, 1.0).alias(c) for c, v in raw.items()])
    return stacked.select("vec_id", "source_id", *[_r6(c) for c in raw])


_RECIPE_ROWS = [(n, w, b) for n, w in {(r[0], r[1]): None for r in C.COMPOSITES} for b in recipes.bands_for(n)]
_RECIPE_ROWS += [(r[0], r[4], b) for r in C.DIFFERENCES for b in sorted({r[1], r[2]})]
_RECIPES_SQL = ", recipes AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{w}', {b})" for n, w, b in _RECIPE_ROWS) + ") t(recipe, when_, band))\n"


@query("prj16_recipes_evaluable", with_ctes("raster", _RECIPES_SQL + """
, present AS (SELECT band, count(*) AS pixels FROM raster GROUP BY band)
SELECT recipe, count(*) AS bands, count(present.band) = count(*) AS evaluable, CAST(sum(pixels) AS BIGINT) AS pixels FROM recipes LEFT JOIN present USING (band) GROUP BY recipe"""))
def _(spark, d):
    counted = X.raster(spark, d).groupBy("band").agg(F.count(F.lit(1)).alias("pixels"))
    joined = dims.recipe_bands(spark).join(counted, "band", "left")
    return joined.groupBy("recipe").agg(F.count(F.lit(1)).alias("bands"),
                                        (F.count("pixels") == F.count(F.lit(1))).alias("evaluable"), F.sum("pixels").alias("pixels"))


@query("prj17_bands_for_recipe", with_ctes("pixels16", _RECIPES_SQL + _long_sql() + """
SELECT recipe, string_agg(CAST(band AS VARCHAR), ',' ORDER BY band) AS bands, CAST(sum(good) AS BIGINT) AS good_values
FROM recipes JOIN (SELECT band, count(*) FILTER (NOT isnan(cmi)) AS good FROM long GROUP BY band) USING (band) GROUP BY recipe"""))
def _(spark, d):
    long = B.to_long(X.pixels16(spark, d), ["vec_id", "source_id"])
    good = long.groupBy("band").agg(F.count_if(~F.isnan("cmi")).alias("good"))
    joined = dims.recipe_bands(spark).join(good, "band")
    return joined.groupBy("recipe").agg(F.array_join(F.array_sort(F.collect_set("band")), ",").alias("bands"),
                                        F.sum("good").alias("good_values"))


@query("flt16_night_recipes", with_ctes("raster", _RECIPES_SQL + """
SELECT recipe, count(*) AS bands_present FROM recipes JOIN (SELECT DISTINCT band FROM raster) USING (band) WHERE when_ IN ('night', 'both') GROUP BY recipe"""))
def _(spark, d):
    night = dims.recipe_bands(spark).where(F.col("time_of_day").isin("night", "both"))
    present = B.bands_in_rows(X.raster(spark, d))
    return night.join(present, "band").groupBy("recipe").agg(F.count(F.lit(1)).alias("bands_present"))


# --- store ------------------------------------------------------------------

_STORED = ["cmi_c07"]
_STORED_BANDS = [7]


def _stored_rows(spark, d):
    """Covered targets of every frame, as one region's rows."""
    pixels = X.raster(spark, d).select("vec_id", "source_id", F.col("cmi").alias("cmi_c07"), F.col("dqf").alias("dqf_c07"))
    found = R.regrid(pixels, X.weights(spark), ["vec_id"], ["cmi_c07"], ["dqf_c07"])
    return sinks.stored_rows(found.select(
        F.when(F.col("vec_id") % 3 == 0, "GOES-East").otherwise("GOES-West").alias("orbital_slot"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 600).alias("time"),
        F.lit("G16").alias("platform_id"), F.when(F.col("vec_id") % 2 == 0, "ABI Mode 6").alias("scan_mode"),
        "target_id", F.floor(F.col("target_id") / 17).cast("int").alias("ilat"), (F.col("target_id") % 17).cast("int").alias("ilon"),
        "cmi_c07", "dqf_c07"), _STORED_BANDS)


_STORE_SQL = """, stored AS (SELECT CASE WHEN vec_id % 3 = 0 THEN 'GOES-East' ELSE 'GOES-West' END AS orbital_slot,
  TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 10 MINUTE AS time,
  CASE WHEN vec_id % 2 = 0 THEN 'ABI Mode 6' ELSE 'unknown' END AS scan_mode, target_id, target_id // 17 AS ilat, target_id % 17 AS ilon, dqf,
  cmi FROM regridded WHERE target_id IN (SELECT target_id FROM weights))
"""


def _written_store(spark, d):
    path = session.scratch_path(spark, "gridded")
    schema = schemas.gridded(_STORED_BANDS)
    rows = _stored_rows(spark, d)
    early = rows.where(F.col("time") < F.lit("2024-01-02 06:00:00").cast("timestamp"))
    sinks.create_store(spark, path, _STORED_BANDS)
    sinks.append_frames(early.where("target_id < 150"), path, schema)  # part of each frame
    sinks.append_frames(rows, path, schema)
    return path


def _frame_pixels(spark, d):
    """Pixels with the frame columns of the store; every seventh frame lacks pixels, every eleventh has a band too many."""
    slot = F.when(F.col("vec_id") % 3 == 0, "GOES-East").otherwise("GOES-West")
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 600)
    extra = F.when(F.col("vec_id") % 11 == 0, F.lit(1.0))
    return X.raster(spark, d).where((F.col("vec_id") % 7 != 0) | (F.col("source_id") < 60)).select(
        "vec_id", "source_id", slot.alias("orbital_slot"), time.cast("date").alias("obs_date"), time.alias("time"),
        F.col("cmi").alias("cmi_c07"), F.col("dqf").alias("dqf_c07"), extra.alias("cmi_c08"))


_APPEND_SQL = """, frames AS (SELECT vec_id, CASE WHEN vec_id % 11 = 0 THEN 'Band set differs: 7,8' WHEN vec_id % 7 = 0 THEN 'Unexpected frame shape' END AS error,
  CASE WHEN vec_id % 3 = 0 THEN 'GOES-East' ELSE 'GOES-West' END AS orbital_slot, TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 10 MINUTE AS time FROM embeddings)
"""


def _appended(spark, d):
    """A declared region, the observations appended to it twice, and those refused."""
    path, schema = session.scratch_path(spark, "observations"), schemas.gridded(_STORED_BANDS)
    w = X.weights(spark)
    sinks.create_store(spark, path, _STORED_BANDS, name="test", attributes={"title": "regridded"})

    def transform(pixels):
        found = R.regrid(pixels, w, ["orbital_slot", "obs_date", "time"], ["cmi_c07"], ["dqf_c07"])
        return sinks.stored_rows(found.withColumns({"platform_id": F.lit("G16"), "scan_mode": F.lit(None).cast("string"), "ilat": F.floor(F.col("target_id") / 17),
                                                    "ilon": F.col("target_id") % 17}), _STORED_BANDS)
    cells = w.select("target_id").distinct().count()
    for _ in range(2):
        refused = sinks.append_observations(_frame_pixels(spark, d), path, schema, transform, _STORED_BANDS, 64, cells)
    return path, refused


@query("snk05_refused_observations", (_APPEND_SQL.replace(", frames", "WITH frames", 1) + "SELECT orbital_slot, time, error AS error_message FROM frames WHERE error IS NOT NULL"))
def _(spark, d):
    return _appended(spark, d)[1].select("orbital_slot", "time", "error_message")


@query("snk05_append_observations", with_ctes("regridded", _APPEND_SQL + """
SELECT f.orbital_slot, f.time, count(*) AS cells, count(*) FILTER (NOT isnan(cmi)) AS finite, CAST(sum(dqf) AS BIGINT) AS flags
FROM regridded JOIN frames f USING (vec_id) WHERE error IS NULL AND target_id IN (SELECT target_id FROM weights) GROUP BY 1, 2"""))
def _(spark, d):
    stored = T.open_region(spark, _appended(spark, d)[0])
    return stored.groupBy("orbital_slot", "time").agg(F.count("*").alias("cells"), F.count_if(~F.isnan("cmi_c07")).alias("finite"), F.sum("dqf_c07").alias("flags"))


@query("snk03_declared_region", with_ctes("axes", _AXIS + """
SELECT key, value FROM (VALUES ('region', 'west'), ('bands', '2,7'), ('title', 'empty')) AS t(key, value)
UNION ALL SELECT 'longitudes', CAST(count(*) AS VARCHAR) FROM lons UNION ALL SELECT 'rows', '0'"""))
def _(spark, d):
    path = session.scratch_path(spark, "region")
    axis = _lons(spark, d).select(F.lit(0).alias("ilat"), F.col("idx").cast("int").alias("ilon"), "axis_id", "lon")
    grid = axis.where("axis_id = 1").select(F.col("ilon").cast("long").alias("target_id"), "ilat", "ilon", F.lit(0.0).alias("lat"), "lon")
    sinks.create_store(spark, path, [2, 7], name="west", grid=grid, attributes={"title": "empty"})
    told = T.region_attributes(spark, path).where("key <> 'schema'")
    counts = axis.select(F.lit("longitudes").alias("key")).groupBy("key").agg(F.count("*").cast("string").alias("value"))
    rows = T.open_region(spark, path).agg(F.count("*").cast("string").alias("value")).select(F.lit("rows").alias("key"), "value")
    return told.unionByName(counts).unionByName(rows)


@query("snk06_store_append_twice", with_ctes("regridded", _STORE_SQL + """
SELECT orbital_slot, scan_mode, count(*) AS cells, count(DISTINCT time) AS frames, CAST(sum(dqf) AS BIGINT) AS flags,
  round(avg(CASE WHEN NOT isnan(cmi) THEN cmi END), 4) AS mean FROM stored GROUP BY 1, 2"""))
def _(spark, d):
    stored = T.open_region(spark, _written_store(spark, d))
    value = S.nan_to_null(F.col("cmi_c07").cast("double"))
    return stored.groupBy("orbital_slot", "scan_mode").agg(
        F.count(F.lit(1)).alias("cells"), F.countDistinct("time").alias("frames"),
        F.sum("dqf_c07").alias("flags"), F.round(F.avg(value), 4).alias("mean"))


@query("src14_sub_selection", with_ctes("regridded", _STORE_SQL + """
SELECT orbital_slot, time, target_id, dqf AS dqf_c07 FROM stored WHERE time BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-02 12:00:00'"""))
def _(spark, d):
    return T.open_region(spark, _written_store(spark, d), ["orbital_slot", "time", "target_id", "dqf_c07"],
                         "2024-01-02 00:00:00", "2024-01-02 12:00:00")


@query("src12_reopen_region", with_ctes("regridded", _STORE_SQL + """
SELECT orbital_slot, count(DISTINCT ilat) AS n_lat, count(DISTINCT ilon) AS n_lon, '7' AS bands FROM stored GROUP BY orbital_slot"""))
def _(spark, d):
    stored = T.open_region(spark, _written_store(spark, d))
    bands = ",".join(str(b) for b in B.available_bands(stored))
    return store.region_shape(stored, ["orbital_slot"]).withColumn("bands", F.lit(bands))


@query("snk08_overwrite_dates", with_ctes("regridded", _STORE_SQL + """
SELECT orbital_slot, CAST(time AS DATE) = DATE '2024-01-01' AS first_day, count(*) AS cells,
  CAST(sum(CASE WHEN CAST(time AS DATE) = DATE '2024-01-01' THEN 0 ELSE dqf END) AS BIGINT) AS flags FROM stored GROUP BY 1, 2"""))
def _(spark, d):
    path = _written_store(spark, d)
    day = F.col("obs_date") == F.lit("2024-01-01").cast("date")
    changed = _stored_rows(spark, d).where(day).withColumn("dqf_c07", F.lit(0).cast("short"))
    sinks.overwrite_dates(changed, path)
    stored = spark.read.parquet(path)
    return stored.groupBy("orbital_slot", day.alias("first_day")).agg(F.count(F.lit(1)).alias("cells"), F.sum("dqf_c07").alias("flags"))


@query("flt14_batch_validation", with_ctes("measure", """
, per AS (SELECT l_orderkey, CAST(band AS INT) AS band, count(*) AS n FROM measure GROUP BY 1, 2)
, frames AS (SELECT l_orderkey, list_sort(list(band)) AS bl, min(n) AS min_pixels, max(n) AS max_pixels FROM per GROUP BY 1)
SELECT l_orderkey, array_to_string(bl, ',') AS bands, min_pixels, max_pixels,
  CASE WHEN len(list_filter(bl, lambda b: b > 6)) > 0 THEN 'Unregistered bands: 7' WHEN bl <> [1, 2, 3, 4] THEN 'Band set differs within the batch'
    WHEN min_pixels <> 1 OR max_pixels <> 1 THEN 'Unexpected frame shape' END AS error_message FROM frames"""))
def _(spark, d):
    long = X.measure(spark, d).withColumn("band", F.col("band").cast("int"))
    return validate.batch_errors(long, ["l_orderkey"], 1, registered=[1, 2, 3, 4, 5, 6], batch_bands=[1, 2, 3, 4])


@query("set03_unregistered_bands", with_ctes("measure", "SELECT DISTINCT CAST(band AS INT) AS band FROM measure WHERE band NOT IN (1, 2, 3, 5)"))
def _(spark, d):
    asked = X.measure(spark, d).select(F.col("band").cast("int").alias("band")).distinct()
    registered = dims.bands(spark).where(F.col("band").isin(1, 2, 3, 5)).select("band")
    return asked.exceptAll(registered)


@query("set04_band_sets", with_ctes("measure", """
SELECT bands, count(*) AS frames FROM (SELECT l_orderkey, string_agg(DISTINCT CAST(band AS VARCHAR), ',' ORDER BY CAST(band AS VARCHAR)) AS bands FROM measure GROUP BY 1) GROUP BY bands"""))
def _(spark, d):
    sets = X.measure(spark, d).groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_set(F.col("band").cast("string"))), ",").alias("bands"))
    return sets.groupBy("bands").agg(F.count(F.lit(1)).alias("frames"))


@query("agg18_size_estimate", """
SELECT count(*) AS timesteps, round(count(*) * 16.0 * 289 * 5 / 1073741824, 9) AS uncompressed_gb,
  round(count(*) * 16.0 * 289 * 5 / 4 / 1073741824, 9) AS compressed_gb, 4.0::DOUBLE AS compression_ratio,
  round(count(*) * 289 * 5 / 4.0 / 1073741824, 9) AS per_band_gb FROM embeddings""")
def _(spark, d):
    e = store.estimate_size(X.table(spark, d, "embeddings"), 289, 16)
    return e.select("timesteps", *[F.round(c, 9).alias(c) for c in ("uncompressed_gb", "compressed_gb")], "compression_ratio",
                    F.round("per_band_gb", 9).alias("per_band_gb"))


# --- streams ----------------------------------------------------------------


_STR01 = with_ctes("regridded", """
SELECT band, target_id, count(*) AS frames, count(*) FILTER (dqf <> 6) AS usable FROM regridded
WHERE target_id IN (SELECT target_id FROM weights) GROUP BY 1, 2""")


def _streamed(spark, d, max_files, lost_checkpoint=False):
    """Frames whose pixels arrive in two files each, gridded as they become complete."""
    source, base = session.scratch_path(spark, "arrivals"), session.scratch_path(spark, "stream")
    px = X.raster(spark, d)
    for half in (px.where("source_id < 24"), px.where("source_id >= 24")):
        half.coalesce(1).write.mode("append").parquet(source)
    w = session.materialize(X.weights(spark), "stream-weights")
    transform = lambda df: R.regrid(df, w, _FRAME, ["cmi"], ["dqf"])
    error = lambda df: df.withColumn("error_message", F.when(~F.col("band").between(1, 16), "Invalid band"))
    for run in range(2):  # the second run finds nothing new
        stream = ingest.file_stream(spark, source, px.schema, max_files)
        ingest.grid_frames(stream, transform, error, f"{base}/gridded", f"{base}/log",
                           f"{base}/checkpoint{run * lost_checkpoint}", _FRAME, expected_pixels=X.NX * X.NY)
    return spark.read.schema("vec_id long, band int, target_id long, cmi double, dqf short").parquet(f"{base}/gridded").groupBy("band", "target_id").agg(
        F.count(F.lit(1)).alias("frames"), F.count_if(F.col("dqf") != 6).alias("usable"))


@query("str01_stream_regrid", _STR01)
def _(spark, d):
    return _streamed(spark, d, None)


@query("str01_stream_file_by_file", _STR01)
def _(spark, d):
    return _streamed(spark, d, 1)


@query("str01_stream_lost_checkpoint", _STR01)
def _(spark, d):
    return _streamed(spark, d, 1, lost_checkpoint=True)


_LATE = """, last AS (SELECT max(time) - INTERVAL 1 HOUR AS until FROM frames)
"""


def _region_stream(spark, d, late=False):
    """Frames arrive in two parts and go to a region; every seventh lacks pixels, which come when most of these frames are closed."""
    source, base, path = (session.scratch_path(spark, n) for n in ("arrivals", "frames", "streamed"))
    schema, w = schemas.gridded(_STORED_BANDS), session.materialize(X.weights(spark), "stream-weights")
    sinks.create_store(spark, path, _STORED_BANDS)
    px = _frame_pixels(spark, d).drop("cmi_c08")
    missing = (F.col("vec_id") % 7 == 0) & (F.col("source_id") >= 60)
    whole = X.raster(spark, d).select("vec_id", "source_id", F.col("cmi").alias("cmi_c07"), F.col("dqf").alias("dqf_c07"))
    slots = px.select("vec_id", "orbital_slot", "obs_date", "time").distinct()

    def transform(pixels):
        found = R.regrid(pixels, w, ["orbital_slot", "obs_date", "time"], ["cmi_c07"], ["dqf_c07"])
        return sinks.stored_rows(found.withColumns({"platform_id": F.lit("G16"), "scan_mode": F.lit(None).cast("string"), "ilat": F.floor(F.col("target_id") / 17),
                                                    "ilon": F.col("target_id") % 17}), _STORED_BANDS)
    error = lambda df: df.withColumn("error_message", F.when(F.col("source_id") < 0, "Invalid pixel"))
    for parts in ((px.where("source_id < 24"), px.where("source_id >= 24")), (whole.where(missing).join(slots, "vec_id").select(*px.columns),))[:1 + late]:
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(source)
        Fr.ingest_frames(ingest.file_stream(spark, source, px.schema), transform, error, path, schema, base, f"{base}/checkpoint", X.NX * X.NY, "1 hour", block=16)
    return path, base, px.schema


@query("str01_region_frames", with_ctes("regridded", _APPEND_SQL + """
SELECT f.orbital_slot, f.time, count(*) AS cells, count(*) FILTER (NOT isnan(cmi)) AS finite, CAST(sum(dqf) AS BIGINT) AS flags
FROM regridded JOIN frames f USING (vec_id) WHERE vec_id % 7 <> 0 AND target_id IN (SELECT target_id FROM weights) GROUP BY 1, 2"""))
def _(spark, d):
    stored = T.open_region(spark, _region_stream(spark, d)[0])
    return stored.groupBy("orbital_slot", "time").agg(F.count("*").alias("cells"), F.count_if(~F.isnan("cmi_c07")).alias("finite"), F.sum("dqf_c07").alias("flags"))


@query("str03_frame_log", (_APPEND_SQL.replace(", frames", "WITH frames", 1) + _LATE + """
SELECT orbital_slot, time, CASE WHEN vec_id % 7 = 0 THEN 'failed' ELSE 'done' END AS status, CASE WHEN vec_id % 7 = 0 THEN 'Incomplete frame' END AS error
FROM frames, last WHERE vec_id % 7 <> 0 OR time < until"""))
def _(spark, d):
    return Fr.frame_log(spark, _region_stream(spark, d)[1]).select("orbital_slot", "time", "status", "error")


@query("str07_late_pixels", (_APPEND_SQL.replace(", frames", "WITH frames", 1) + _LATE + """
SELECT orbital_slot, time, CAST(unnest([60, 61, 62, 63]) AS BIGINT) AS source_id FROM frames, last WHERE vec_id % 7 = 0 AND time <= until"""))
def _(spark, d):
    _, base, schema = _region_stream(spark, d, late=True)
    return Fr.late_pixels(spark, base, schema).select("orbital_slot", "time", "source_id")


@query("str06_stream_catalog", with_ctes("obs", "SELECT observation_id, orbital_slot, file_name FROM obs"))
def _(spark, d):
    source, base = session.scratch_path(spark, "catalog-arrivals"), session.scratch_path(spark, "catalog-stream")
    o = X.obs(spark, d).select("observation_id", "orbital_slot", "file_name", F.to_date("time_coverage_start").alias("obs_date"))
    o.union(o.where(F.col("observation_id") % 2 == 0)).write.parquet(source)
    stream = ingest.file_stream(spark, source, o.schema, max_files=4)
    ingest.grow_catalog(stream, f"{base}/observations", f"{base}/checkpoint", ["observation_id"], by="obs_date")
    return spark.read.parquet(f"{base}/observations").select("observation_id", "orbital_slot", "file_name")


@query("str07_late_frames", with_ctes("obs", """
, last AS (SELECT orbital_slot, max(time_coverage_start) AS t FROM obs WHERE observation_id % 3 = 0 AND time_coverage_start < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1)
SELECT o.observation_id, coalesce(o.time_coverage_start <= last.t, false) AS late FROM obs o LEFT JOIN last ON o.orbital_slot IS NOT DISTINCT FROM last.orbital_slot WHERE o.observation_id % 3 <> 0"""))
def _(spark, d):
    o = X.obs(spark, d)
    stored = o.where((F.col("observation_id") % 3 == 0) & (F.col("time_coverage_start") < F.lit("2024-01-15").cast("timestamp")))
    last = stored.groupBy("orbital_slot").agg(F.max("time_coverage_start").alias("last_time"))
    batch = o.where(F.col("observation_id") % 3 != 0)
    return ingest.split_late(batch, last, ["orbital_slot"], "time_coverage_start").select("observation_id", "late")


@query("str08_finalize_store", with_ctes("regridded", _STORE_SQL + """
SELECT orbital_slot, min(time) AS coverage_start, max(time) AS coverage_end, round(epoch(max(time) - min(time)), 6)::DOUBLE AS duration_seconds,
  'created; finalized' AS history FROM stored GROUP BY 1"""))
def _(spark, d):
    path = _written_store(spark, d)
    sinks.append_history(spark, path, "created")
    ingest.finalize(spark, path, ["orbital_slot"])
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "message"))), lambda h: h["message"]), "; ")
    history = T.region_history(spark, path).select(told.alias("history")).first()["history"]
    return T.region_coverage(spark, path).withColumn("history", F.lit(history))


@query("str04_retried_frames", with_ctes("raster", """
, tries AS (SELECT DISTINCT vec_id, vec_id % 5 AS kind FROM raster), attempts AS (
  SELECT vec_id, 1 AS attempt, CASE WHEN kind < 2 THEN 'failed' ELSE 'done' END AS status FROM tries
  UNION ALL SELECT vec_id, 2, CASE WHEN kind = 0 THEN 'failed' ELSE 'done' END FROM tries WHERE kind < 2)
SELECT attempt, status, count(*) AS frames FROM attempts GROUP BY 1, 2"""))
def _(spark, d):
    """Frames of two kinds fail; one kind is mended, and what failed once is tried once more."""
    source, base = session.scratch_path(spark, "arrivals"), session.scratch_path(spark, "stream")
    px = X.raster(spark, d)
    px.write.parquet(source)
    w = session.materialize(X.weights(spark), "stream-weights")
    transform = lambda df: R.regrid(df, w, ["vec_id"], ["cmi"])
    failing = lambda kinds: lambda df: df.withColumn("error_message", F.when(F.col("vec_id") % 5 < kinds, "broken"))
    stream = ingest.file_stream(spark, source, px.schema)
    ingest.grid_frames(stream, transform, failing(2), f"{base}/gridded", f"{base}/log", f"{base}/checkpoint", ["vec_id"])
    for _ in range(2):  # the second time nothing may be tried again
        ingest.retry_frames(spark.read.parquet(source), transform, failing(1), f"{base}/gridded", f"{base}/log", ["vec_id"], max_retries=1)
    return spark.read.parquet(f"{base}/log").groupBy("attempt", "status").agg(F.count("*").alias("frames"))


@query("str02_process_range", with_ctes("raster weights", f"""
SELECT r.vec_id, w.target_id, round(CASE WHEN NOT isnan(sum(w.w*r.cmi)) THEN sum(w.w*r.cmi) END, 6) AS cmi
FROM raster r JOIN weights w USING (source_id) WHERE r.vec_id BETWEEN 100 AND 199 GROUP BY 1, 2"""))
def _(spark, d):
    steps = catalog.step_slice(X.raster(spark, d), 100, 200, "vec_id")
    return R.regrid(steps, X.weights(spark), ["vec_id"], ["cmi"]).select("vec_id", "target_id", _r6("cmi"))
