"""Imagery tables derived from the star-schema tables, and the same as SQL.

Each Spark function has a CTE of the same name in `CTE`; `with_ctes` prefixes a
query with the ones it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralattice import constants as C
from terralattice.operators import reshape, weights as Wt

NX = NY = 8
VECTORS = 512  # that one task unfolds into pixels


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """The embeddings in parts of about VECTORS rows: their few bytes lie in few files, but unfold into many pixels and targets."""
    e = table(spark, d, "embeddings")
    return e.repartition(max(1, -(-e.count() // VECTORS)), "vec_id")


# --- observations -----------------------------------------------------------

def _pick(key, names, other):
    column = None
    for value, name in names:
        column = F.when(key == value, name) if column is None else column.when(key == value, name)
    return column.otherwise(other)


def obs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    stamp = lambda t: F.date_format(t, "yyyyDDDHHmmssS")
    start, end = F.col("ts"), F.col("ts") + F.expr("INTERVAL '10' MINUTE")
    slot = F.col("user_id") % 7
    letter = F.when(F.col("event_type") == "click", "C").when(F.col("event_type") == "purchase", "M").otherwise("F")
    return e.select(
        F.col("event_id").alias("observation_id"), start.alias("time_coverage_start"), end.alias("time_coverage_end"),
        _pick(F.col("user_id") % 5, [(0, "G16"), (1, "G17"), (2, "G18"), (3, "G19")], "G99").alias("platform_id"),
        F.when(slot == 6, F.lit(None)).when(slot == 5, "GOES-Nowhere").when(slot < 2, "GOES-East")
         .when(slot < 4, "GOES-West").otherwise("GOES-Test").alias("orbital_slot"),
        F.when(F.col("event_type") == "view", "Full Disk").when(F.col("event_type") == "click", "CONUS")
         .when(F.col("event_type") == "purchase", "Mesoscale").when(F.col("event_type") == "error", "Limb")
         .alias("scene_id"),
        F.col("value").alias("file_size_mb"),
        F.concat(F.when(F.col("event_id") % 20 == 0, "XX").otherwise("OR"), F.lit("_ABI-L2-MCMIP"), letter,
                 F.lit("-M6_G"), (16 + F.col("user_id") % 4).cast("string"), F.lit("_s"), stamp(start),
                 F.lit("_e"), stamp(end), F.lit("_c"), stamp(end), F.lit(".nc")).alias("file_name"))


def scanned_obs(spark: SparkSession, d: str) -> DataFrame:
    from terralattice.operators import validate
    error = F.coalesce(validate.file_error(F.col("file_name"), F.lit(True), F.lit(True)),
                       validate.attribute_error(F.col("orbital_slot"), F.col("platform_id"), F.col("scene_id")))
    return obs(spark, d).withColumn("error_message", error)


# Bands whose statistics the derived files carry; the others are absent.
FILE_BANDS = (1, 6, 7, 13)


def files(spark: SparkSession, d: str) -> DataFrame:
    """One row per file: attribute and scalar-variable maps, as a file reader gives them."""
    o = obs(spark, d)
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    bad_time = F.when(F.col("observation_id") % 10 == 3, "not a time").otherwise(iso("time_coverage_start"))
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    attrs = F.map_from_entries(F.filter(F.array(
        pair("id", F.col("observation_id").cast("string")), pair("platform_ID", F.col("platform_id")),
        pair("orbital_slot", F.col("orbital_slot")), pair("scene_id", F.col("scene_id")),
        pair("timeline_id", F.when(F.col("observation_id") % 3 != 0, "ABI Mode 6")),
        pair("time_coverage_start", bad_time), pair("time_coverage_end", iso("time_coverage_end")),
        pair("Conventions", F.lit("CF-1.7"))), lambda p: p["v"].isNotNull()))
    scale = F.col("file_size_mb")
    entries = []
    for b in FILE_BANDS:
        quantity = "reflectance_factor" if b <= C.LAST_REFLECTANCE_BAND else "brightness_temperature"
        for i, s in enumerate(("min", "mean", "max", "std_dev")):
            entries += [F.lit(f"{s}_{quantity}_C{b:02d}"), scale + float(b + i)]
        entries += [F.lit(f"outlier_pixel_count_C{b:02d}"), (F.col("observation_id") % (b + 1)).cast("double"),
                    F.lit(f"CMI_C{b:02d}"), F.lit(1.0)]
    entries += [F.lit("percent_uncorrectable_GRB_errors"), scale / 100.0,
                F.lit("percent_uncorrectable_L0_errors"), scale / 200.0]
    path = F.concat(F.lit("/incoming/"), F.col("observation_id").cast("string"), F.lit("/"), F.col("file_name"))
    # Generated as one row, so that filters on the attributes do not build the maps again.
    maps = F.inline(F.array(F.struct(attrs.alias("attrs"), F.create_map(*entries).alias("vars"))))
    return o.select(path.alias("file_path"), "file_name",
                    (F.col("observation_id") * 4096).alias("size_bytes"),
                    iso("time_coverage_start").alias("t"), maps)


# --- rasters and weights ----------------------------------------------------

def raster(spark: SparkSession, d: str) -> DataFrame:
    """One band of 8 x 8 pixels per vector; the vector id plays the time step."""
    flat = reshape.flatten(vectors(spark, d), "embedding", NX, ["vec_id", "label"])
    gap = (F.col("vec_id") * 64 + F.col("source_id")) % 97 == 0
    nan = F.lit(float("nan"))
    stripe = (F.col("vec_id") + F.floor(F.col("iy") / 3)) % 5
    return flat.select(
        "vec_id", "source_id", "iy", "ix", (F.col("label") + 7).cast("int").alias("band"),
        F.when(gap, nan).otherwise(250.0 + 100.0 * F.col("value").cast("double")).alias("cmi"),
        F.when(gap, nan).otherwise(stripe.cast("double")).alias("dqf"))


def targets(spark: SparkSession) -> DataFrame:
    """17 x 17 targets at half-pixel steps, a margin of half a pixel outside."""
    i, j = F.floor(F.col("id") / 17), F.col("id") % 17
    return spark.range(289).select(F.col("id").alias("target_id"), i.cast("int").alias("ilat"),
                                   j.cast("int").alias("ilon"), (0.5 * i - 0.5).alias("ty"), (0.5 * j - 0.5).alias("tx"))


def weights(spark: SparkSession) -> DataFrame:
    return Wt.lattice_weights(targets(spark), "tx", "ty", NX, NY)


def small_targets(spark: SparkSession) -> DataFrame:
    """5 x 5 targets at half-pixel steps over the 2 x 2 lattice of `pixels16`."""
    i, j = F.floor(F.col("id") / 5), F.col("id") % 5
    return spark.range(25).select(F.col("id").alias("target_id"), (0.5 * i - 0.5).alias("ty"), (0.5 * j - 0.5).alias("tx"))


def stations(spark: SparkSession, d: str) -> DataFrame:
    """One target point per order, in eighths of a pixel."""
    o = table(spark, d, "orders")
    eighth = lambda c: (F.col(c) % 73).cast("double") / 8.0 - 0.5
    return o.select(F.col("o_orderkey").alias("target_id"), eighth("o_custkey").alias("tx"),
                    eighth("o_orderkey").alias("ty"), (F.col("o_custkey") % 4).cast("int").alias("grid"))


def station_weights(spark: SparkSession, d: str) -> DataFrame:
    return Wt.lattice_weights(stations(spark, d), "tx", "ty", NX, NY, ["target_id", "grid"])


def pixels16(spark: SparkSession, d: str) -> DataFrame:
    """Wide pixels: 16 bands, four pixels per vector, with gaps."""
    e = vectors(spark, d).withColumn("source_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    gap = (F.col("vec_id") * 4 + F.col("source_id")) % 97 == 0

    def cmi(b):
        raw = F.get("embedding", ((b - 1) * 4 + F.col("source_id")).cast("int")).cast("double")
        value = 0.5 + raw if b <= C.LAST_REFLECTANCE_BAND else 260.0 + 80.0 * raw
        return F.when(gap, F.lit(float("nan"))).otherwise(value).alias(f"cmi_c{b:02d}")

    dqf = lambda b: ((F.col("vec_id") + F.col("source_id") + b) % 5).cast("short").alias(f"dqf_c{b:02d}")
    return e.select("vec_id", "source_id", *[cmi(b) for b in C.ALL_BANDS], *[dqf(b) for b in C.ALL_BANDS])


def measure(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("band"), F.col("l_shipdate").alias("time"),
                     F.col("l_partkey").alias("source_id"),
                     (200.0 + F.col("l_extendedprice") / 1000.0).alias("cmi"),
                     (F.col("l_quantity").cast("int") % 5).alias("dqf"))


def run_log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").alias("observation_id"), "event_id",
        F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("status"), "ts")


def axes(spark: SparkSession, d: str) -> DataFrame:
    """One longitude / latitude axis request per supplier; some cross the antimeridian."""
    s = table(spark, d, "supplier")
    k = F.col("s_suppkey")
    west = (k * 37 % 360 - 180).cast("double")
    span = (k * 13 % 90 + 1).cast("double")
    east = F.when(west + span > 180.0, west + span - 360.0).otherwise(west + span)
    return s.select(k.alias("axis_id"), west.alias("lon_min"),
                    F.when(k % 11 == 0, west).otherwise(east).alias("lon_max"),
                    (-60.0 + k % 30).alias("lat_min"), (-60.0 + k % 30 + span / 2.0).alias("lat_max"),
                    ((k % 4 + 1).cast("double") / 4.0).alias("resolution"))


def scan_pixels(spark: SparkSession, d: str) -> DataFrame:
    """One fixed-grid scan angle per order."""
    o = table(spark, d, "orders")
    angle = lambda c, m: ((F.col(c) * m) % 301 - 150).cast("double") / 1000.0
    return o.select("o_orderkey", angle("o_custkey", 7).alias("x"), angle("o_orderkey", 11).alias("y"))


def places(spark: SparkSession, d: str) -> DataFrame:
    """One geographic target point per customer."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("target_id"), ((k * 7 % 1201).cast("double") / 10.0 - 60.0).alias("lat"),
                    ((k * 13 % 1301).cast("double") / 10.0 - 140.0).alias("lon"))


# --- the same as DuckDB SQL -------------------------------------------------

_STAMP = "strftime({0}, '%Y%j%H%M%S') || substr(strftime({0}, '%f'), 1, 1)"


def _cmi_sql(b: int) -> str:
    raw = f"CAST(embedding[{(b - 1) * 4} + s + 1] AS DOUBLE)"
    value = f"0.5 + {raw}" if b <= C.LAST_REFLECTANCE_BAND else f"260 + 80 * {raw}"
    return f"CASE WHEN (vec_id * 4 + s) % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE {value} END AS cmi_c{b:02d}"


CTE = {
    "obs": f"""
SELECT event_id AS observation_id, ts AS time_coverage_start, ts + INTERVAL 10 MINUTE AS time_coverage_end,
  CASE user_id % 5 WHEN 0 THEN 'G16' WHEN 1 THEN 'G17' WHEN 2 THEN 'G18' WHEN 3 THEN 'G19' ELSE 'G99' END AS platform_id,
  CASE WHEN user_id % 7 = 6 THEN NULL WHEN user_id % 7 = 5 THEN 'GOES-Nowhere' WHEN user_id % 7 < 2 THEN 'GOES-East'
       WHEN user_id % 7 < 4 THEN 'GOES-West' ELSE 'GOES-Test' END AS orbital_slot,
  CASE event_type WHEN 'view' THEN 'Full Disk' WHEN 'click' THEN 'CONUS' WHEN 'purchase' THEN 'Mesoscale'
       WHEN 'error' THEN 'Limb' ELSE NULL END AS scene_id,
  value AS file_size_mb,
  concat(CASE WHEN event_id % 20 = 0 THEN 'XX' ELSE 'OR' END, '_ABI-L2-MCMIP',
    CASE event_type WHEN 'click' THEN 'C' WHEN 'purchase' THEN 'M' ELSE 'F' END, '-M6_G', 16 + user_id % 4,
    '_s', {_STAMP.format('ts')}, '_e', {_STAMP.format('(ts + INTERVAL 10 MINUTE)')},
    '_c', {_STAMP.format('(ts + INTERVAL 10 MINUTE)')}, '.nc') AS file_name
FROM events""",
    "scanned_obs": """
SELECT *, CASE WHEN file_name NOT LIKE 'OR@_%' ESCAPE '@' THEN 'Invalid filename pattern: ' || file_name
  WHEN orbital_slot NOT IN ('GOES-East','GOES-West','GOES-Test','GOES-Storage') THEN 'Invalid orbital_slot: ' || orbital_slot
  WHEN platform_id NOT IN ('G16','G17','G18','G19') THEN 'Invalid platform_id: ' || platform_id
  WHEN scene_id NOT IN ('Full Disk','CONUS','Mesoscale') THEN 'Invalid scene_id: ' || scene_id END AS error_message
FROM obs""",
    "raster": """
SELECT vec_id, CAST(pos AS BIGINT) AS source_id, CAST(pos // 8 AS INT) AS iy, CAST(pos % 8 AS INT) AS ix,
  CAST(label + 7 AS INT) AS band,
  CASE WHEN (vec_id*64+pos) % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE 250 + 100*CAST(e AS DOUBLE) END AS cmi,
  CASE WHEN (vec_id*64+pos) % 97 = 0 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST((vec_id + (pos // 8) // 3) % 5 AS DOUBLE) END AS dqf
FROM (SELECT vec_id, label, unnest(embedding) AS e, unnest(range(0, 64)) AS pos FROM embeddings)""",
    "targets": """
SELECT i*17+j AS target_id, CAST(i AS INT) AS ilat, CAST(j AS INT) AS ilon,
  CAST(-0.5 + 0.5*i AS DOUBLE) AS ty, CAST(-0.5 + 0.5*j AS DOUBLE) AS tx
FROM range(17) a(i), range(17) b(j)""",
    "stations": """
SELECT o_orderkey AS target_id, CAST(o_custkey % 73 AS DOUBLE)/8 - 0.5 AS tx,
  CAST(o_orderkey % 73 AS DOUBLE)/8 - 0.5 AS ty, CAST(o_custkey % 4 AS INT) AS grid
FROM orders""",
    "pixels16": "\nSELECT vec_id, CAST(s AS BIGINT) AS source_id, "
                + ",\n  ".join(_cmi_sql(b) for b in C.ALL_BANDS) + ",\n  "
                + ", ".join(f"CAST((vec_id + s + {b}) % 5 AS SMALLINT) AS dqf_c{b:02d}" for b in C.ALL_BANDS)
                + "\nFROM embeddings, range(4) r(s)",
    "measure": """
SELECT l_orderkey, l_linenumber, l_linenumber AS band, l_shipdate AS time, l_partkey AS source_id,
  200 + l_extendedprice/1000 AS cmi, CAST(l_quantity AS INT) % 5 AS dqf
FROM lineitem""",
    "run_log": """
SELECT user_id AS observation_id, event_id,
  CASE event_type WHEN 'error' THEN 'failed' ELSE 'done' END AS status, ts
FROM events""",
    "axes": """
SELECT axis_id, west AS lon_min,
  CASE WHEN axis_id % 11 = 0 THEN west WHEN west + span > 180 THEN west + span - 360 ELSE west + span END AS lon_max,
  CAST(-60 + axis_id % 30 AS DOUBLE) AS lat_min, -60 + axis_id % 30 + span/2 AS lat_max, resolution
FROM (SELECT s_suppkey AS axis_id, CAST(s_suppkey*37 % 360 - 180 AS DOUBLE) AS west,
  CAST(s_suppkey*13 % 90 + 1 AS DOUBLE) AS span, CAST(s_suppkey % 4 + 1 AS DOUBLE)/4 AS resolution FROM supplier)""",
    "scan_pixels": """
SELECT o_orderkey, CAST((o_custkey*7) % 301 - 150 AS DOUBLE)/1000 AS x,
  CAST((o_orderkey*11) % 301 - 150 AS DOUBLE)/1000 AS y
FROM orders""",
    "places": """
SELECT c_custkey AS target_id, CAST(c_custkey*7 % 1201 AS DOUBLE)/10 - 60 AS lat,
  CAST(c_custkey*13 % 1301 AS DOUBLE)/10 - 140 AS lon
FROM customer""",
}


def weights_sql(points: str, n: int = NX) -> str:
    """Closed-form weights of points (target_id, tx, ty) in the n x n lattice."""
    return f"""
SELECT target_id, CAST(rank AS INT) AS rank, CAST(source_id AS BIGINT) AS source_id, w,
  row_number() OVER (PARTITION BY target_id ORDER BY w DESC, rank) = 1 AS dominant,
  max(w) OVER (PARTITION BY target_id) AS max_w
FROM (
  SELECT target_id, unnest([0, 1, 2]) AS rank,
    unnest(CASE WHEN fx+fy <= 1 THEN [y0*{n}+x0, y0*{n}+x0+1, (y0+1)*{n}+x0] ELSE [(y0+1)*{n}+x0+1, (y0+1)*{n}+x0, y0*{n}+x0+1] END) AS source_id,
    unnest(CASE WHEN fx+fy <= 1 THEN [1-fx-fy, fx, fy] ELSE [fx+fy-1, 1-fx, 1-fy] END) AS w
  FROM (SELECT target_id, x0, y0, tx - x0 AS fx, ty - y0 AS fy
        FROM (SELECT target_id, tx, ty, least(CAST(floor(tx) AS BIGINT), {n - 2}) AS x0, least(CAST(floor(ty) AS BIGINT), {n - 2}) AS y0
              FROM {points} WHERE tx BETWEEN 0 AND {n - 1} AND ty BETWEEN 0 AND {n - 1})))"""


CTE["weights"] = weights_sql("targets")
CTE["station_weights"] = weights_sql("stations")
CTE["regridded"] = """
SELECT f.vec_id, f.band, t.target_id, CASE WHEN v.w0 IS NULL THEN CAST('NaN' AS DOUBLE) ELSE g.cmi END AS cmi,
  CAST(CASE WHEN v.w0 IS NULL THEN 3
    WHEN v.w0 >= 0.999 THEN CASE WHEN isnan(g.dom) THEN 6 ELSE g.dom END
    WHEN isnan(g.s) THEN 6 WHEN abs(g.s - round_even(g.s, 0)) < 1e-6 THEN round_even(g.s, 0) ELSE 5 END AS SMALLINT) AS dqf
FROM (SELECT DISTINCT vec_id, band FROM raster) f CROSS JOIN targets t
LEFT JOIN (SELECT target_id, max(max_w) AS w0 FROM weights GROUP BY target_id) v ON v.target_id = t.target_id
LEFT JOIN (SELECT r.vec_id, w.target_id, sum(w.w*r.cmi) AS cmi, sum(w.w*r.dqf) AS s,
             max(CASE WHEN w.dominant THEN r.dqf END) AS dom
           FROM raster r JOIN weights w USING (source_id) GROUP BY r.vec_id, w.target_id) g
  ON g.vec_id = f.vec_id AND g.target_id = t.target_id"""

# CTEs each CTE reads, so that a query names only what it reads itself.
_NEEDS = {"scanned_obs": ["obs"], "weights": ["targets"], "station_weights": ["stations"],
          "regridded": ["raster", "weights"]}


def with_ctes(names: str, body: str) -> str:
    """Prefix a SQL body with the named CTEs (space separated) and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered) + "\n" + body.strip()
