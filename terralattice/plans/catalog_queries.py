"""Catalog queries: sources, catalog sinks, filters, checks and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terralattice import session
from terralattice.functions import scalars as S
from terralattice.operators import catalog, ordering, runlog, store, summaries, validate
from terralattice.plans import fixtures as X
from terralattice.plans.registry import query
from terralattice.sinks import tables as sinks
from terralattice.sources import files as Fi, observations as Ob, tables as T

with_ctes = X.with_ctes
_SLOTS = "('GOES-East','GOES-West','GOES-Test','GOES-Storage')"

# --- sources ----------------------------------------------------------------


@query("src01_scan_directory", with_ctes("obs", """
SELECT DISTINCT 'platform_id=' || platform_id || '/orbital_slot=' || coalesce(orbital_slot, '__HIVE_DEFAULT_PARTITION__') AS folder FROM obs"""))
def _(spark, d):
    root = session.scratch_path(spark, "incoming")
    X.obs(spark, d).write.partitionBy("platform_id", "orbital_slot").parquet(root)
    found = Fi.scan_directory(spark, root, "*.parquet")
    parts = F.split("file_path", "/")
    return found.select(F.concat_ws("/", F.element_at(parts, -3), F.element_at(parts, -2)).alias("folder")).distinct()


@query("src08_listed_files", with_ctes("scanned_obs", """
SELECT observation_id, CASE WHEN observation_id % 13 = 0 THEN 'File not found'
  WHEN error_message LIKE 'Invalid filename%' THEN error_message WHEN observation_id % 17 = 0 THEN 'Not a regular file' ELSE error_message END AS error_message
FROM scanned_obs"""))
def _(spark, d):
    files = X.files(spark, d)
    number = F.try_element_at("attrs", F.lit("id")).cast("long")
    listed = files.where(number % 13 != 0).select("file_path", (number % 17 != 0).alias("is_file"))
    return Ob.scanned(files, listed).select(number.alias("observation_id"), "error_message")


@query("src02_foreign_files", with_ctes("obs", """
SELECT observation_id, file_name FROM obs WHERE NOT regexp_matches(file_name, '^OR_ABI-L2-MCMIP[FCM]-M[0-9]_G[0-9]{2}_s[0-9]{14}_e[0-9]{14}_c[0-9]{14}[.]nc')"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "file_name")
    return catalog.not_yet_known(o, Fi.product_files(o), ["observation_id", "file_name"])


@query("src02_explicit_files", with_ctes("obs", """
SELECT '/incoming/' || observation_id || '/' || file_name AS file_path, file_name FROM obs
WHERE regexp_matches(file_name, '^OR_ABI-L2-MCMIP[FCM]-M[0-9]_G[0-9]{2}_s[0-9]{14}_e[0-9]{14}_c[0-9]{14}[.]nc')"""))
def _(spark, d):
    return Fi.explicit_files(spark, Fi.product_files(X.files(spark, d).select("file_path", "file_name")))


@query("src03_product_files", with_ctes("obs", """
SELECT observation_id, file_name FROM obs WHERE regexp_matches(file_name, '^OR_ABI-L2-MCMIP[FCM]-M[0-9]_G[0-9]{2}_s[0-9]{14}_e[0-9]{14}_c[0-9]{14}[.]nc')"""))
def _(spark, d):
    return Fi.product_files(X.obs(spark, d)).select("observation_id", "file_name")


@query("src04_parse_names", with_ctes("obs", """
SELECT observation_id, file_name[16:16] AS scene, CAST(file_name[19:19] AS INT) AS mode,
  CAST(file_name[22:23] AS INT) AS satellite,
  time_bucket(INTERVAL 100 MILLISECOND, time_coverage_start) AS start_time,
  time_bucket(INTERVAL 100 MILLISECOND, time_coverage_end) AS end_time
FROM obs WHERE file_name LIKE 'OR%'"""))
def _(spark, d):
    parsed = Fi.parse_names(Fi.product_files(X.obs(spark, d)))
    return parsed.select("observation_id", "scene", "mode", "satellite", "start_time", "end_time")


@query("src05_start_order", with_ctes("obs", """
SELECT observation_id, row_number() OVER (ORDER BY time_bucket(INTERVAL 100 MILLISECOND, time_coverage_start), file_name, observation_id) - 1 AS place
FROM obs WHERE file_name LIKE 'OR%'"""))
def _(spark, d):
    parsed = Fi.parse_names(Fi.product_files(X.obs(spark, d)))
    placed = ordering.with_position(parsed, [], ["start_time", "file_name", "observation_id"], "place")
    return placed.select("observation_id", F.col("place").cast("long").alias("place"))


@query("srt01_sort_by_time", with_ctes("obs", """
SELECT observation_id, time_coverage_start FROM obs WHERE file_name LIKE 'OR%' ORDER BY 2, 1"""))
def _(spark, d):
    found = Fi.product_files(X.obs(spark, d)).select("observation_id", "time_coverage_start")
    return found.orderBy("time_coverage_start", "observation_id")


@query("src07_open_strict", with_ctes("obs", f"""
SELECT observation_id, time_coverage_start AS time, platform_id, orbital_slot,
  CASE WHEN observation_id % 3 <> 0 THEN 'ABI Mode 6' END AS scan_mode,
  CASE WHEN orbital_slot IS NULL THEN 'Invalid orbital_slot: missing'
       WHEN orbital_slot NOT IN {_SLOTS} THEN 'Invalid orbital_slot: ' || orbital_slot END AS error_message
FROM obs"""))
def _(spark, d):
    return Ob.opened(X.files(spark, d)).select(
        F.col("observation_id").cast("long").alias("observation_id"), "time", "platform_id", "orbital_slot",
        "scan_mode", "error_message")


@query("src08_scan_files", with_ctes("scanned_obs", """
SELECT observation_id, error_message FROM scanned_obs"""))
def _(spark, d):
    scanned = Ob.scanned(X.files(spark, d))
    key = F.try_element_at("attrs", F.lit("id")).cast("long")
    return scanned.select(key.alias("observation_id"), "error_message")


_OBSERVED = """
SELECT observation_id, platform_id, orbital_slot, scene_id,
  CASE WHEN observation_id % 3 <> 0 THEN 'ABI Mode 6' END AS scan_mode, 'CF-1.7' AS conventions,
  CASE WHEN observation_id % 10 <> 3 THEN time_coverage_start END AS time_coverage_start,
  time_coverage_end, time_coverage_start AS time, observation_id * 4096 / 1048576.0::DOUBLE AS file_size_mb
FROM scanned_obs WHERE error_message IS NULL"""


@query("src09_catalog_observations", with_ctes("scanned_obs", _OBSERVED))
def _(spark, d):
    return Ob.scan(X.files(spark, d)).observations.select(
        F.col("observation_id").cast("long").alias("observation_id"), "platform_id", "orbital_slot", "scene_id",
        "scan_mode", "conventions", "time_coverage_start", "time_coverage_end", "time", "file_size_mb")


@query("src09_catalog_errors", with_ctes("scanned_obs", """
SELECT '/incoming/' || observation_id || '/' || file_name AS file_path, error_message
FROM scanned_obs WHERE error_message IS NOT NULL"""))
def _(spark, d):
    return Ob.scan(X.files(spark, d)).validation_errors.select("file_path", "error_message")


def _stat_sql(b: int) -> str:
    stats = [f"file_size_mb + {float(b + i)} AS {s}" for i, s in enumerate(("min", "mean", "max", "std"))]
    return (f"SELECT observation_id, {b} AS band, {', '.join(stats)}, CAST(observation_id % {b + 1} AS INT) AS outliers "
            "FROM scanned_obs WHERE error_message IS NULL")


@query("prj13_band_statistics_rows", with_ctes("scanned_obs", """
, found AS (""".lstrip() + " UNION ALL ".join(_stat_sql(b) for b in X.FILE_BANDS) + """)
SELECT o.observation_id, CAST(n.band AS INT) AS band,
  CASE WHEN n.band <= 6 THEN f.min END AS min_reflectance, CASE WHEN n.band <= 6 THEN f.mean END AS mean_reflectance,
  CASE WHEN n.band > 6 THEN f.max END AS max_brightness_temp, CASE WHEN n.band > 6 THEN f.std END AS std_dev_brightness_temp,
  f.outliers AS outlier_count, f.band IS NOT NULL AS has_cmi
FROM scanned_obs o CROSS JOIN range(1, 17) n(band)
LEFT JOIN found f ON f.observation_id = o.observation_id AND f.band = n.band
WHERE o.error_message IS NULL"""))
def _(spark, d):
    return Ob.scan(X.files(spark, d)).band_statistics.select(
        F.col("observation_id").cast("long").alias("observation_id"), "band", "min_reflectance", "mean_reflectance",
        "max_brightness_temp", "std_dev_brightness_temp", "outlier_count", "has_cmi")


@query("prj10_statistics_lookup", with_ctes("scanned_obs", """
SELECT observation_id, file_size_mb + 7.0 AS min, file_size_mb + 9.0 AS max, file_size_mb + 8.0 AS mean
FROM scanned_obs WHERE error_message IS NULL"""))
def _(spark, d):
    stats = Ob.scan(X.files(spark, d)).band_statistics.where(F.col("band") == 7)
    return stats.select(F.col("observation_id").cast("long").alias("observation_id"),
                        F.col("min_brightness_temp").alias("min"), F.col("max_brightness_temp").alias("max"),
                        F.col("mean_brightness_temp").alias("mean"))


@query("prj11_data_quality", with_ctes("scanned_obs", """
SELECT observation_id, round(file_size_mb / 100, 6) AS grb_errors_percent, round(file_size_mb / 200, 6) AS l0_errors_percent
FROM scanned_obs WHERE error_message IS NULL"""))
def _(spark, d):
    return Ob.scan(X.files(spark, d)).data_quality.select(
        F.col("observation_id").cast("long").alias("observation_id"),
        F.round("grb_errors_percent", 6).alias("grb_errors_percent"),
        F.round("l0_errors_percent", 6).alias("l0_errors_percent"))


@query("prj07_promoted_attributes", with_ctes("scanned_obs", """
SELECT attribute, count(*) AS files, count(value) AS present FROM (
  SELECT unnest(['observation_id','platform_id','orbital_slot','scene_id','scan_mode','conventions','title']) AS attribute,
    unnest([CAST(observation_id AS VARCHAR), platform_id, orbital_slot, scene_id,
      CASE WHEN observation_id % 3 <> 0 THEN 'ABI Mode 6' END, 'CF-1.7', NULL]) AS value
  FROM scanned_obs WHERE error_message IS NULL) GROUP BY attribute"""))
def _(spark, d):
    names = ("observation_id", "platform_id", "orbital_slot", "scene_id", "scan_mode", "conventions", "title")
    o = Ob.scan(X.files(spark, d)).observations
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), F.col(n).alias("value")) for n in names])
    return o.select(F.inline(pairs)).groupBy("attribute").agg(F.count(F.lit(1)).alias("files"),
                                                              F.count("value").alias("present"))


@query("prj19_catalog_tables", with_ctes("scanned_obs", """
SELECT 'observations' AS table_name, count(*) FILTER (error_message IS NULL) AS row_count FROM scanned_obs
UNION ALL SELECT 'band_statistics', 16 * count(*) FILTER (error_message IS NULL) FROM scanned_obs
UNION ALL SELECT 'data_quality', count(*) FILTER (error_message IS NULL) FROM scanned_obs
UNION ALL SELECT 'validation_errors', count(*) FILTER (error_message IS NOT NULL) FROM scanned_obs"""))
def _(spark, d):
    c = Ob.scan(X.files(spark, d))
    rows = lambda df, name: df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
    return (rows(c.observations, "observations").unionByName(rows(c.band_statistics, "band_statistics"))
            .unionByName(rows(c.data_quality, "data_quality")).unionByName(rows(c.validation_errors, "validation_errors")))


@query("src10_catalog_csv_roundtrip", with_ctes("obs", """
SELECT observation_id, time_coverage_start, orbital_slot, file_size_mb FROM obs"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "time_coverage_start", "orbital_slot", "file_size_mb")
    path = session.scratch_path(spark, "catalog")
    sinks.write_catalog({"observations": o}, path, "csv")
    return T.load_catalog(spark, path, "csv", {"observations": o.schema, "data_quality": o.schema})["observations"]


@query("src13_url_inventory", """
SELECT CASE WHEN len(p) >= 6 THEN p[-6] END AS satellite, CASE WHEN len(p) >= 6 THEN p[-4] END AS year,
  CASE WHEN len(p) >= 6 THEN p[-3] END AS day_of_year, CASE WHEN len(p) >= 6 THEN p[-2] END AS hour, hour_url
FROM (SELECT hour_url, string_split(regexp_extract(hour_url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS p
      FROM (SELECT regexp_replace(url, '[?#].*$', '') || '/' || page_id || '/catalog.html' AS hour_url FROM pages))""")
def _(spark, d):
    pages = X.table(spark, d, "pages")
    url = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/"), F.col("page_id").cast("string"), F.lit("/catalog.html"))
    return Fi.remote_inventory(pages.select(url.alias("url")))


# --- filters ----------------------------------------------------------------

_FROM, _TO = "2024-01-05 00:00:00", "2024-01-20 12:00:00"


@query("flt01_files_for_period", with_ctes("obs", f"""
SELECT observation_id, time_coverage_start FROM obs
WHERE time_coverage_start BETWEEN TIMESTAMP '{_FROM}' AND TIMESTAMP '{_TO}' AND orbital_slot = 'GOES-East'"""))
def _(spark, d):
    return catalog.files_for_period(X.obs(spark, d), _FROM, _TO, "GOES-East").select("observation_id", "time_coverage_start")


@query("flt02_files_contained", with_ctes("obs", f"""
SELECT observation_id, time_coverage_end FROM obs
WHERE time_coverage_start >= TIMESTAMP '{_FROM}' AND time_coverage_end <= TIMESTAMP '{_TO}'
  AND orbital_slot = 'GOES-West' AND scene_id = 'CONUS'"""))
def _(spark, d):
    found = catalog.files_contained(X.obs(spark, d), _FROM, _TO, "GOES-West", "CONUS")
    return found.select("observation_id", "time_coverage_end")


@query("flt03_files_for_platform", with_ctes("obs", "SELECT observation_id FROM obs WHERE platform_id = 'G18'"))
def _(spark, d):
    return catalog.files_for_platform(X.obs(spark, d), "G18").select("observation_id")


@query("flt04_valid_files", with_ctes("scanned_obs", "SELECT observation_id FROM scanned_obs WHERE error_message IS NULL"))
def _(spark, d):
    return catalog.valid_files(X.scanned_obs(spark, d)).select("observation_id")


@query("flt04_invalid_files", with_ctes("scanned_obs", """
SELECT observation_id, error_message FROM scanned_obs WHERE error_message IS NOT NULL"""))
def _(spark, d):
    return catalog.invalid_files(X.scanned_obs(spark, d)).select("observation_id", "error_message")


@query("flt05_time_range", with_ctes("obs", f"""
SELECT orbital_slot, count(*) AS files FROM obs
WHERE time_coverage_start BETWEEN TIMESTAMP '{_FROM}' AND TIMESTAMP '{_TO}' GROUP BY orbital_slot"""))
def _(spark, d):
    found = catalog.in_time_range(X.obs(spark, d), _FROM, _TO, "time_coverage_start")
    return found.groupBy("orbital_slot").agg(F.count(F.lit(1)).alias("files"))


_STEPS = """, steps AS (SELECT observation_id, orbital_slot,
  row_number() OVER (PARTITION BY orbital_slot ORDER BY time_coverage_start, observation_id) - 1 AS time_idx FROM obs)
"""


def _stepped(spark, d):
    return ordering.with_position(X.obs(spark, d).select("observation_id", "orbital_slot", "time_coverage_start"),
                                  ["orbital_slot"], ["time_coverage_start", "observation_id"], "time_idx").select(
        "observation_id", "orbital_slot", F.col("time_idx").cast("long").alias("time_idx"))


@query("win06_time_index", with_ctes("obs", _STEPS + "SELECT observation_id, orbital_slot, time_idx FROM steps"))
def _(spark, d):
    return _stepped(spark, d)


@query("flt06_single_step", with_ctes("obs", _STEPS + "SELECT observation_id, orbital_slot, time_idx FROM steps WHERE time_idx = 5"))
def _(spark, d):
    return catalog.single_step(_stepped(spark, d), 5)


@query("flt07_step_slice", with_ctes("obs", _STEPS + """
SELECT observation_id, orbital_slot, time_idx FROM steps WHERE time_idx >= 10 AND time_idx < 40"""))
def _(spark, d):
    return catalog.step_slice(_stepped(spark, d), 10, 40)


@query("win09_checkpoint_batches", with_ctes("obs", _STEPS + """
SELECT orbital_slot, time_idx // 500 AS batch, count(*) AS files, count(*) FILTER ((time_idx + 1) % 500 = 0) AS closing
FROM steps GROUP BY 1, 2"""))
def _(spark, d):
    marked = runlog.batches(X.obs(spark, d), ["orbital_slot"], ["time_coverage_start", "observation_id"], 500)
    return marked.groupBy("orbital_slot", F.col("batch").cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if("ends_batch").alias("closing"))


@query("flt08_file_rules", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'File not found'
  WHEN event_id % 20 = 0 THEN 'Invalid filename pattern: XX.nc'
  WHEN event_type = 'view' THEN 'Not a regular file' END AS error_message FROM events""")
def _(spark, d):
    e = X.table(spark, d, "events")
    name = F.when(F.col("event_id") % 20 == 0, "XX.nc").otherwise(
        "OR_ABI-L2-MCMIPF-M6_G18_s20240030200212_e20240030209521_c20240030210015.nc")
    error = validate.file_error(name, F.col("event_type") != "error", F.col("event_type") != "view")
    return e.select("event_id", error.alias("error_message"))


@query("flt09_attribute_rules", with_ctes("obs", f"""
SELECT coalesce(CASE WHEN orbital_slot NOT IN {_SLOTS} THEN 'Invalid orbital_slot: ' || orbital_slot
  WHEN platform_id NOT IN ('G16','G17','G18','G19') THEN 'Invalid platform_id: ' || platform_id
  WHEN scene_id NOT IN ('Full Disk','CONUS','Mesoscale') THEN 'Invalid scene_id: ' || scene_id END, 'ok') AS outcome,
  count(*) AS files FROM obs GROUP BY 1"""))
def _(spark, d):
    error = validate.attribute_error(F.col("orbital_slot"), F.col("platform_id"), F.col("scene_id"))
    return (X.obs(spark, d).groupBy(F.coalesce(error, F.lit("ok")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("files")))


@query("flt10_strict_slot", with_ctes("obs", f"""
SELECT observation_id FROM obs WHERE orbital_slot IS NULL OR orbital_slot NOT IN {_SLOTS}"""))
def _(spark, d):
    return X.obs(spark, d).where(~validate.strict_slot_ok(F.col("orbital_slot"))).select("observation_id")


# --- summaries and checks ---------------------------------------------------


@query("agg07_catalog_totals", with_ctes("scanned_obs", """
SELECT count(*) AS total_scanned, count(*) FILTER (error_message IS NULL) AS valid_files,
  count(*) FILTER (error_message IS NOT NULL) AS invalid_files,
  min(time_coverage_start) FILTER (error_message IS NULL) AS earliest,
  max(time_coverage_end) FILTER (error_message IS NULL) AS latest,
  round(sum(file_size_mb) FILTER (error_message IS NULL) / 1024, 6) AS total_size_gb FROM scanned_obs"""))
def _(spark, d):
    t = catalog.totals(X.scanned_obs(spark, d))
    return t.withColumn("total_size_gb", F.round("total_size_gb", 6))


def _kept(spark, d):
    """Partial results of three batches of the catalog: one comes twice, one is replaced, two are made one."""
    scanned, path = X.scanned_obs(spark, d), session.scratch_path(spark, "summaries")
    batch = lambda b: scanned.where(F.col("observation_id") % 3 == b)
    summaries.add_batch(batch(0).where("observation_id % 2 = 0"), path, "0")
    for b in (0, 1, 2, 1):
        summaries.add_batch(batch(b), path, str(b))
    summaries.compact(spark, path, ["0", "1"])
    return summaries.folded(spark, path)


@query("agg07_kept_totals", with_ctes("scanned_obs", """
SELECT count(*) AS total_scanned, count(*) FILTER (error_message IS NULL) AS valid_files, count(*) FILTER (error_message IS NOT NULL) AS invalid_files,
  min(time_coverage_start) FILTER (error_message IS NULL) AS earliest, max(time_coverage_end) FILTER (error_message IS NULL) AS latest,
  round(sum(file_size_mb) FILTER (error_message IS NULL) / 1024, 3) AS total_size_gb FROM scanned_obs"""))
def _(spark, d):
    return summaries.totals(_kept(spark, d)).withColumn("total_size_gb", F.round("total_size_gb", 3))


@query("agg07_kept_breakdown", with_ctes("scanned_obs", """
SELECT attribute, value, CAST(count(*) AS BIGINT) AS files FROM (
  SELECT unnest(['platform_id','orbital_slot','scene_id']) AS attribute, unnest([platform_id, orbital_slot, scene_id]) AS value
  FROM scanned_obs WHERE error_message IS NULL) WHERE value IS NOT NULL GROUP BY 1, 2"""))
def _(spark, d):
    return summaries.breakdown(_kept(spark, d))


@query("agg20_kept_coverage", with_ctes("obs", """
SELECT orbital_slot, min(time_coverage_start) AS coverage_start, max(time_coverage_end) AS coverage_end FROM obs GROUP BY 1"""))
def _(spark, d):
    return summaries.coverage(_kept(spark, d))


@query("agg07_catalog_breakdown", with_ctes("scanned_obs", """
SELECT attribute, value, count(*) AS files FROM (
  SELECT unnest(['platform_id','orbital_slot','scene_id']) AS attribute, unnest([platform_id, orbital_slot, scene_id]) AS value
  FROM scanned_obs WHERE error_message IS NULL) WHERE value IS NOT NULL GROUP BY 1, 2"""))
def _(spark, d):
    return catalog.breakdown(X.scanned_obs(spark, d))


@query("agg08_time_range", with_ctes("obs", """
SELECT orbital_slot, min(time_coverage_start) AS coverage_start, max(time_coverage_end) AS coverage_end
FROM obs GROUP BY orbital_slot"""))
def _(spark, d):
    return store.time_coverage(X.obs(spark, d), ["orbital_slot"], "time_coverage_start", "time_coverage_end").drop(
        "duration_seconds")


@query("agg20_temporal_coverage", with_ctes("obs", """
SELECT coalesce(orbital_slot, 'none') AS orbital_slot,
  round(epoch_us(max(time_coverage_end) - min(time_coverage_start)) / 1e6, 6) AS duration_seconds
FROM obs GROUP BY orbital_slot"""))
def _(spark, d):
    cover = store.time_coverage(X.obs(spark, d), ["orbital_slot"], "time_coverage_start", "time_coverage_end")
    return cover.select(F.coalesce("orbital_slot", F.lit("none")).alias("orbital_slot"),
                        F.round("duration_seconds", 6).alias("duration_seconds"))


@query("agg10_observation_count", with_ctes("obs", """
SELECT orbital_slot, count(DISTINCT time_coverage_start) AS observations FROM obs GROUP BY orbital_slot"""))
def _(spark, d):
    return store.observation_count(X.obs(spark, d), ["orbital_slot"], "time_coverage_start")


@query("agg11_platforms", with_ctes("obs", """
SELECT DISTINCT orbital_slot, platform_id FROM obs WHERE platform_id IS NOT NULL"""))
def _(spark, d):
    return store.platforms(X.obs(spark, d), ["orbital_slot"])


_DISORDER = """, seen AS (SELECT coalesce(orbital_slot, 'none') AS region, observation_id, scene_id, orbital_slot,
  CASE WHEN observation_id % 7 = 0 THEN '1km' ELSE '2km' END AS spatial_resolution,
  CASE WHEN observation_id % 501 = 0 AND orbital_slot = 'GOES-West' THEN time_coverage_start - INTERVAL 1 DAY ELSE time_coverage_start END AS time
  FROM obs)
, stepped AS (SELECT region, observation_id, time, lag(time) OVER (PARTITION BY region ORDER BY observation_id) AS previous FROM seen)
"""


def _seen(spark, d):
    o = X.obs(spark, d)
    late = (F.col("observation_id") % 501 == 0) & (F.col("orbital_slot") == "GOES-West")
    time = F.when(late, F.col("time_coverage_start") - F.expr("INTERVAL '1' DAY")).otherwise(F.col("time_coverage_start"))
    return o.select(F.coalesce("orbital_slot", F.lit("none")).alias("region"), "observation_id", "scene_id", "orbital_slot",
                    F.when(F.col("observation_id") % 7 == 0, "1km").otherwise("2km").alias("spatial_resolution"),
                    time.alias("time"))


@query("win01_time_increasing", with_ctes("obs", _DISORDER + """
SELECT region, count(*) AS n, bool_and(previous IS NULL OR time > previous) AS increasing FROM stepped GROUP BY region"""))
def _(spark, d):
    return ordering.strictly_increasing(_seen(spark, d), ["region"], ["observation_id"], "time")


@query("agg12_consistency", with_ctes("obs", _DISORDER + """
, parts AS (SELECT region, count(*) AS n,
    string_agg(DISTINCT scene_id, ', ' ORDER BY scene_id) AS scenes, count(DISTINCT scene_id) AS n_scenes,
    string_agg(DISTINCT spatial_resolution, ', ' ORDER BY spatial_resolution) AS sizes, count(DISTINCT spatial_resolution) AS n_sizes
  FROM seen GROUP BY region)
, rising AS (SELECT region, bool_and(previous IS NULL OR time > previous) AS ok FROM stepped GROUP BY region)
SELECT region, n, issues = '' AS consistent, issues FROM (
  SELECT region, n, concat_ws('; ', CASE WHEN n_scenes > 1 THEN 'Inconsistent scene_id: ' || scenes END,
    CASE WHEN n_sizes > 1 THEN 'Inconsistent spatial_resolution: ' || sizes END,
    CASE WHEN NOT ok THEN 'Time values are not monotonically increasing' END) AS issues
  FROM parts JOIN rising USING (region))"""))
def _(spark, d):
    return validate.consistency(_seen(spark, d), ["region"], ["observation_id"])


@query("agg13_structure", with_ctes("obs", _DISORDER + """
SELECT region, count(*) AS n, false AS compliant,
  concat_ws('; ', 'Missing ''conventions'' variable; Missing required coordinate: y; Missing required coordinate: x',
    CASE WHEN NOT bool_and(previous IS NULL OR time > previous) THEN 'Time coordinate is not monotonically increasing' END) AS issues,
  'Missing ''projection'' variable' AS warnings FROM stepped GROUP BY region"""))
def _(spark, d):
    return validate.structure(_seen(spark, d), ["region"], ["observation_id"])


@query("win05_batch_continuity", with_ctes("obs", _DISORDER + """
, ends AS (SELECT region, observation_id // 167 AS batch, min_by(time, observation_id) AS first_time,
    max_by(time, observation_id) AS last_time FROM seen GROUP BY 1, 2)
SELECT region, batch, first_time, last_time, coalesce(first_time > previous_last, true) AS continuous
FROM (SELECT *, lag(last_time) OVER (PARTITION BY region ORDER BY batch) AS previous_last FROM ends)"""))
def _(spark, d):
    batched = _seen(spark, d).withColumn("batch", F.floor(F.col("observation_id") / 167).cast("long"))
    return runlog.continuity(batched, ["region"], "batch", "observation_id", "time").select(
        "region", "batch", "first_time", "last_time", "continuous")


@query("jon08_observation_statistics", with_ctes("scanned_obs", """
SELECT observation_id, platform_id, file_size_mb + 13.0 AS min_window, round(file_size_mb / 100, 6) AS grb_errors_percent
FROM scanned_obs WHERE error_message IS NULL"""))
def _(spark, d):
    c = Ob.scan(X.files(spark, d))
    window = c.band_statistics.where(F.col("band") == 13).select("observation_id", F.col("min_brightness_temp").alias("min_window"))
    joined = c.observations.join(window, "observation_id").join(c.data_quality, "observation_id")
    return joined.select(F.col("observation_id").cast("long").alias("observation_id"), "platform_id", "min_window",
                         F.round("grb_errors_percent", 6).alias("grb_errors_percent"))


# --- growth -----------------------------------------------------------------


@query("jon07_new_records", with_ctes("obs", """
SELECT observation_id FROM obs WHERE observation_id % 3 <> 0"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id")
    return catalog.not_yet_known(o, o.where(F.col("observation_id") % 3 == 0), ["observation_id"])


@query("snk02_append_catalog", with_ctes("obs", """
SELECT observation_id, orbital_slot, file_size_mb FROM obs"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "orbital_slot", "file_size_mb")
    known = o.where(F.col("observation_id") % 2 == 0)
    overlapping = o.where(F.col("observation_id") % 3 != 1).select("file_size_mb", "observation_id", "orbital_slot")
    return catalog.grow(catalog.grow(known, overlapping, ["observation_id"]), o, ["observation_id"])


@query("snk02_append_dedup", with_ctes("measure", """
SELECT l_orderkey, l_linenumber, count(*) AS kept, round(sum(cmi), 6) AS cmi FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY band, time, source_id, cmi, dqf) AS place FROM measure)
WHERE place = 1 GROUP BY 1, 2"""))
def _(spark, d):
    kept = catalog.settle(X.measure(spark, d), ["l_orderkey", "l_linenumber"])
    return kept.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("kept"),
                                                          F.round(F.sum("cmi"), 6).alias("cmi"))


@query("snk07_append_positions", with_ctes("obs", """
, placed AS (SELECT observation_id, observation_id % 4 = 0 AS new_row,
  row_number() OVER (ORDER BY observation_id % 4 = 0, time_coverage_start, observation_id) - 1 AS place FROM obs)
SELECT observation_id, place FROM placed WHERE new_row"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "time_coverage_start")
    stored, new = o.where(F.col("observation_id") % 4 != 0), o.where(F.col("observation_id") % 4 == 0)
    order = ["time_coverage_start", "observation_id"]
    held = ordering.with_position(stored, [], order, "place")
    return ordering.append_positions(new, held, order, "place").select("observation_id", "place")


@query("snk07_appended_range", with_ctes("obs", """
SELECT count(*) FILTER (observation_id % 4 <> 0) AS "start", count(*) AS "end" FROM obs"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "time_coverage_start")
    order = ["time_coverage_start", "observation_id"]
    held = ordering.with_position(o.where(F.col("observation_id") % 4 != 0), [], order, "place")
    placed = ordering.append_positions(o.where(F.col("observation_id") % 4 == 0), held, order, "place")
    return ordering.position_range(placed, "place")


@query("snk08_replace_selection", with_ctes("obs", """
SELECT observation_id, CASE WHEN observation_id % 5 = 0 THEN -1.0 ELSE file_size_mb END AS file_size_mb FROM obs"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "file_size_mb")
    changed = o.where(F.col("observation_id") % 5 == 0).withColumn("file_size_mb", F.lit(-1.0))
    return sinks.replace_selection(o, changed, ["observation_id"])


@query("snk12_metadata_records", with_ctes("scanned_obs", """
SELECT observation_id, time_coverage_start AS time, '/incoming/' || observation_id || '/' || file_name AS file_path, orbital_slot
FROM scanned_obs WHERE error_message IS NULL"""))
def _(spark, d):
    records = Ob.metadata_records(Ob.scan(X.files(spark, d)).observations)
    return records.select(F.col("observation_id").cast("long").alias("observation_id"), "time", "file_path", "orbital_slot")


@query("agg21_source_files", with_ctes("obs", """
SELECT orbital_slot, count(DISTINCT file_name) AS source_file_count FROM obs WHERE orbital_slot IS NOT NULL GROUP BY orbital_slot"""))
def _(spark, d):
    o = X.obs(spark, d).where(F.col("orbital_slot").isNotNull()).withColumnRenamed("file_name", "file_path")
    files = store.source_files(o.where(F.col("observation_id") % 3 != 0), o.where(F.col("observation_id") % 2 == 0), ["orbital_slot"])
    rest = store.source_files(files, o, ["orbital_slot"])
    return store.source_file_count(rest, ["orbital_slot"])


@query("set01_union_catalogs", with_ctes("obs", """
SELECT observation_id, orbital_slot, CASE WHEN observation_id % 2 = 1 THEN scene_id END AS scene_id FROM obs"""))
def _(spark, d):
    o = X.obs(spark, d)
    old = o.where(F.col("observation_id") % 2 == 0).select("observation_id", "orbital_slot")
    new = o.where(F.col("observation_id") % 2 == 1).select("observation_id", "scene_id", "orbital_slot")
    return old.unionByName(new, allowMissingColumns=True)


@query("set02_distinct_files", with_ctes("obs", """
SELECT DISTINCT file_name FROM obs"""))
def _(spark, d):
    o = X.obs(spark, d).select("file_name")
    return o.union(o).distinct()


@query("set05_column_sets", with_ctes("obs", """
SELECT column_name, count(*) AS rows_with_value FROM (
  SELECT unnest(['file_size_mb','observation_id','scene_id']) AS column_name,
    unnest([CAST(file_size_mb AS VARCHAR), CAST(observation_id AS VARCHAR), scene_id]) AS v FROM obs) WHERE v IS NOT NULL GROUP BY 1"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "scene_id", "file_size_mb")
    reordered = o.select("scene_id", "file_size_mb", "observation_id")
    catalog.same_columns(o, reordered)
    merged = catalog.grow(o.where(F.lit(False)), reordered, ["observation_id"])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in o.columns])
    return (merged.select(F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("rows_with_value")))


@query("set06_required_missing", with_ctes("obs", """
SELECT name FROM (SELECT unnest(['GOES-East','GOES-West','GOES-Test','GOES-Storage']) AS name)
WHERE name NOT IN (SELECT orbital_slot FROM obs WHERE orbital_slot IS NOT NULL)"""))
def _(spark, d):
    present = X.obs(spark, d).select(F.col("orbital_slot").alias("name")).distinct()
    return T.required_names(present, ["GOES-East", "GOES-West", "GOES-Test", "GOES-Storage"])


# --- sampling ---------------------------------------------------------------


@query("srt02_checkpoint_retention", """
SELECT run, checkpoint FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY checkpoint DESC) AS place FROM (
  SELECT user_id AS run, 'checkpoint_' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '.json' AS checkpoint FROM events)) WHERE place <= 5""")
def _(spark, d):
    e = X.table(spark, d, "events")
    name = F.concat(F.lit("checkpoint_"), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit(".json"))
    return ordering.newest(e.select(F.col("user_id").alias("run"), name.alias("checkpoint")), ["run"], "checkpoint", 5)


@query("srt03_even_sample", with_ctes("obs", _STEPS + """
, sizes AS (SELECT orbital_slot, count(*) AS size FROM obs GROUP BY orbital_slot)
, picks AS (SELECT orbital_slot, CASE WHEN size <= 37 THEN i ELSE CAST(floor(i * size / 37) AS BIGINT) END AS time_idx
  FROM sizes, range(37) r(i) WHERE i < size)
SELECT s.observation_id, s.orbital_slot FROM steps s
JOIN picks p ON s.orbital_slot IS NOT DISTINCT FROM p.orbital_slot AND s.time_idx = p.time_idx"""))
def _(spark, d):
    o = X.obs(spark, d).select("observation_id", "orbital_slot", "time_coverage_start")
    return ordering.even_sample(o, ["orbital_slot"], ["time_coverage_start", "observation_id"], 37).drop("time_coverage_start")


@query("srt04_seeded_sample", """
SELECT event_id FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 100""")
def _(spark, d):
    return ordering.seeded_sample(X.table(spark, d, "events").select("event_id"), "event_id", 100, 42)


@query("win08_every_kth", """
WITH sizes AS (SELECT user_id, greatest(1, count(*) // 10) AS k FROM events GROUP BY user_id)
SELECT event_id, user_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS p FROM events)
JOIN sizes USING (user_id) WHERE p % k = 0""")
def _(spark, d):
    e = X.table(spark, d, "events").select("event_id", "user_id")
    return ordering.every_kth(e, ["user_id"], ["event_id"], 10)


# --- text, time and map functions -------------------------------------------


@query("scl05_product_stamps", with_ctes("obs", """
SELECT observation_id, time_bucket(INTERVAL 100 MILLISECOND, time_coverage_start) AS stamp FROM obs"""))
def _(spark, d):
    o = X.obs(spark, d)
    return o.select("observation_id", S.product_stamp(F.date_format("time_coverage_start", "yyyyDDDHHmmssS")).alias("stamp"))


@query("scl06_iso_times", with_ctes("obs", """
SELECT observation_id, CASE WHEN observation_id % 10 <> 3 THEN time_coverage_start END AS time FROM obs"""))
def _(spark, d):
    text = F.when(F.col("observation_id") % 10 == 3, "yesterday").otherwise(
        F.date_format("time_coverage_start", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return X.obs(spark, d).select("observation_id", S.iso_timestamp(text).alias("time"))


@query("scl22_text_defaults", with_ctes("obs", """
SELECT coalesce(nullif(CASE WHEN observation_id % 4 = 0 THEN '' ELSE scene_id END, ''), 'unknown') AS scan_mode, count(*) AS files
FROM obs GROUP BY 1"""))
def _(spark, d):
    mode = F.when(F.col("observation_id") % 4 == 0, "").otherwise(F.col("scene_id"))
    return X.obs(spark, d).groupBy(S.text_or_unknown(mode).alias("scan_mode")).agg(F.count(F.lit(1)).alias("files"))


@query("scl23_size_units", with_ctes("obs", """
SELECT observation_id, round(observation_id * 123457 / CAST(1048576 AS DOUBLE), 6) AS mib,
  round(observation_id * 123457 / CAST(1048576 AS DOUBLE) / 1024, 6) AS gib FROM obs"""))
def _(spark, d):
    mib = S.bytes_to_mib(F.col("observation_id") * 123457)
    return X.obs(spark, d).select("observation_id", F.round(mib, 6).alias("mib"), F.round(S.mib_to_gib(mib), 6).alias("gib"))


@query("scl24_history_lines", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z: ' || event_type AS line FROM events""")
def _(spark, d):
    return X.table(spark, d, "events").select("event_id", store.history_line(F.col("ts"), F.col("event_type")).alias("line"))


@query("scl26_attribute_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type AS kind, CAST(value AS VARCHAR) AS value FROM events""")
def _(spark, d):
    e = X.table(spark, d, "events")
    own = F.create_map(F.lit("kind"), F.lit("?"), F.lit("gone"), F.lit("x"))
    new = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("value"), F.col("value").cast("string"))
    text = F.to_json(S.drop_map_keys(S.merge_maps(own, new), ["gone"]))
    back = F.from_json(text, "map<string,string>")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                    back["kind"].alias("kind"), back["value"].alias("value"))


@query("snk13_merge_attributes", """
SELECT node_path, key, value FROM (
  SELECT 's/' || s_suppkey AS node_path, unnest(['title', 'units', 'note']) AS key,
    unnest([s_name, CASE WHEN s_suppkey % 2 = 0 THEN '1' ELSE 'K' END, CASE WHEN s_suppkey % 2 = 0 THEN 'n' || s_nationkey END]) AS value
  FROM supplier) WHERE value IS NOT NULL""")
def _(spark, d):
    s = X.table(spark, d, "supplier").withColumn("node_path", F.concat(F.lit("s/"), F.col("s_suppkey").cast("string")))
    current = s.select("node_path", F.create_map(F.lit("title"), F.col("s_name"), F.lit("units"), F.lit("K")).alias("attrs"))
    changes = s.where(F.col("s_suppkey") % 2 == 0).select("node_path", F.create_map(
        F.lit("units"), F.lit("1"), F.lit("note"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).alias("attrs"))
    return store.set_attributes(current, changes).select("node_path", F.explode("attrs").alias("key", "value"))


@query("snk13_delete_attributes", """
SELECT 's/' || s_suppkey AS node_path, 'title' AS key, s_name AS value FROM supplier""")
def _(spark, d):
    s = X.table(spark, d, "supplier")
    current = s.select(F.concat(F.lit("s/"), F.col("s_suppkey").cast("string")).alias("node_path"),
                       F.create_map(F.lit("title"), F.col("s_name"), F.lit("units"), F.lit("K")).alias("attrs"))
    return store.delete_attributes(current, ["units"]).select("node_path", F.explode("attrs").alias("key", "value"))


# --- processing state -------------------------------------------------------


@query("agg15_retry_candidates", with_ctes("run_log", """
SELECT observation_id, count(*) AS failures, count(*) <= 12 AS retry FROM run_log WHERE status = 'failed' GROUP BY observation_id"""))
def _(spark, d):
    return runlog.failures(X.run_log(spark, d), 12)


@query("agg16_success_rate", with_ctes("run_log", """
SELECT count(*) FILTER (status = 'done') AS processed_count, count(*) FILTER (status = 'failed') AS failed_count,
  round(count(*) FILTER (status = 'done') / CAST(count(*) FILTER (status = 'done')
    + count(DISTINCT CASE WHEN status = 'failed' THEN observation_id END) AS DOUBLE), 9) AS success_rate FROM run_log"""))
def _(spark, d):
    s = runlog.summary(X.run_log(spark, d))
    return s.select("processed_count", "failed_count", F.round("success_rate", 9).alias("success_rate"))


_STATE = """
SELECT count(*) FILTER (status = 'done') AS processed_count, count(*) FILTER (status = 'failed') AS failed_count,
  count(DISTINCT CASE WHEN status = 'failed' THEN observation_id END) AS failed_items,
  max(CASE WHEN status = 'done' THEN observation_id END) AS last_processed,
  min(ts) AS start_time, max(ts) AS end_time, round(epoch_us(max(ts) - min(ts)) / 1e6, 6) AS elapsed_seconds FROM run_log"""


@query("agg17_processing_summary", with_ctes("run_log", _STATE))
def _(spark, d):
    return runlog.summary(X.run_log(spark, d)).drop("success_rate").withColumn("elapsed_seconds", F.round("elapsed_seconds", 6))


@query("snk11_checkpoint_roundtrip", with_ctes("run_log", _STATE))
def _(spark, d):
    state = runlog.summary(X.run_log(spark, d)).drop("success_rate").withColumn("elapsed_seconds", F.round("elapsed_seconds", 6))
    path = session.scratch_path(spark, "checkpoint")
    runlog.checkpoint(state).write.text(path)
    return runlog.restore(spark.read.text(path), state.schema)


@query("snk10_failed_roundtrip", with_ctes("run_log", """
SELECT CAST(observation_id AS VARCHAR) AS observation_id, status, ts FROM run_log WHERE status = 'failed'"""))
def _(spark, d):
    log = X.run_log(spark, d).select(F.col("observation_id").cast("string").alias("observation_id"), "status",
                                     F.col("ts").cast("timestamp").alias("ts"))
    path = session.scratch_path(spark, "failed")
    sinks.export_failed(log, path)
    return sinks.import_failed(spark, path).select("observation_id", "status", "ts")


@query("srt05_retry_order", with_ctes("run_log", """
SELECT observation_id FROM run_log WHERE status = 'failed' GROUP BY observation_id HAVING count(*) <= 12 ORDER BY observation_id"""))
def _(spark, d):
    return runlog.failures(X.run_log(spark, d), 12).where("retry").select("observation_id").orderBy("observation_id")


@query("str03_attempt_numbers", with_ctes("run_log", """
SELECT event_id, observation_id, CAST(row_number() OVER (PARTITION BY observation_id ORDER BY ts, event_id) AS INT) AS attempt, status FROM run_log"""))
def _(spark, d):
    log = runlog.with_attempts(X.run_log(spark, d), order=["ts", "event_id"])
    return log.select("event_id", "observation_id", "attempt", "status")


@query("str04_retry_inputs", """
SELECT o_orderkey AS observation_id FROM orders o WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) <= 2)
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')""")
def _(spark, d):
    log = X.table(spark, d, "lineitem").where(F.col("l_returnflag").isin("R", "N")).select(
        F.col("l_orderkey").alias("observation_id"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("done").alias("status"))
    inputs = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("observation_id"))
    return runlog.retry_inputs(inputs, log, max_retries=2)


@query("str04_skip_failed", with_ctes("run_log", """
SELECT status, count(*) AS attempts FROM run_log WHERE status <> 'failed' GROUP BY status"""))
def _(spark, d):
    return runlog.skip_failed(X.run_log(spark, d)).groupBy("status").agg(F.count(F.lit(1)).alias("attempts"))


@query("str05_resume_set", """
SELECT o_orderkey AS observation_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')""")
def _(spark, d):
    log = X.table(spark, d, "lineitem").where(F.col("l_returnflag") == "N").select(
        F.col("l_orderkey").alias("observation_id"), F.lit("done").alias("status"))
    inputs = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("observation_id"))
    return runlog.resume_inputs(inputs, log)
