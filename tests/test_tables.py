"""Sources, sinks, streams, recipes and column-level rules."""

import math

import pytest
from pyspark.sql import functions as F

from check_queries import plan_of
from terralattice import constants as C, dims, schemas, session
from terralattice.functions import recipes, scalars as S
from terralattice.operators import bands as B, catalog, ordering, store, summaries, validate, weights as W
from terralattice.plans import fixtures as X
from terralattice.sinks import tables as sinks
from terralattice.sources import files as Fi, tables as T
from terralattice.streaming import ingest

SMALL = "/root/testdata/sf0.001"
GOOD = "OR_ABI-L2-MCMIPF-M6_G18_s20240030200212_e20240030209521_c20240030210015.nc"


def gridded_rows(spark, times, value=1.0):
    df = spark.createDataFrame([(t, i) for t in times for i in range(4)], "time string, target_id long")
    return sinks.stored_rows(df.select(
        F.lit("GOES-East").alias("orbital_slot"), F.col("time").cast("timestamp").alias("time"), F.lit("G16").alias("platform_id"),
        F.lit(None).cast("string").alias("scan_mode"), "target_id", F.lit(0).alias("ilat"), F.col("target_id").alias("ilon"),
        F.lit(value).alias("cmi_c02"), F.lit(0).alias("dqf_c02")), [2])


def test_store_appends_each_frame_once(spark, tmp_path):
    path, schema = str(tmp_path / "region"), schemas.gridded([2])
    sinks.create_store(spark, path, [2])
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.create_store(spark, path, [2])
    rows = gridded_rows(spark, ["2024-01-01 00:00:00", "2024-01-02 00:00:00"])
    for _ in range(3):
        sinks.append_frames(rows, path, schema)
    stored = spark.read.parquet(path)
    assert stored.count() == 8 and stored.where("scan_mode <> 'unknown'").isEmpty()
    sinks.append_frames(gridded_rows(spark, ["2024-01-02 00:10:00"]), path, schema)
    assert spark.read.parquet(path).count() == 12
    day = T.open_region(spark, path, ["target_id"], "2024-01-02 00:00:00", "2024-01-02 00:05:00")
    assert day.count() == 4 and "PartitionFilters: [isnotnull(obs_date" in plan_of(day)
    sinks.overwrite_dates(gridded_rows(spark, ["2024-01-02 05:00:00"], 9.0), path)
    after = spark.read.parquet(path)
    assert after.count() == 8 and after.where("cmi_c02 = 9").count() == 4
    sinks.create_store(spark, path, [2], overwrite=True)
    assert spark.read.schema(schema).parquet(path).isEmpty()


def test_append_new_is_idempotent_and_settles(spark, tmp_path):
    path = str(tmp_path / "obs")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    sinks.append_new(new, path, ["id"])
    sinks.append_new(new.select("v", "id"), path, ["id"])
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]
    with pytest.raises(ValueError, match="Column mismatch"):
        sinks.append_new(new.withColumn("extra", F.lit(1)), path, ["id"])


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_catalog_round_trip_skips_missing(spark, tmp_path, fmt):
    tables = {"data_quality": spark.createDataFrame([("x", 1.5, None)], schemas.DATA_QUALITY),
              "validation_errors": spark.createDataFrame([], schemas.VALIDATION_ERRORS)}
    sinks.write_catalog(tables, str(tmp_path), fmt)
    back = T.load_catalog(spark, str(tmp_path), fmt)
    assert [tuple(r) for r in back["data_quality"].collect()] == [("x", 1.5, None)]
    assert back["observations"].isEmpty() and back["observations"].schema == schemas.OBSERVATIONS
    assert not T.exists(spark, str(tmp_path / "validation_errors"))


def test_directory_scan_reads_no_content(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / GOOD).write_text("x")
    (tmp_path / "deep" / ("A" + GOOD)).write_text("x")
    (tmp_path / "note.txt").write_text("x")
    found = Fi.scan_directory(spark, str(tmp_path))
    assert found.count() == 2 and Fi.scan_directory(spark, str(tmp_path), recursive=False).count() == 1
    assert Fi.product_files(found).count() == 1
    assert "content" not in plan_of(found).split("ReadSchema")[1]


def test_explicit_files(spark):
    assert Fi.explicit_files(spark, ["/in/" + GOOD]).count() == 1
    for bad in ([], ["/in/" + GOOD, "/in/other.nc"]):
        with pytest.raises(ValueError):
            Fi.explicit_files(spark, bad)


def test_names_match_from_the_start_only(spark):
    names = spark.createDataFrame([(GOOD,), (GOOD + ".bak",), ("x" + GOOD,)], "file_name string")
    assert Fi.product_files(names).count() == 2


def test_parse_names(spark):
    row = Fi.parse_names(spark.createDataFrame([(GOOD,)], "file_name string")).first()
    assert (row["scene"], row["mode"], row["satellite"]) == ("F", 6, 18)
    assert row["start_time"].isoformat() == "2024-01-03T02:00:21.200000"


def test_remote_inventory(spark):
    urls = spark.createDataFrame([("https://h/c/G16/P/2021/131/05/catalog.html",), ("https://h/x",)], "url string")
    got = [tuple(r)[:4] for r in Fi.remote_inventory(urls).collect()]
    assert got == [("G16", "2021", "131", "05"), (None, None, None, None)]


def test_open_files_mixes_bands(spark, tmp_path):
    spark.range(2).selectExpr("id", "1.0 as cmi_c01").write.parquet(str(tmp_path / "a"))
    spark.range(2).selectExpr("id", "2.0 as cmi_c02").write.parquet(str(tmp_path / "b"))
    df = T.open_files(spark, [str(tmp_path / "a"), str(tmp_path / "b")], lambda d: d.withColumn("seen", F.lit(True)))
    assert df.count() == 4 and B.available_bands(df) == [1, 2] and df.where("cmi_c01 is null").count() == 2


def test_attribute_rules(spark):
    rows = [("GOES-East", "G16", "CONUS"), (None, None, None), ("", "", ""), ("X", "Y", "Z"), ("GOES-East", "Y", "Z"), ("GOES-East", "G16", "Z")]
    df = spark.createDataFrame(rows, "s string, p string, c string")
    got = [r[0] for r in df.select(validate.attribute_error(F.col("s"), F.col("p"), F.col("c"))).collect()]
    assert got == [None, None, None, "Invalid orbital_slot: X", "Invalid platform_id: Y", "Invalid scene_id: Z"]
    strict = [r[0] for r in df.select(validate.strict_slot_ok(F.col("s"))).collect()]
    assert strict == [True, False, False, False, True, True]


def test_consistency_single_file_passes(spark):
    df = spark.createDataFrame([("one", 1, "A", "2km", "E", 5)], "k string, id long, scene_id string, spatial_resolution string, orbital_slot string, time long")
    row = validate.consistency(df, ["k"], ["id"]).first()
    assert row["consistent"] and row["issues"] == ""


def test_require_none(spark):
    bad = spark.createDataFrame([("f", "broken")], "file string, error string")
    validate.require_none(bad.where("false"), "strict")
    with pytest.raises(ValueError, match="broken"):
        validate.require_none(bad, "strict")


def test_filters_reach_the_scan(spark):
    obs = X.table(spark, SMALL, "events").select("event_id", F.col("ts").alias("time_coverage_start"))
    plan = plan_of(catalog.files_for_period(obs, "2024-01-05", "2024-01-06"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


def test_band_selection_prunes_columns(spark, tmp_path):
    X.pixels16(spark, SMALL).write.parquet(str(tmp_path / "px"))
    px = spark.read.parquet(str(tmp_path / "px"))
    schema = plan_of(B.select_band(px, 7, ["vec_id"])).split("ReadSchema: ")[1]
    assert "cmi_c07" in schema and "cmi_c08" not in schema
    rgb = plan_of(recipes.composite(px, "ash", ["vec_id"])).split("ReadSchema: ")[1]
    assert all((f"cmi_c{b:02d}" in rgb) == (b in recipes.bands_for("ash")) for b in C.ALL_BANDS)
    for band in (0, 17):
        with pytest.raises(ValueError):
            B.check_band(px, band)
    with pytest.raises(KeyError):
        B.check_band(px.drop("cmi_c03"), 3)


def test_recipes_are_complete():
    assert len(recipes.composite_names()) == 20 and len(recipes.difference_names()) == 6
    assert recipes.bands_for("ash") == [11, 13, 14, 15] and recipes.bands_for("night_fog") == [7, 13]
    for ask in (recipes.bands_for, lambda n: recipes._difference_row(n)):
        with pytest.raises(ValueError, match="known"):
            ask("nothing")
    assert "night_fog" in recipes.recipes_for_time("night") and "split_snow" not in recipes.recipes_for_time("night")


def test_scaling_keeps_nan(spark):
    nan = F.lit(float("nan"))
    row = spark.range(1).select(S.rescale(nan, 0.0, 1.0), S.apply_gamma(nan, 2.0), S.clip(nan, 0.0, 1.0),
                                S.rescale(F.lit(7.0), 0.0, 10.0), S.apply_gamma(F.lit(0.25), 2.0)).first()
    assert all(math.isnan(v) for v in row[:3]) and row[3] == 0.7 and row[4] == 0.5


def test_dimensions(spark):
    assert dims.bands(spark).count() == 16 and dims.dqf_flags(spark).count() == 7
    assert dims.band_products(spark).count() == sum(len(v) for v in C.BAND_PRODUCTS.values()) == 173
    assert B.all_products(spark).count() == len({p for v in C.BAND_PRODUCTS.values() for p in v})
    assert [r[0] for r in B.products_for_band(spark, 4).collect()] == list(C.BAND_PRODUCTS[4])
    assert B.array_attributes(spark).where("node_path = 'DQF_C16' and key = 'flag_values'").first()["value"] == "0 1 2 3 4 5 6"


def test_attributes_replace(spark):
    current = spark.createDataFrame([("/", {"a": "1", "b": "2"})], "node_path string, attrs map<string,string>")
    changes = spark.createDataFrame([("/", {"b": "9"}), ("/x", {"c": "3"})], "node_path string, attrs map<string,string>")
    read = lambda df: {r["node_path"]: r["attrs"] for r in df.collect()}
    assert read(store.set_attributes(current, changes)) == {"/": {"a": "1", "b": "9"}, "/x": {"c": "3"}}
    assert read(store.set_attributes(current, changes, merge=False)) == {"/": {"b": "9"}, "/x": {"c": "3"}}
    assert read(store.delete_attributes(current, ["a"])) == {"/": {"b": "2"}}


def test_size_estimate_without_bands(spark):
    assert store.estimate_size(spark.range(3), 100, 0).first()["per_band_gb"] == 0.0


def test_stream_grids_once_and_logs_failures(spark, tmp_path):
    from terralattice.operators import regrid as R
    w = W.prepare(X.station_weights(spark, SMALL).where("target_id < 200")).cache()
    src, out, log, ck = (str(tmp_path / n) for n in ("in", "out", "log", "ck"))
    px = X.raster(spark, SMALL).where("vec_id < 20").select("vec_id", "source_id", "band", "cmi")
    px.where("vec_id < 10").write.parquet(src)
    broken = {3, 4}
    def error(df):  # one bad pixel fails the frame
        bad = F.col("vec_id").isin(list(broken)) & (F.col("source_id") == 5)
        return df.withColumn("error_message", F.when(bad, "bad pixel"))
    def run():
        ingest.grid_frames(ingest.file_stream(spark, src, px.schema), lambda df: R.regrid(df, w, ["vec_id"], ["cmi"]),
                           error, out, log, ck, ["vec_id"])
    run()
    first = spark.read.parquet(out).count()
    run()  # nothing new
    assert spark.read.parquet(out).count() == first
    broken.discard(4)  # repaired; frames 2, 3 and 4 arrive again with new ones
    px.where("vec_id >= 10 or vec_id in (2, 3, 4)").write.mode("append").parquet(src)
    run()
    stored = spark.read.parquet(out)
    batch = R.regrid(px.where("vec_id <> 3"), w, ["vec_id"], ["cmi"])
    assert first < stored.count() == batch.count()
    assert stored.select("vec_id", "target_id").distinct().count() == stored.count()
    states = {(r["vec_id"], r["attempt"]): r["status"] for r in spark.read.parquet(log).collect()}
    assert states[3, 1] == states[3, 2] == states[4, 1] == "failed" and states[4, 2] == "done"
    assert states[2, 1] == "done" and (2, 2) not in states and len(states) == 22


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    from terralattice.operators import regrid as R
    w = W.prepare(X.station_weights(spark, SMALL).where("target_id < 50")).cache()
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    px = X.raster(spark, SMALL).where("vec_id < 3").select("vec_id", "source_id", "cmi")
    px.write.parquet(src)
    for lost in ("ck1", "ck2"):  # the second run has lost its checkpoint and starts from batch 0 again
        ingest.grid_frames(ingest.file_stream(spark, src, px.schema), lambda df: R.regrid(df, w, ["vec_id"], ["cmi"]),
                           lambda df: df.withColumn("error_message", F.lit(None).cast("string")), out, log,
                           str(tmp_path / lost), ["vec_id"])
    assert spark.read.parquet(out).count() == R.regrid(px, w, ["vec_id"], ["cmi"]).count()


def test_stream_deduplication(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(6).selectExpr("id % 3 as file", "timestamp_seconds(id) as time").coalesce(1).write.parquet(src)
    stream = ingest.deduplicated(ingest.file_stream(spark, src, spark.read.parquet(src).schema), ["file"], "time", "1 hour")
    ingest.run_available(stream, str(tmp_path / "ck"), lambda df, i: df.write.mode("append").parquet(out))
    assert spark.read.parquet(out).count() == 3


def frame_pixels(spark, frames, pixels=range(4), bands=(2,)):
    df = spark.createDataFrame([(t, i) for t in frames for i in pixels], "time string, source_id long")
    return df.select(F.lit("GOES-East").alias("orbital_slot"), F.col("time").cast("date").alias("obs_date"), F.col("time").cast("timestamp").alias("time"),
                     "source_id", *[F.lit(float(b)).alias(f"cmi_c{b:02d}") for b in bands])


def test_parts_of_a_frame_are_kept(spark, tmp_path):
    path, schema = str(tmp_path / "region"), schemas.gridded([2])
    sinks.create_store(spark, path, [2])
    rows = gridded_rows(spark, ["2024-01-01 00:00:00"])
    sinks.append_frames(rows.where("target_id < 3"), path, schema)
    frames = rows.select("orbital_slot", "obs_date", "time").distinct()
    assert sinks.missing_frames(frames, path, schema, 4).count() == 1
    sinks.append_frames(rows, path, schema, frames)
    assert spark.read.parquet(path).count() == 4 and sinks.missing_frames(frames, path, schema, 4).isEmpty()
    nowhere = rows.withColumn("orbital_slot", F.lit(None).cast("string"))
    for _ in range(2):
        sinks.append_frames(nowhere, path, schema)
    assert T.open_region(spark, path).count() == 8
    with pytest.raises(ValueError, match="Band set differs"):
        sinks.append_frames(rows.withColumnRenamed("cmi_c02", "cmi_c03"), path, schema)


def test_the_index_tells_what_is_stored(spark, tmp_path):
    """Only partly stored frames are read; an append that stopped half-way is settled and done again."""
    path, schema = str(tmp_path / "region"), schemas.gridded([2])
    sinks.create_store(spark, path, [2])
    days = ["2024-01-01 00:00:00", "2024-01-01 05:00:00", "2024-01-02 00:10:00"]
    sinks.append_frames(gridded_rows(spark, days[:1]), path, schema)
    index = lambda: {str(r["time"]): r["rows"] for r in sinks.frame_index(spark, path).collect()}
    assert index() == {days[0]: 4}
    kept, sinks._count_stored = sinks._count_stored, None
    with pytest.raises(TypeError):  # data are written, the index is not
        sinks.append_frames(gridded_rows(spark, days[:2]), path, schema)
    sinks._count_stored = kept
    assert index() == {days[0]: 4} and spark.read.parquet(path).count() == 8
    for _ in range(2):
        sinks.append_frames(gridded_rows(spark, days), path, schema)
        assert index() == dict.fromkeys(days, 4) and spark.read.parquet(path).count() == 12
    assert not session.child_names(spark, f"{path}/_region/begun")
    sinks.overwrite_dates(gridded_rows(spark, ["2024-01-01 00:00:00", "2024-01-01 07:00:00"]), path)
    assert index() == dict.fromkeys(["2024-01-01 00:00:00", "2024-01-01 07:00:00", days[2]], 4)
    other = str(tmp_path / "other")  # written without an index
    gridded_rows(spark, days).write.partitionBy("orbital_slot", "obs_date").parquet(other)
    frames = gridded_rows(spark, [*days, "2024-01-03 00:00:00"]).select("orbital_slot", "obs_date", "time").distinct()
    assert [str(r["time"]) for r in sinks.missing_frames(frames, other, schema, 4).collect()] == ["2024-01-03 00:00:00"]


def test_stored_rows_are_read_by_their_time(spark, tmp_path):
    path, schema = str(tmp_path / "region"), schemas.gridded([2])
    sinks.create_store(spark, path, [2])
    rows = gridded_rows(spark, ["2024-01-01 00:00:00", "2024-01-01 05:00:00"])
    sinks.append_frames(rows, path, schema)
    asked = rows.where("time > timestamp '2024-01-01 01:00:00'").select("orbital_slot", "obs_date", "time").distinct()
    plan = plan_of(sinks._stored(spark, asked, path, schema, ["target_id"]))
    scan = plan[plan.index("region"):]
    assert "GreaterThanOrEqual(time,2024-01-01 05:00:00" in plan.replace("T05:00:00Z", " 05:00:00") and "cmi_c02" not in scan.split("ReadSchema")[1].splitlines()[0]


def test_observations_are_checked_before_gridding(spark, tmp_path):
    path, schema = str(tmp_path / "region"), schemas.gridded([2])
    sinks.create_store(spark, path, [2])
    gridded = []

    def transform(px):
        gridded.append(px.select("time").distinct().count())
        return sinks.stored_rows(px.select("orbital_slot", "time", F.col("source_id").alias("target_id"), F.lit("G16").alias("platform_id"),
                                           F.lit(None).cast("string").alias("scan_mode"), F.lit(0).alias("ilat"), F.col("source_id").alias("ilon"),
                                           "cmi_c02", F.lit(0).alias("dqf_c02")), [2])
    good, short = frame_pixels(spark, ["2024-01-01 00:00:00", "2024-01-01 00:10:00"]), frame_pixels(spark, ["2024-01-01 00:20:00"], range(3))
    refused = sinks.append_observations(good.unionByName(short), path, schema, transform, [2], 4, 4).collect()
    assert [(str(r["time"])[11:16], r["error_message"]) for r in refused] == [("00:20", "Unexpected frame shape")]
    sinks.append_observations(good, path, schema, transform, [2], 4, 4)
    assert gridded == [2, 0] and T.open_region(spark, path).count() == 8
    wide = frame_pixels(spark, ["2024-01-01 00:30:00"], bands=(2, 3))
    assert sinks.append_observations(wide, path, schema, transform, [2], 4, 4).first()["error_message"] == "Band set differs: 2,3"


def test_an_empty_region_opens_with_what_was_declared(spark, tmp_path):
    grid = spark.createDataFrame([(i, 0, i, 10.0, lon) for i, lon in enumerate([170.0, 175.0, -180.0, -175.0])],
                                 "target_id long, ilat int, ilon int, lat double, lon double")
    path = str(tmp_path / "region")
    sinks.create_store(spark, path, [2, 13], name="Pacific", grid=grid, attributes={"title": "test"})
    region = T.open_region(spark, path)
    assert region.isEmpty() and B.available_bands(region) == [2, 13] and T.region_grid(spark, path).count() == 4
    assert {r["key"]: r["value"] for r in T.region_attributes(spark, path).where("key <> 'schema'").collect()} == {
        "region": "Pacific", "bands": "2,13", "title": "test"}
    with pytest.raises(ValueError, match="lon axis"):
        sinks.create_store(spark, str(tmp_path / "bent"), [2], grid=grid.withColumn("lon", F.when(F.col("ilon") == 1, 0.0).otherwise(F.col("lon"))))
    for bands in ([], [0], [2, 2]):
        with pytest.raises(ValueError, match="Bands"):
            sinks.create_store(spark, str(tmp_path / "none"), bands)


@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_frames_that_arrive_in_parts_are_gridded_whole(spark, tmp_path, max_files):
    from terralattice.operators import regrid as R
    w = X.station_weights(spark, SMALL).where("target_id < 50").drop("grid").cache()
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    px = X.raster(spark, SMALL).where("vec_id < 6").select("vec_id", "source_id", "cmi")
    for part in (px.where("source_id % 3 = 0"), px.where("source_id % 3 = 1 and vec_id <> 4"), px.where("source_id % 3 = 2")):
        part.coalesce(1).write.mode("append").parquet(src)
    def run(checkpoint, source=src):
        ingest.grid_frames(ingest.file_stream(spark, source, px.schema, max_files), lambda df: R.regrid(df, w, ["vec_id"], ["cmi"]),
                           lambda df: df.withColumn("error_message", F.lit(None).cast("string")), out, log, str(tmp_path / checkpoint), ["vec_id"], 64)
    whole = R.regrid(px.where("vec_id <> 4"), w, ["vec_id"], ["cmi"])
    for checkpoint in ("ck1", "ck1", "ck2"):  # goes on, then has lost its checkpoint
        run(checkpoint)
        assert spark.read.parquet(out).count() == whole.count()
    px.where("source_id % 3 = 1 and vec_id = 4").write.mode("append").parquet(src)  # the late part
    run("ck2")
    stored = spark.read.parquet(out)
    assert stored.count() == stored.select("vec_id", "target_id").distinct().count() == R.regrid(px, w, ["vec_id"], ["cmi"]).count()
    assert spark.read.parquet(log).where("status = 'done'").count() == 6


def test_strict_streams_stop_at_a_failed_frame(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(3).selectExpr("id as vec_id", "0L as source_id").write.parquet(src)
    with pytest.raises(Exception, match="a frame failed"):
        ingest.grid_frames(ingest.file_stream(spark, src, spark.read.parquet(src).schema), lambda df: df,
                           lambda df: df.withColumn("error_message", F.when(F.col("vec_id") == 1, "bad")),
                           str(tmp_path / "out"), str(tmp_path / "log"), str(tmp_path / "ck"), ["vec_id"], strict=True)


def test_a_cluster_needs_a_shared_folder(spark):
    from types import SimpleNamespace
    lone = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(lone)


def wide_region(spark, path, n=64):
    """A region of n x n cells around the antimeridian, a quarter degree apart, with two times."""
    cell = spark.range(n * n)
    i, j = F.floor(F.col("id") / n).cast("int"), (F.col("id") % n).cast("int")
    lon = 172.0 + j * 0.25
    grid = cell.select(F.col("id").alias("target_id"), i.alias("ilat"), j.alias("ilon"), (10.0 - i * 0.25).alias("lat"), F.when(lon >= 180.0, lon - 360.0).otherwise(lon).alias("lon"))
    sinks.create_store(spark, path, [2], grid=grid)
    times = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:10:00",)], "t string").select(F.col("t").cast("timestamp").alias("time"))
    rows = grid.withColumn("time", F.explode(F.array(*[F.lit(r["time"]) for r in times.collect()]))).select(
        F.lit("GOES-West").alias("orbital_slot"), "time", F.lit("G18").alias("platform_id"), F.lit(None).cast("string").alias("scan_mode"), "target_id", "ilat", "ilon",
        F.col("target_id").cast("float").alias("cmi_c02"), F.lit(0).alias("dqf_c02"))
    return grid, sinks.stored_rows(rows, [2])


@pytest.mark.parametrize("box", [(-2.0, 3.0, 173.0, 176.1), (0.0, 1.0, 179.0, -178.9), (-90.0, 90.0, -180.0, 180.0), (50.0, 60.0, 0.0, 1.0), (9.0, 10.0, -175.0, -170.0)])
def test_a_window_in_space(spark, tmp_path, box):
    path = str(tmp_path / "region")
    grid, rows = wide_region(spark, path)
    sinks.append_frames(rows, path, schemas.gridded([2]))
    south, north, west, east = box
    inside = lambda r: south <= r["lat"] <= north and (west <= r["lon"] <= east if west <= east else r["lon"] >= west or r["lon"] <= east)
    want = sorted(r["target_id"] for r in grid.collect() if inside(r))
    got = sorted(r["target_id"] for r in T.open_region(spark, path, ["target_id"], "2024-01-01 00:05:00", box=box).collect())
    assert got == want


def test_row_groups_outside_a_window_are_skipped(spark, tmp_path):
    """The scan hands on about the window's rows, not the file's."""
    path = str(tmp_path / "region")
    rows = wide_region(spark, path)[1]
    sinks._gathered(rows).write.mode("append").option("parquet.block.size", 1024).option("parquet.page.size", 1024).option(
        "parquet.block.size.row.count", 128).option("parquet.block.row.count.limit", 128).option("parquet.page.row.count.limit", 64).partitionBy("orbital_slot", "obs_date").parquet(path)
    df = T.open_region(spark, path, ["target_id", "cmi_c02"], box=(8.1, 10.0, 172.0, 173.9))
    n = df.count()
    df = T.open_region(spark, path, ["target_id", "cmi_c02"], box=(8.1, 10.0, 172.0, 173.9))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert n == 2 * 8 * 8 and "LessThanOrEqual(ilat,7)" in text.split("PushedFilters")[1]
    scans = [p for p in _nodes(plan) if "FileScan" in p.toString().splitlines()[0] or "Scan parquet" in p.nodeName()]
    read = scans[-1].metrics().apply("numOutputRows").value()
    assert n <= read <= 8 * n < 2 * 64 * 64


def _nodes(plan):
    """Operators of an executed plan, those within an adaptive one too."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _nodes(plan.executedPlan())
    children = plan.children()
    return [plan] + [n for i in range(children.size()) for n in _nodes(children.apply(i))]


def test_the_curve_keeps_squares_together(spark):
    cells = spark.range(64 * 64).select(F.floor(F.col("id") / 64).alias("i"), (F.col("id") % 64).alias("j"))
    got = {(r["i"], r["j"]): r["p"] for r in cells.withColumn("p", sinks.place_order(F.col("i"), F.col("j"))).collect()}
    want = lambda i, j: sum(((i >> b & 1) << 2 * b + 1) | ((j >> b & 1) << 2 * b) for b in range(16))
    assert all(got[i, j] == want(i, j) for i, j in got)


def test_kept_summaries_fold_to_the_whole(spark, tmp_path):
    scanned, path = X.scanned_obs(spark, SMALL).cache(), str(tmp_path / "kept")
    assert summaries.totals(summaries.folded(spark, path)).first()["total_scanned"] == 0
    for b in range(4):
        summaries.add_batch(scanned.where(F.col("observation_id") % 4 == b), path, str(b))
    summaries.add_batch(scanned.where("observation_id % 4 = 2"), path, "2")  # replayed
    def check():
        kept = summaries.folded(spark, path)
        got, want = summaries.totals(kept).first(), catalog.totals(scanned).first()
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5])
        assert sorted(summaries.breakdown(kept).collect()) == sorted(catalog.breakdown(scanned).collect())
    check()
    scanned.limit(1).write.parquet(str(tmp_path / "kept" / "half"))  # no batch
    session.remove(spark, f"{path}/batch=3/_SUCCESS")  # not through
    assert summaries.totals(summaries.folded(spark, path)).first()["total_scanned"] == scanned.where("observation_id % 4 <> 3").count()
    summaries.add_batch(scanned.where("observation_id % 4 = 3"), path, "3")
    summaries.compact(spark, path, ["0", "1", "3"])
    assert sorted(n for n in session.child_names(spark, path) if n.startswith("batch=")) == ["batch=2", "batch=3"]
    check()


def test_messages_name_some_of_many_values(spark):
    rows = [("r", i, f"scene{i:03d}", "2km", "GOES-East") for i in range(50)] + [("one", i, "Full Disk", "2km", None) for i in range(3)] + [(None, 1, "a", None, None), (None, 2, "b", None, None)]
    df = spark.createDataFrame(rows, "region string, time long, scene_id string, spatial_resolution string, orbital_slot string")
    got = {r["region"]: r for r in validate.consistency(df, ["region"], ["time"]).collect()}
    assert got["r"]["issues"] == "Inconsistent scene_id: " + ", ".join(f"scene{i:03d}" for i in range(20)) + ", ..."
    assert got["one"]["consistent"] and got[None]["issues"] == "Inconsistent scene_id: a, b"


def test_explicit_lists(spark):
    files = spark.createDataFrame([(f"/a/{GOOD}",)], "file_path string")
    assert Fi.explicit_files(spark, files).first()["file_name"] == GOOD
    with pytest.raises(ValueError, match="empty"):
        Fi.explicit_files(spark, files.limit(0))
    with pytest.raises(ValueError, match="notes.txt"):
        Fi.explicit_files(spark, files.union(spark.createDataFrame([("/a/notes.txt",)], "file_path string")))
    with pytest.raises(ValueError, match="missing name"):
        Fi.explicit_files(spark, files.union(spark.createDataFrame([(None,)], "file_path string")))


def test_bucketed_tables_join_without_a_shuffle(spark):
    from terralattice.plans import imagery_queries
    plan = plan_of(imagery_queries.bucketed_join(spark, SMALL))
    assert "SortMergeJoin" in plan and "hashpartitioning(source_id" not in plan and "Bucketed: true" in plan


def test_small_frames_of_a_date_share_a_file(spark, tmp_path):
    path, schema, own = str(tmp_path / "region"), schemas.gridded([2]), spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    sinks.create_store(spark, path, [2])
    rows = gridded_rows(own, [f"2024-01-01 {hour:02d}:00:00" for hour in range(12)])
    sinks.append_frames(rows, path, schema)
    assert len(list((tmp_path / "region").glob("orbital_slot=*/obs_date=*/*.parquet"))) == 1
    assert T.open_region(spark, path).count() == 48
    held = lambda most: sinks._gathered(rows, rows, most).select(F.spark_partition_id()).distinct().count()
    assert held(48) == 1 and held(47) > 1


def test_append_fills_frames_stored_in_part_beside_new_ones(spark, tmp_path):
    path, schema = str(tmp_path / "region"), schemas.gridded([2])
    sinks.create_store(spark, path, [2])
    rows = gridded_rows(spark, ["2024-01-01 00:00:00", "2024-01-01 05:00:00"])
    sinks.append_frames(gridded_rows(spark, ["2024-01-01 00:00:00"], 2.0).where("target_id < 2"), path, schema)
    sinks.append_frames(rows, path, schema)
    got = sorted((r["time"].hour, r["target_id"], r["cmi_c02"]) for r in T.open_region(spark, path).collect())
    assert got == [(h, t, 2.0 if h == 0 and t < 2 else 1.0) for h in (0, 5) for t in range(4)]


def test_batches_for_python_are_small_in_gridding(spark):
    assert int(session.gridding_session(spark).conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
