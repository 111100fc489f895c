"""The regridding kernel against a NumPy gather-and-sum, and its properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_queries import plan_of
from terralattice import session
from terralattice.operators import regrid as R, weights as W
from terralattice.plans import fixtures as X

NX = 8
RNG = np.random.default_rng(7)


@pytest.fixture(scope="module")
def points():
    at = RNG.uniform(-0.5, 7.5, size=(120, 2))
    at[:20] = np.floor(np.clip(at[:20], 0, 7))  # direct hits, edges and corners
    return at


@pytest.fixture(scope="module")
def targets(spark, points):
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "target_id long, tx double, ty double").cache()


@pytest.fixture(scope="module")
def weights(targets):
    return W.prepare(W.lattice_weights(targets, "tx", "ty", NX, NX)).cache()


@pytest.fixture(scope="module")
def frames():
    cmi = RNG.normal(280, 10, size=(5, 64))
    dqf = RNG.choice([0, 0, 0, 1, 2], size=(5, 64)).astype(float)
    cmi[1, 10] = cmi[2, 27] = np.nan
    dqf[1, 10] = dqf[3, 44] = np.nan
    return cmi, dqf


@pytest.fixture(scope="module")
def pixels(spark, frames):
    cmi, dqf = frames
    rows = [(t, s, float(cmi[t, s]), float(dqf[t, s])) for t in range(5) for s in range(64)]
    return spark.createDataFrame(rows, "t int, source_id long, cmi double, dqf double").cache()


def expected(weights, frames, strict=False):
    cmi, dqf = frames
    table = {}
    for r in weights.orderBy("target_id", "rank").collect():
        table.setdefault(r["target_id"], []).append((r["source_id"], r["w"]))
    out = {}
    for target, pairs in table.items():
        v, w = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        for t in range(5):
            q = dqf[t, v]
            s = (w * q).sum()
            if w.max() >= 0.999:
                top = q[w.argmax()]
                flag = 6 if np.isnan(top) else int(top)
            elif np.isnan(s):
                flag = 6
            elif (q.min() == q.max()) if strict else abs(s - np.rint(s)) < 1e-6:
                flag = int(np.rint(s))
            else:
                flag = 5
            out[t, target] = ((w * cmi[t, v]).sum(), flag)
    return out


@pytest.mark.parametrize("strict", [False, True])
def test_regrid_equals_numpy(pixels, weights, frames, strict):
    want = expected(weights, frames, strict)
    got = {(r["t"], r["target_id"]): (r["cmi"], r["dqf"])
           for r in R.regrid(pixels, weights, ["t"], ["cmi"], ["dqf"], strict=strict).collect()}
    assert got.keys() == want.keys()
    for key, (value, flag) in want.items():
        assert got[key][1] == flag, key
        np.testing.assert_allclose(got[key][0], value, rtol=1e-12, equal_nan=True)


def test_flags_zero_and_two_blend_to_one(spark):
    w = W.prepare(spark.createDataFrame([(0, 0, 0, 0.5), (0, 1, 1, 0.5), (0, 2, 2, 0.0)],
                                        "target_id long, rank int, source_id long, w double"))
    px = spark.createDataFrame([(0, 0.0), (1, 2.0), (2, 0.0)], "source_id long, q double").withColumn("t", F.lit(1))
    assert R.regrid(px, w, ["t"], [], ["q"]).first()["q"] == 1
    assert R.regrid(px, w, ["t"], [], ["q"], strict=True).first()["q"] == 5


def test_nan_at_weight_zero_makes_nan(spark):
    w = W.prepare(spark.createDataFrame([(0, 0, 0, 0.5), (0, 1, 1, 0.5), (0, 2, 2, 0.0)],
                                        "target_id long, rank int, source_id long, w double"))
    px = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, float("nan"))], "source_id long, c double").withColumn("t", F.lit(1))
    assert np.isnan(R.regrid(px, w, ["t"], ["c"]).first()["c"])
    nulls = px.withColumn("c", F.when(~F.isnan("c"), F.col("c")))
    assert np.isnan(R.regrid(nulls, w, ["t"], ["c"]).first()["c"])


def test_dominant_vertex_is_first_on_ties(spark):
    w = W.prepare(spark.createDataFrame([(0, 0, 9, 0.2), (0, 1, 8, 0.4), (0, 2, 7, 0.4)],
                                        "target_id long, rank int, source_id long, w double"))
    assert [r["source_id"] for r in w.where("dominant").collect()] == [8]


def test_weights_sum_to_one_and_affine_is_exact(targets, weights):
    sums = weights.groupBy("target_id").agg(
        F.sum("w").alias("s"), F.sum(F.col("w") * (F.col("source_id") % NX)).alias("x"),
        F.sum(F.col("w") * F.floor(F.col("source_id") / NX)).alias("y"), F.min("w").alias("lo"))
    joined = sums.join(targets, "target_id").collect()
    assert joined
    for r in joined:
        assert abs(r["s"] - 1) < 1e-12 and r["lo"] >= 0
        assert abs(r["x"] - r["tx"]) < 1e-12 and abs(r["y"] - r["ty"]) < 1e-12


def test_every_target_comes_once(pixels, targets, weights):
    times = pixels.select("t").distinct()
    covered = R.regrid(pixels, weights, ["t"], ["cmi"], ["dqf"])
    full = R.regrid(pixels, weights, ["t"], ["cmi"], ["dqf"], every=(times, targets))
    assert full.count() == full.select("t", "target_id").distinct().count() == 5 * 120
    assert covered.exceptAll(full).isEmpty()
    rest = full.join(weights.select("target_id").distinct(), "target_id", "left_anti")
    assert not rest.isEmpty() and rest.where("not isnan(cmi) or dqf <> 3").isEmpty()


def test_grids_in_one_table_are_kept_apart(pixels, targets, weights):
    both = weights.withColumn("grid_id", F.lit("a")).unionByName(weights.where("target_id % 2 = 0").withColumn("grid_id", F.lit("b")))
    plain = {(r["t"], r["target_id"]): (str(r["cmi"]), r["dqf"]) for r in R.regrid(pixels, weights, ["t"], ["cmi"], ["dqf"]).collect()}
    got = {(r["grid_id"], r["t"], r["target_id"]): (str(r["cmi"]), r["dqf"]) for r in R.regrid(pixels, both, ["t"], ["cmi"], ["dqf"]).collect()}
    assert set(got) == {("a", *k) for k in plain} | {("b", *k) for k in plain if k[1] % 2 == 0}
    assert all(got[k][1] == plain[k[1:]][1] for k in got)
    own = pixels.withColumn("grid_id", F.when(F.col("t") < 3, "a").otherwise("b"))
    assert {(r["grid_id"], r["t"]) for r in R.regrid(own, both, ["t"], ["cmi"]).select("grid_id", "t").distinct().collect()} == {
        ("a" if r["t"] < 3 else "b", r["t"]) for r in pixels.select("t").distinct().collect()}
    tiled = R.regrid_tiled(own, R.tile_weights(both, NX, 4), ["t"], ["cmi"], ["dqf"], NX, 4, 2)
    assert tiled.count() == R.regrid(own, both, ["t"], ["cmi"], ["dqf"]).count()
    grids = targets.withColumn("grid_id", F.lit("a")).unionByName(targets.withColumn("grid_id", F.lit("b")))
    full = R.regrid(own, both, ["t"], ["cmi"], ["dqf"], every=(own.select("grid_id", "t").distinct(), grids))
    assert full.count() == 5 * 120


def test_missing_pixels_give_nan_not_a_partial_sum(pixels, targets, weights):
    lost = pixels.where(~((F.col("t") == 4) & (F.col("source_id") < 32)))
    times = pixels.select("t").distinct()
    full = R.regrid(lost, weights, ["t"], ["cmi"], ["dqf"], every=(times, targets))
    assert full.count() == 5 * 120
    touched = weights.where("source_id < 32").select("target_id").distinct()
    bad = full.where("t = 4").join(touched, "target_id")
    assert bad.where(~F.isnan("cmi")).isEmpty()
    assert set(r["dqf"] for r in bad.select("dqf").distinct().collect()) <= {0, 1, 2, 6}


@pytest.mark.parametrize("tile,salts", [(3, 1), (4, 3), (16, 2)])
def test_tiled_equals_plain(spark, pixels, weights, tile, salts):
    plain = R.regrid(pixels, weights, ["t"], ["cmi"], ["dqf"])
    tiled = R.regrid_tiled(pixels, R.tile_weights(weights, NX, tile), ["t"], ["cmi"], ["dqf"], NX, tile, salts)
    rounded = lambda df: df.select("t", "target_id", F.round("cmi", 9).alias("cmi"), "dqf")
    assert rounded(tiled).exceptAll(rounded(plain)).isEmpty() and tiled.count() == plain.count()


def test_tiled_shuffles_pixels_once(spark):
    own = session.gridding_session(spark)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    px = own.range(6400).selectExpr("id div 64 as t", "id % 64 as source_id", "cast(id as float) as cmi")
    tiled = own.createDataFrame([(0, 0, 0, 1.0, True, 1.0, 0)],
                                "target_id long, rank int, source_id long, w double, dominant boolean, max_w double, tile long")
    plan = plan_of(R.regrid_tiled(px, tiled, ["t"], ["cmi"], [], NX, 4, 2))
    assert plan.count("Exchange hashpartitioning") == 2  # one per join side, none for the aggregation


def test_tiles_refuse_far_vertices(spark):
    w = W.prepare(spark.createDataFrame([(0, 0, 0, 0.5), (0, 1, 63, 0.25), (0, 2, 5, 0.25)],
                                        "target_id long, rank int, source_id long, w double"))
    with pytest.raises(Exception, match="beyond its tile"):
        R.tile_weights(w, NX, 2).collect()


def test_stored_weights_are_bucketed(spark, weights):
    from terralattice.sinks import tables as sinks
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sinks.save_bucketed(weights, "tl_weights_test", buckets=8)
        stored = spark.table("tl_weights_test")
        px = spark.range(64).selectExpr("id as source_id", "1 as t", "1.0D as cmi")
        plan = plan_of(R.regrid(px, stored, ["t"], ["cmi"]))
        assert plan.count("Exchange") == 2  # pixels and the aggregation, not the weights
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS tl_weights_test")


def test_imported_weights_are_remapped(spark):
    valid = spark.createDataFrame([(3,), (10,), (11,), (40,)], "source_id long")
    w = spark.createDataFrame([(0, 0, 1, 0.5), (0, 1, 3, 0.25), (0, 2, 0, 0.25)], "target_id long, rank int, source_id long, w double")
    got = {r["rank"]: r["source_id"] for r in W.remap_compacted(w, valid).collect()}
    assert got == {0: 10, 1: 40, 2: 3}


def test_wanted_targets_are_aggregated_in_bounded_tasks(spark, pixels, weights, targets, monkeypatch):
    monkeypatch.setattr(R, "ROWS", 50)  # 5 frames of 120 targets
    wanted = (pixels.select("t").distinct(), targets)
    found = R.regrid(pixels, weights, ["t"], ["cmi"], every=wanted)
    assert "REPARTITION_BY_NUM" in plan_of(found) and ", 12), REPARTITION_BY_NUM" in plan_of(found)
    assert found.count() == 5 * 120


def test_vectors_of_one_file_unfold_in_several_tasks(spark, tmp_path):
    vectors = spark.range(2 * X.VECTORS + 1).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.5).cast("float"), 64).alias("embedding"), F.lit(1).alias("label"))
    vectors.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = X.raster(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 3 and found.count() == 64 * (2 * X.VECTORS + 1)


def test_pixels_in_parts_meet_the_weights_of_their_part(spark, pixels, weights):
    parted = pixels.withColumn("part", (F.col("t") % 2).cast("int"))
    both = weights.withColumn("part", F.explode(F.array(F.lit(0), F.lit(1))))
    got, want = ({(r["t"], r["target_id"]): r["cmi"] for r in R.regrid(p, w, ["t"], ["cmi"]).where(~F.isnan("cmi")).collect()}
                 for p, w in ((parted, both), (pixels, weights)))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
