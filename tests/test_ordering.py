"""Order-dependent operators on hot keys, nulls and ties, against plain Python."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_queries import plan_of
from terralattice.operators import ordering as O, runlog, statistics as St


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(3000):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        # a third of all rows share one second; some lie before 1970
        second = 1_700_000_000 if i % 3 == 1 else rng.choice([-90_000, -5, 86_399, 86_400, 1_700_000_500 + i])
        out.append((key, second, i, rng.random()))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    df = spark.createDataFrame(rows, "k string, s long, id long, v double")
    return df.withColumn("time", F.timestamp_seconds("s")).cache()


def by_key(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in groups.items()}


def test_positions(table, rows):
    got = {r["id"]: r["position"] for r in O.with_position(table, ["k"], ["time", "id"]).collect()}
    want = {r[2]: i for g in by_key(rows).values() for i, r in enumerate(g)}
    assert got == want


def test_positions_then_previous(table, rows):
    got = {r["id"]: (r["position"], r["previous"]) for r in O.with_previous(
        O.with_position(table, ["k"], ["time", "id"]), ["k"], ["time", "id"], "v").collect()}
    want = {}
    for group in by_key(rows).values():
        for i, (before, row) in enumerate(zip([None, *group], group)):
            want[row[2]] = (i, before and before[3])
    assert got == want


def test_one_key_with_hash_like_ids_is_spread_over_tasks(spark):
    """A 90 % key, and ids that are far apart: no run holds much more than its share."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("rest").alias("k"), F.xxhash64("id").alias("id"))
    sizes = [r["count"] for r in O._runs(df, ["k"], ["id"]).groupBy("_run").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    placed = O.with_position(df, ["k"], ["id"], "at", size="n")
    assert placed.groupBy("k").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.countDistinct("at").alias("d"), F.max("n").alias("n")).where(
        "lo <> 0 or hi <> n - 1 or d <> n").isEmpty()


def test_sums_before(table, rows):
    got = {r["id"]: (r["before"], r["all"]) for r in O.with_sum_before(table, ["k"], ["time", "id"], "s", total="all").collect()}
    want = {}
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            want[row[2]] = (sum(r[1] for r in group[:i]), sum(r[1] for r in group))
    assert got == want


def test_positions_without_key(table, rows):
    got = {r["id"]: r["position"] for r in O.with_position(table, [], ["time", "id"]).collect()}
    assert got == {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}


def test_missing_order_values_come_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", -5, 3)], "k string, s long, id long").withColumn(
        "time", F.timestamp_seconds("s"))
    got = {r["id"]: r["position"] for r in O.with_position(df, ["k"], ["time", "id"]).collect()}
    assert got == {1: 0, 3: 1, 2: 2}


def test_previous(table, rows):
    got = {r["id"]: r["previous"] for r in O.with_previous(table, ["k"], ["time", "id"], "v").collect()}
    want = {}
    for group in by_key(rows).values():
        for before, row in zip([None, *group], group):
            want[row[2]] = before and before[3]
    assert got == want


def test_previous_keeps_null_values(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0)], "id long, v double").withColumn("k", F.lit("x"))
    got = {r["id"]: r["previous"] for r in O.with_previous(df, ["k"], ["id"], "v").collect()}
    assert got == {1: None, 2: 10.0, 3: None}


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_groups_with_missing_keys_are_kept(spark, threshold):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, cmi double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        stats = {r["k"]: r for r in St.band_statistics(df, ["k"]).collect()}
        scaled = St.ir_normalize(df, ["k"], "cmi").count()
        places = O.with_position(df, ["k"], ["cmi"]).where("k is null").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert stats[None]["n"] == 2 and stats[None]["mean"] == 2.0 and stats["a"]["n"] == 1
    assert scaled == 3 and places == 2


def test_strictly_increasing(spark):
    df = spark.createDataFrame([("up", i, i) for i in range(50)] + [("tie", i, i // 2) for i in range(50)]
                               + [("one", 0, 5)], "k string, id long, t long")
    got = {r["k"]: r["increasing"] for r in O.strictly_increasing(df, ["k"], ["id"], "t").collect()}
    assert got == {"up": True, "tie": False, "one": True}


def test_plans_read_the_written_runs_twice_at_most(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [plan_of(O.even_sample(table, ["k"], ["time", "id"], 7)), plan_of(O.with_previous(table, ["k"], ["time", "id"], "v"))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert 1 <= plan.count("FileScan parquet") <= 2, plan


@pytest.mark.parametrize("n", [0, 1, 500, 2999, 5000])
def test_seeded_sample_takes_the_first_by_hash(table, rows, n):
    import hashlib
    ranked = sorted((r[2] for r in rows), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert sorted(r["id"] for r in O.seeded_sample(table, "id", n).collect()) == sorted(ranked[:n])


@pytest.mark.parametrize("n", [1, 7, 100, 5000])
def test_even_sample(table, rows, n):
    got = {r["id"] for r in O.even_sample(table, ["k"], ["time", "id"], n).collect()}
    want = set()
    for g in by_key(rows).values():
        m = min(n, len(g))
        want |= {g[int(i * len(g) / m)][2] for i in range(m)}
    assert got == want


def test_every_kth(table, rows):
    got = {r["id"] for r in O.every_kth(table, ["k"], ["time", "id"], 10).collect()}
    assert got == {r[2] for g in by_key(rows).values() for r in g[::max(1, len(g) // 10)]}


def test_seeded_sample_is_stable(table):
    pick = lambda seed: [r["id"] for r in O.seeded_sample(table.repartition(5), "id", 20, seed).select("id").collect()]
    assert sorted(pick(42)) == sorted(pick(42)) and sorted(pick(42)) != sorted(pick(43)) and len(set(pick(42))) == 20


def test_newest_prunes_before_the_shuffle(table):
    df = O.newest(table, ["k"], "id", 3)
    assert df.groupBy("k").count().where("count != 3").isEmpty()
    assert "WindowGroupLimit" in plan_of(df)


@pytest.mark.parametrize("fraction", [0.0, 0.3, 0.7, 1.0])
def test_percentile_is_exact(spark, fraction):
    rng = np.random.default_rng(5)
    data = {"normal": rng.normal(280, 5, 999), "constant": np.full(40, 3.25), "single": np.array([7.0]),
            "outlier": np.concatenate([rng.random(500) * 1e-6, [1e12]]), "ties": rng.integers(0, 4, 777).astype(float)}
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("ties", float("nan")), ("ties", float("inf")), ("normal", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in St.percentile_exact(df, ["k"], "v", fraction).collect()}
    for k, v in data.items():
        assert got[k]["n"] == len(v)
        np.testing.assert_allclose(got[k]["percentile"], np.percentile(v, fraction * 100), rtol=1e-12)


@pytest.mark.parametrize("bins", [2, 4096])
def test_ranks_are_found_by_counting(spark, monkeypatch, bins):
    """Any doubles, many equal ones, and hardly any bins."""
    monkeypatch.setattr(St, "BINS", bins)
    rng = random.Random(8)
    data = {"extremes": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1e-300, 3.0, 3.0], "near": [1e8 + rng.random() * 1e-6 for _ in range(50)],
            "scales": [10.0 ** rng.randint(-200, 200) for _ in range(40)], "one": [4.0] * 9, None: [float(i // 7) for i in range(60)]}
    values = spark.createDataFrame([(k, v) for k, part in data.items() for v in part], "k string, v double").repartition(5)
    for share in (0.0, 0.5, 1.0):
        ranks = {k: int(share * (len(part) - 1)) for k, part in data.items()}
        wanted = spark.createDataFrame([(k, ranks[k], min(part), max(part)) for k, part in data.items()], "k string, rank long, low double, high double")
        got = {r["k"]: r["found"] for r in St.select_rank(values, ["k"], wanted).collect()}
        assert got == {k: sorted(part)[ranks[k]] for k, part in data.items()}


def test_statistics_of_a_small_spread_around_a_large_mean(spark):
    values = 1e8 + np.random.default_rng(2).normal(0, 1e-3, 5000)
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("a", float("nan")), ("b", 1.0), ("c", None)], "k string, cmi double").repartition(9)
    got = {r["k"]: r for r in St.band_statistics(df, ["k"]).collect()}
    assert set(got) == {"a", "b"} and got["b"]["std_dev"] == 0.0 and got["b"]["outlier_count"] == 0
    centred = values - 1e8
    assert got["a"]["n"] == 5000 and got["a"]["std_dev"] == pytest.approx(centred.std(), rel=1e-4)
    assert abs(got["a"]["outlier_count"] - (abs(centred - centred.mean()) > 3 * centred.std()).sum()) <= 1
    assert (got["a"]["min"], got["a"]["max"]) == (values.min(), values.max())


def test_statistics_do_not_move_pixels(spark, tmp_path):
    path = str(tmp_path / "pixels")
    spark.range(2000).selectExpr("id % 3 AS k", "cast(id as double) AS cmi").write.parquet(path)
    plan = plan_of(St.band_statistics(spark.read.parquet(path), ["k"]))
    scan = plan[:plan.index("pixels")].splitlines() if "pixels" in plan else []
    assert plan.count("Exchange hashpartitioning") <= 2 and "partial_count" in plan, scan


def test_ir_scale_guards(spark):
    df = spark.createDataFrame([("flat", 5.0)] * 3 + [("low", 0.0)] * 9 + [("low", 1.0)], "k string, v double")
    got = {r["k"]: r for r in St.ir_norm_params(df, ["k"], "v").collect()}
    assert got["flat"]["bp"] == 5.0 and got["low"]["bp"] == pytest.approx(0.01)
    assert St.ir_normalize(df, ["k"], "v").where("k = 'flat' and normalized is not null").isEmpty()


def test_attempts_and_retries(spark):
    log = spark.createDataFrame([("a", "failed", 1), ("a", "failed", 2), ("b", "failed", 1), ("b", "done", 3), ("c", "failed", 9)],
                                "observation_id string, status string, s long").withColumn("ts", F.timestamp_seconds("s"))
    tries = {(r["observation_id"], r["s"]): r["attempt"] for r in runlog.with_attempts(log).collect()}
    assert tries[("a", 2)] == 2 and tries[("b", 3)] == 2 and tries[("c", 9)] == 1
    inputs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "observation_id string")
    names = lambda df: sorted(r[0] for r in df.collect())
    assert names(runlog.retry_inputs(inputs, log, 1)) == ["c"]
    assert names(runlog.retry_inputs(inputs, log, 2)) == ["a", "c"]
    assert names(runlog.resume_inputs(inputs, log)) == ["a", "c", "d"]
    empty = runlog.summary(log.where("false")).first()
    assert empty["success_rate"] == 0.0 and empty["processed_count"] == 0
