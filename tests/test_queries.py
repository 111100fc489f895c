"""Every registered query against its SQL, and no query with a cross join in its plan."""

import pytest

import __spark_entry__ as E
from check_queries import compare, connect, plan_of
from terralattice.plans.registry import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ok, note, _ = compare(spark, duck, SMALL, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["vec_id", "band", "target_id", "cmi"] and not df.isEmpty()


@pytest.mark.parametrize("name", ["agg02_regrid_cmi", "jon02_all_targets", "win06_time_index", "agg19_percentile",
                                  "scl20_ir_normalization", "jon03_geostationary_weights", "jon09_target_grids",
                                  "agg12_consistency", "srt03_even_sample", "flt14_batch_validation"])
def test_no_cross_join(spark, name):
    plan = plan_of(E.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
