"""Band statistics, exact percentiles and infrared normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terralattice import session
from terralattice.functions import scalars as S
from terralattice.operators.groups import join_by, spread_join


BINS = 4096  # of a key's range that a round counts


def _finite(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.select(*keys, F.col(value).cast("double").alias("v")).where(S.finite(F.col("v")))


def band_statistics(long: DataFrame, keys: list[str], spread: float = 3.0) -> DataFrame:
    """Count, min, max, mean, population std and outliers of the finite values.

    An outlier lies more than `spread` standard deviations from the mean. Each task
    sums up its pixels as (n, mean, squared deviations, min, max); these partial
    results, a row per task and key, are merged pairwise, which stays exact for a
    small spread around a large mean. A second pass counts the outliers. Pixels are
    neither moved nor written, as long as the statistics, a row per key, are small
    enough to be sent to them.
    """
    good = _finite(long, keys, "cmi")
    stats = session.materialize(good.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std_dev")), "statistics")
    far = F.abs(F.col("v") - F.col("mean")) > spread * F.col("std_dev")
    outliers = join_by(good, stats.select(*keys, "mean", "std_dev"), keys).groupBy(*keys).agg(F.count_if(far).alias("outlier_count"))
    return join_by(stats, outliers, keys).select(*keys, "n", "min", "max", "mean", "std_dev", "outlier_count")


def _bin(v: Column, low: Column, high: Column) -> Column:
    """Number of the bin of low...high that holds a value; never falls as the value rises."""
    share = (v - low) / (high - low)
    halved = (v / 2 - low / 2) / (high / 2 - low / 2)  # where the difference is beyond a double
    at = F.when(F.abs(high - low) < float("inf"), share).otherwise(halved)
    return F.least(F.floor(at * BINS), F.lit(BINS - 1)).cast("int")


def select_rank(values: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """keys, found: the value of a zero-based rank per key.

    `values` has keys and v, finite; `wanted` has keys, rank, low, high: the least
    and largest value of the key. Each round counts the values in BINS bins of the
    key's range and goes on in the bin that holds the rank, between the least and
    largest value that it really has, until these are one. So ranges shrink by what
    lies in them, no order of all values is made, and a round moves at most BINS
    rows per task and key.
    """
    state = session.materialize(wanted.select(*keys, F.col("rank").alias("_rank"), F.col("low").alias("_low"), F.col("high").alias("_high")), "ranges")
    while True:
        still = state.where("_low < _high")
        if still.isEmpty():
            return state.select(*keys, F.col("_low").alias("found"))
        inside = join_by(values, still, keys).where(F.col("v").between(F.col("_low"), F.col("_high")))
        counts = inside.groupBy(*keys, _bin(F.col("v"), F.col("_low"), F.col("_high")).alias("_bin")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("v").alias("_from"), F.max("v").alias("_to"))
        # A key's bins, BINS at most, are gone through in one row.
        bins = counts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_bin", "_n", "_from", "_to"))).alias("_bins"))
        step = F.aggregate(
            "_bins", F.struct(F.col("_rank").alias("rank"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")),
            lambda s, b: F.when(s["low"].isNotNull(), s).when(s["rank"] < b["_n"], F.struct(s["rank"].alias("rank"), b["_from"].alias("low"), b["_to"].alias("high")))
            .otherwise(F.struct((s["rank"] - b["_n"]).alias("rank"), s["low"].alias("low"), s["high"].alias("high"))))
        next_ = join_by(still, bins, keys).select(*keys, step.alias("_s")).select(
            *keys, F.col("_s.rank").alias("_rank"), F.col("_s.low").alias("_low"), F.col("_s.high").alias("_high"))
        state = session.materialize(state.where("_low = _high").unionByName(next_), "ranges")


def percentile_exact(df: DataFrame, keys: list[str], value: str, fraction: float) -> DataFrame:
    """Exact percentile with linear interpolation, one row per key.

    Returns `n, min, max, percentile` over finite values. The value of the lower of
    the two ranks around it is found by counting in ever smaller ranges; the other
    is the same or the next larger one. The input is read once per round.
    """
    good = _finite(df, keys, value)
    ends = session.materialize(good.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max")), "ends")
    at = F.lit(float(fraction)) * (F.col("n") - 1)
    lower = select_rank(good, keys, ends.select(*keys, F.floor(at).alias("rank"), F.col("min").alias("low"), F.col("max").alias("high")))
    above = join_by(good, lower, keys).groupBy(*keys, "found").agg(
        F.count_if(F.col("v") <= F.col("found")).alias("_upto"), F.min(F.when(F.col("v") > F.col("found"), F.col("v"))).alias("_next"))
    upper = F.when(F.col("_upto") > F.ceil(at), F.col("found")).otherwise(F.col("_next"))
    return join_by(ends, above, keys).select(
        *keys, "n", "min", "max", (F.col("found") + (at - F.floor(at)) * (upper - F.col("found"))).alias("percentile"))


def ir_norm_params(df: DataFrame, keys: list[str], value: str, warm_percent: float = 30.0) -> DataFrame:
    """vmin, breakpoint and vmax of the two-piece infrared scale, one row per key."""
    p = percentile_exact(df, keys, value, (100.0 - warm_percent) / 100.0)
    low, high, nudge = F.col("min"), F.col("max"), 0.01 * (F.col("max") - F.col("min"))
    raised = F.when(F.col("percentile") <= low, low + nudge).otherwise(F.col("percentile"))
    held = p.withColumn("_bp", raised)
    return held.select(*keys, low.alias("vmin"), high.alias("vmax"),
                       F.when(F.col("_bp") >= high, high - nudge).otherwise(F.col("_bp")).alias("bp"))


def ir_forward(x: Column, vmin: Column, bp: Column, vmax: Column, share: float = 0.10) -> Column:
    """Cold side to [0, 1 - share], warm side to [1 - share, 1]."""
    cold = F.try_divide(x - vmin, bp - vmin) * (1.0 - share)
    warm = (1.0 - share) + F.try_divide(x - bp, vmax - bp) * share
    return F.when(F.isnan(x), x).when(x <= bp, cold).otherwise(warm)


def ir_inverse(y: Column, vmin: Column, bp: Column, vmax: Column, share: float = 0.10) -> Column:
    cold = y / (1.0 - share) * (bp - vmin) + vmin
    warm = (y - (1.0 - share)) / share * (vmax - bp) + bp
    return F.when(F.isnan(y), y).when(y <= 1.0 - share, cold).otherwise(warm)


def ir_normalize(df: DataFrame, keys: list[str], value: str, warm_percent: float = 30.0,
                 share: float = 0.10) -> DataFrame:
    """Add `normalized`; scale parameters are per key."""
    params = ir_norm_params(df, keys, value, warm_percent)
    joined = spread_join(df, params, keys, value)
    x = S.as_value(F.col(value))
    return joined.withColumn("normalized", ir_forward(x, F.col("vmin"), F.col("bp"), F.col("vmax"), share))
