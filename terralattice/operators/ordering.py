"""Order-dependent computations that never put a whole key in one task.

A key (an orbital slot, a user, an axis) may hold a large share of all rows, so
a window over the key alone would run in one task. Here all rows are range
partitioned by key and order and sorted within the partitions, once, and written:
each partition is a run. What a row needs from other runs comes from summaries of
one row per key and run. This holds for any ids and any share of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from terralattice import session

_ROW_BITS = 33  # monotonically_increasing_id: the partition above, the row within it below


def _runs(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows sorted into runs: `_key` (never null itself), `_run`, and `_row` within the run."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    written = session.materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "runs")
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    return written.withColumns({"_key": key, "_run": F.shiftright("_at", _ROW_BITS),
                                "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}).drop("_at")


_PLACE = ["_key", "_run"]


def _along_runs():
    return W.partitionBy("_key").orderBy("_run")


def _earlier_sum(amount: str) -> Column:
    return F.coalesce(F.sum(amount).over(_along_runs().rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def with_position(df: DataFrame, keys: list[str], order: list[str], name: str = "position",
                  size: str | None = None) -> DataFrame:
    """Add the zero-based dense position of each row within its key, and the key's `size` if named.

    `order` should be total; missing values come first. A position is the rows of
    the key in earlier runs plus those before it in its own.
    """
    rows = _runs(df, keys, order)
    starts = rows.groupBy(*_PLACE).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    offsets = starts.select(*_PLACE, (_earlier_sum("_n") - F.col("_first")).alias("_offset"),
                            F.sum("_n").over(W.partitionBy("_key")).alias("_size"))
    placed = rows.join(offsets, _PLACE).withColumn(name, F.col("_row") + F.col("_offset"))
    if size is not None:
        placed = placed.withColumn(size, F.col("_size"))
    return placed.drop("_row", "_offset", "_size", *_PLACE)


def with_sum_before(df: DataFrame, keys: list[str], order: list[str], amount: str, name: str = "before",
                    total: str | None = None) -> DataFrame:
    """Add the sum of `amount` over the rows of the key before each row, and the key's `total` if named."""
    rows = _runs(df, keys, order)
    sums = rows.groupBy(*_PLACE).agg(F.sum(amount).alias("_sum"))
    offsets = sums.select(*_PLACE, _earlier_sum("_sum").alias("_offset"), F.sum("_sum").over(W.partitionBy("_key")).alias("_whole"))
    inside = W.partitionBy(*_PLACE).orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    joined = rows.join(offsets, _PLACE).withColumn(name, F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    if total is not None:
        joined = joined.withColumn(total, F.col("_whole"))
    return joined.drop("_row", "_offset", "_whole", *_PLACE)


def with_previous(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "previous") -> DataFrame:
    """Add `value` of the preceding row of the key (null on its first row).

    The first row of a run looks at the last row of the nearest earlier run that
    has the key.
    """
    rows = _runs(df, keys, order).withColumn("_v", F.struct(F.col(value).alias("v")))
    ends = rows.groupBy(*_PLACE).agg(F.max_by("_v", "_row").alias("_last"))
    before = ends.select(*_PLACE, F.lag("_last").over(_along_runs()).alias("_before"))
    inside = F.lag("_v").over(W.partitionBy(*_PLACE).orderBy("_row"))
    return (rows.join(before, _PLACE).withColumn(name, F.coalesce(inside, F.col("_before"))["v"])
            .drop("_before", "_v", "_row", *_PLACE))


def strictly_increasing(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Per key: does `value` strictly increase along the order (true for one row)?"""
    stepped = with_previous(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, value, "_before_value")
    rises = F.coalesce(F.col(value) > F.col("_before_value"), F.lit(True))
    return stepped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_and(rises).alias("increasing"))


def every_kth(df: DataFrame, keys: list[str], order: list[str], n_points: int) -> DataFrame:
    """Every k-th row of a key, k = max(1, rows div n_points)."""
    placed = with_position(df, keys, order, "_pos", size="_n")
    k = F.greatest(F.lit(1), F.floor(F.col("_n") / n_points))
    return placed.where(F.pmod(F.col("_pos"), k) == 0).drop("_n", "_pos")


def even_sample(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """n rows spread evenly over each key: positions floor(i * N / n)."""
    placed = with_position(df, keys, order, "_pos", size="_n")
    # position p is picked when some i < n has floor(i*N/n) = p, i.e. the
    # smallest i with i*N >= p*n also satisfies i*N < (p+1)*n.
    i = F.ceil(F.col("_pos") * n / F.col("_n"))
    picked = (F.col("_n") <= n) | ((i < n) & (i * F.col("_n") < (F.col("_pos") + 1) * n))
    return placed.where(picked).drop("_pos", "_n")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, fixed by the seed and the row keys.

    Rows are drawn in the order of a hash. Counts of 4096 ranges of it tell which
    ranges are taken whole; only the range in which the n-th row lies is ordered.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    drawn = df.withColumn("_draw", F.coalesce(draw, F.lit("")))
    drawn = drawn.withColumn("_range", F.coalesce(F.conv(F.substring("_draw", 1, 3), 16, 10).cast("int"), F.lit(0)))
    counts = drawn.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # 4096 rows at most
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.select("_range", "_n", before.alias("_before")).where(F.col("_before") < n)
    joined = drawn.join(F.broadcast(ranges), "_range")
    whole = joined.where(F.col("_before") + F.col("_n") <= n)
    last = joined.where(F.col("_before") + F.col("_n") > n)
    place = F.row_number().over(W.partitionBy("_range").orderBy("_draw", key))
    cut = last.withColumn("_place", place).where(F.col("_place") <= n - F.col("_before"))
    return whole.select(*df.columns).unionByName(cut.select(*df.columns))


def newest(df: DataFrame, keys: list[str], by: str, n: int) -> DataFrame:
    """The last n rows of each key by name; a top-n per key, pruned before the shuffle."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.col(by).desc()))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def append_positions(new: DataFrame, stored: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Positions that new rows take when appended after the stored ones, from the largest position stored."""
    last = stored.agg(F.max(name)).first()[0]
    placed = with_position(new, [], order, name)
    return placed.withColumn(name, (F.col(name) + (0 if last is None else last + 1)).cast("long"))


def position_range(placed: DataFrame, name: str = "position") -> DataFrame:
    """One row: the first position and the one after the last; null where there are no rows."""
    return placed.agg(F.min(name).alias("start"), (F.max(name) + 1).alias("end"))
