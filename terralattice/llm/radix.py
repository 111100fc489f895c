"""Ranks by a distributed radix sort: one stable counting pass per key digit, lowest digit first.

A pass counts the digits of each chunk of the present order, turns the counts into
global offsets by prefix sums, digit before chunk, and puts each row at its digit's
offset plus its place among the chunk's rows of that digit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from terralattice import session

DIGIT_BITS = 12
CHUNK = 1 << 17  # rows that a task holds at once


def ranks(rows: DataFrame, keys: list[str], digit_bits: int = DIGIT_BITS, chunk: int = CHUNK) -> DataFrame:
    """`rows` (long columns, `keys` among them and never null) with `rank`, from 0 in ascending order of the keys.

    The first key weighs most. Rows alike in all keys are ranked as they were
    written. As many digits are passed as the keys' ranges need. Chunks are cut by
    position, so equal keys, however many, never make a task larger.
    """
    names = rows.columns
    placed = session.materialize(rows.withColumn("rank", F.monotonically_increasing_id()), "radix-rows")
    ends = placed.agg(*[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("low", F.min), ("high", F.max))]).first()
    digits = []
    for key in reversed(keys):
        low, high = ends[f"low_{key}"], ends[f"high_{key}"]
        if low is None or high == low:
            continue
        if high - low < 1 << 63:
            value, bits = F.col(key) - F.lit(low), (high - low).bit_length()
        else:
            value, bits = F.col(key).bitwiseXOR(F.lit(-(1 << 63))), 64  # the order of longs without a sign
        digits += [F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << digit_bits) - 1)).cast("int") for shift in range(0, bits, digit_bits)]
    for digit in digits or [F.lit(0)]:  # without digits, positions become gapless
        marked = placed.withColumn("digit", digit).withColumn("chunk", F.expr(f"rank div {chunk}L"))
        placed = session.materialize(_place(marked, _offsets(marked), names), "radix-pass")
    return placed


def _offsets(marked: DataFrame) -> DataFrame:
    """chunk, digits, starts: where the rows of each digit of a chunk go."""
    counts = marked.groupBy("digit", "chunk").agg(F.count("*").alias("n"))
    counts = session.materialize(counts, "radix-counts")
    # A row per digit, so a window without a key is small.
    whole = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    before = whole.select("digit", (F.sum("n").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    inside = F.sum("n").over(Window.partitionBy("digit").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    starts = counts.withColumn("inside", inside).join(F.broadcast(before), "digit")
    return starts.groupBy("chunk").agg(F.collect_list(F.struct("digit", (F.col("base") + F.col("inside")).alias("start"))).alias("starts"))


def _place(marked: DataFrame, offsets: DataFrame, names: list[str]) -> DataFrame:
    def each(rows: pa.Table, starts: pa.Table) -> pa.Table:
        first = starts.column("starts").combine_chunks().flatten()
        table = np.zeros(1 + max(first.field("digit").to_pylist()), np.int64)
        table[first.field("digit").to_numpy()] = first.field("start").to_numpy()
        order = np.argsort(rows.column("rank").to_numpy())
        digit = rows.column("digit").to_numpy()[order].astype(np.uint16)
        by_digit = np.argsort(digit, kind="stable")  # a counting sort for 16 bits
        counts = np.bincount(digit)
        within = np.arange(len(digit)) - np.repeat(np.cumsum(counts) - counts, counts)
        rank = np.empty(len(digit), np.int64)
        rank[order[by_digit]] = table[digit[by_digit]] + within
        return pa.table({**{n: rows.column(n) for n in names}, "rank": pa.array(rank)})
    schema = ", ".join(f"{n} long" for n in [*names, "rank"])
    return marked.groupBy("chunk").cogroup(offsets.groupBy("chunk")).applyInArrow(each, schema)
