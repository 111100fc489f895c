"""Contiguous shards of near-equal bytes, cut on global prefix sums.

Rows are put in order by a range shuffle; each partition sums up its own sizes,
and the totals of the partitions, one short row each, give every partition its
place on the whole line of bytes. Cuts lie at equal distances on that line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from terralattice import session

def contiguous_shards(rows: DataFrame, n_shards: int, size: Column, order: list[str]) -> DataFrame:
    """`rows` with `shard` (0 to n_shards-1) and `slot` (gapless from 0 in its shard).

    Rows are ordered by the columns in `order`, nulls first, and rows alike in
    all of them by where they were read; a shard is a run of that order. A row belongs
    to the shard in which its middle byte lies, so a shard is off its target by
    less than one row at either end. Sizes must be positive. A row larger than a
    target may leave a shard empty. Columns of `rows` that bear the names of the
    results are replaced. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    whole = F.struct(*[c for c in rows.columns if c not in ("shard", "slot")]).alias("row")
    sized = rows.select(whole, size.cast("long").alias("size"), F.monotonically_increasing_id().alias("read"))
    keys = [f"row.{c}" for c in order] + ["read"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sized.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("row", "size")
    schema = T.StructType([*ordered.schema.fields, T.StructField("chunk", T.IntegerType()),
                           T.StructField("before", T.LongType()), T.StructField("nr", T.LongType())])

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, done, count = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
            ends = done + np.cumsum(sizes)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, chunk, np.int32)), pa.array(ends - sizes), pa.array(np.arange(count, count + n))],
                names=[*batch.schema.names, "chunk", "before", "nr"])
            done, count = done + int(sizes.sum()), count + n
    placed = session.materialize(ordered.mapInArrow(running, schema), "shards")

    # One row per partition, so a window without a key is small, and so is the broadcast.
    totals = placed.groupBy("chunk").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("chunk", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes0"),
                            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows0"), F.sum("bytes").over(everywhere).alias("total"))
    middle = (2 * (F.col("bytes0") + F.col("before")) + F.col("size")).cast("decimal(38,0)")
    numbered = placed.join(F.broadcast(offsets), "chunk").withColumn("middle", middle).select(
        "row", (F.col("rows0") + F.col("nr")).alias("at"),
        F.expr(f"cast((middle * {int(n_shards)}) div (2 * cast(total as decimal(38,0))) as int)").alias("shard"))
    first = numbered.groupBy("shard").agg(F.min("at").alias("first"))  # n_shards rows
    return numbered.join(F.broadcast(first), "shard").select("row.*", "shard", (F.col("at") - F.col("first")).alias("slot"))


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text and one for its end; a null text counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
