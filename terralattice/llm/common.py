"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Words are maximal runs of bytes outside this set, in every operator.
WORD = r"[^\x20\x09-\x0D]+"

LEAST = -(1 << 63)  # stands for a missing doc_id wherever documents are compared by id


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_id(column: str = "doc_id") -> Column:
    """The id as a number that is never null; a missing id comes first."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LEAST))


def text_hash(column: str = "text") -> Column:
    """Names a text; rows of one text share it. A null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def by_batch(df: DataFrame, schema: str, make: Callable[[dict[str, list]], dict[str, object]]) -> DataFrame:
    """Map Arrow batches: `make` takes and returns columns; no row meets another batch."""
    made_schema = to_arrow_schema(T.StructType.fromDDL(schema))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = make({n: batch.column(n).to_pylist() for n in batch.schema.names})
                arrays = [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type) for f in made_schema]
                yield pa.RecordBatch.from_arrays(arrays, schema=made_schema)
    return df.mapInArrow(each, schema)
