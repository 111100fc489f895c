"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

A source's target is its weight times a level, but at most `max_epochs` times its
own size. Sources above their cap are clamped there and the rest is shared again
by weight among the others, until none is above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from terralattice import session
from terralattice.llm.common import WORD

MAX_EPOCHS = 3
BUCKET_BITS = 12  # hash ranges per source, by which a hot source is split


def text_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, source: str, cycle: int = 3) -> DataFrame:
    """Adds `weight`: 1, 2, ... `cycle`, repeating, over the sources in code point order, null last.

    The window without a key runs over the table of sources, one row each.
    """
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))
    return sources.withColumn("weight", ((rank - 1) % cycle + 1).cast("long"))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to a table of sources with source_size and weight.

    The level only rises from one round to the next, so the clamped set only
    grows; the loop ends when no further source reaches its cap, at the latest
    after as many rounds as there are sources. One row of sums per round reaches
    the driver. Sources without words get the target 0.
    """
    cap = (F.col("source_size") * max_epochs).cast("long")
    level, n_clamped = 0.0, -1
    while True:
        clamped = F.col("weight") * F.lit(level) >= cap
        state = sources.agg(F.sum("source_size").alias("total"),
                            F.sum(F.when(clamped, cap)).alias("clamped"),
                            F.sum(F.when(~clamped, F.col("weight"))).alias("free"),
                            F.count(F.when(clamped, 1)).alias("n")).first()
        if state["n"] == n_clamped or not state["free"]:
            break
        n_clamped = state["n"]
        level = float(state["total"] - (state["clamped"] or 0)) / state["free"]
    reach = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(reach >= cap, cap.cast("double")).otherwise(reach))


def seeded(seed: int, key: str = "doc_id") -> Column:
    """A hash of seed and key, from 0 to 2^60-1."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, copies, taken, and the columns in `carry`.

    Every document of a source is repeated floor(target / source_size) times; one
    repetition more goes to documents in the order of a seeded hash until the
    source's target is reached, so a source misses it by half a document at most.
    The hash order is cut into ranges whose sizes are summed first, and only rows
    of one range meet in a window, however large the source.

    Null and empty texts have size 0; they are repeated like the others and take
    no words. A null source is a source. Rows that repeat a doc_id are hashed
    alike and count one by one. No other columns of `docs` are read. A carried
    column must not bear the name of a result.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        text_words("text").alias("size"), seeded(seed).alias("u"),
                        *[c for c in carry if c not in ("doc_id", "source")])
    thin = session.materialize(sized.select("doc_id", "source", "size", "u"), "mix-sizes")
    sums = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = session.materialize(targets(session.materialize(cyclic_weights(sums, "source"), "mix-sources"), max_epochs), "mix-targets")

    ranged = (sized if carry else thin).withColumn("bucket", F.shiftright("u", 60 - BUCKET_BITS))
    sums = thin.groupBy("source", F.shiftright("u", 60 - BUCKET_BITS).alias("bucket")).agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))).drop("bucket_size")
    inside = Window.partitionBy("source", "bucket").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))

    joined = _join_source(_join_source(ranked, starts, "bucket"), plan)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    more = 2 * (F.col("start") + F.col("inside")) + F.col("size") <= 2 * (F.col("target") - whole * F.col("source_size"))
    out = joined.withColumn("copies", whole + more.cast("long")).withColumn("taken", F.col("size") * F.col("copies"))
    return out.drop("u", "bucket", "start", "inside", "weight")


def _join_source(rows: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Equi-join on source, null matching null, and on `keys`."""
    on = rows["source"].eqNullSafe(other["source"])
    for key in keys:
        on = on & (rows[key] == other[key])
    return rows.join(other, on).drop(*[other[c] for c in ("source", *keys)])
