"""Validity rules as columns, and consistency checks as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from terralattice import constants as C
from terralattice.operators import ordering
from terralattice.operators.groups import join_by


def file_error(name: Column, exists: Column, is_file: Column) -> Column:
    """First rule a file breaks, or null."""
    return (F.when(~exists, "File not found")
            .when(~name.rlike(C.FILENAME_PATTERN), F.concat(F.lit("Invalid filename pattern: "), name))
            .when(~is_file, "Not a regular file"))


def _outside(value: Column, domain: tuple[str, ...]) -> Column:
    return value.isNotNull() & (value != "") & ~value.isin(list(domain))


def attribute_error(slot: Column, platform: Column, scene: Column) -> Column:
    """First attribute outside its domain, or null; missing attributes pass."""
    return (F.when(_outside(slot, C.ORBITAL_SLOTS), F.concat(F.lit("Invalid orbital_slot: "), slot))
            .when(_outside(platform, C.PLATFORMS), F.concat(F.lit("Invalid platform_id: "), platform))
            .when(_outside(scene, C.SCENES), F.concat(F.lit("Invalid scene_id: "), scene)))


def strict_slot_ok(slot: Column) -> Column:
    """Slot rule on opening: a missing slot fails."""
    return F.coalesce(slot.isin(list(C.ORBITAL_SLOTS)), F.lit(False))


LISTED = 20  # different values that a message names


def consistency(observations: DataFrame, keys: list[str], order: list[str],
                time: str = "time") -> DataFrame:
    """Per group: one scene, one resolution, one slot, times increasing.

    A group of a single file passes at once. The least and largest value tell
    whether there are several; the first LISTED of them are named, cut before the
    shuffle, so free text of any variety is never gathered.
    """
    fields = ("scene_id", "spatial_resolution", "orbital_slot")
    rising = ordering.strictly_increasing(observations, keys, order, time)
    ends = observations.groupBy(*keys).agg(*[f(c).alias(f"_{n}_{c}") for c in fields for n, f in (("a", F.min), ("z", F.max))])
    pairs = F.array(*[F.struct(F.lit(c).alias("_field"), F.col(c).cast("string").alias("_value")) for c in fields])
    different = observations.select(*keys, F.inline(pairs)).where("_value is not null").distinct()
    place = F.row_number().over(W.partitionBy(*keys, "_field").orderBy("_value"))
    first = different.withColumn("_nr", place).where(F.col("_nr") <= LISTED + 1)
    named = lambda c: F.array_sort(F.collect_list(F.when(F.col("_field") == c, F.col("_value"))))
    shown = join_by(ends, first.groupBy(*keys).agg(*[named(c).alias(f"_{c}") for c in fields]), keys, "left")
    listed = lambda c: F.concat(F.array_join(F.slice(f"_{c}", 1, LISTED), ", "), F.when(F.size(f"_{c}") > LISTED, ", ...").otherwise(""))
    mixed = [F.when(F.col(f"_a_{c}") != F.col(f"_z_{c}"), F.concat(F.lit(f"Inconsistent {c}: "), listed(c))) for c in fields]
    order_issue = F.when(~F.col("increasing"), "Time values are not monotonically increasing")
    issues = F.when(F.col("n") > 1, F.array_compact(F.array(*mixed, order_issue))).otherwise(F.array())
    return join_by(shown, rising, keys).select(
        *keys, "n", (F.size(issues) == 0).alias("consistent"), F.array_join(issues, "; ").alias("issues"))


def structure(df: DataFrame, keys: list[str], order: list[str],
              time: str = "time") -> DataFrame:
    """Per group: required columns present, times increasing; optional ones warned about."""
    issues = [] if "conventions" in df.columns else ["Missing 'conventions' variable"]
    issues += [f"Missing required coordinate: {c}" for c in ("time", "y", "x") if c not in df.columns]
    warning = "" if "projection" in df.columns else "Missing 'projection' variable"
    fixed = F.lit("; ".join(issues)) if issues else F.lit(None)
    rising = ordering.strictly_increasing(df, keys, order, time)
    late = F.when(~F.col("increasing"), "Time coordinate is not monotonically increasing")
    found = F.concat_ws("; ", fixed, late)
    return rising.select(*keys, "n", (found == "").alias("compliant"), found.alias("issues"),
                         F.lit(warning).alias("warnings"))


def batch_errors(long: DataFrame, frame: list[str], expected_pixels: int, registered: list[int],
                 batch_bands: list[int]) -> DataFrame:
    """Per frame: band set and pixel counts against what the store expects.

    First rule broken, or null: a band the store has not registered, a band set
    other than the batch's, a wrong number of pixels in a band.
    """
    per_band = long.groupBy(*frame, "band").agg(F.count(F.lit(1)).alias("_n"))
    per_frame = per_band.groupBy(*frame).agg(
        F.array_sort(F.collect_set("band")).alias("bands"),
        F.min("_n").alias("min_pixels"), F.max("_n").alias("max_pixels"))
    unknown = F.array_except("bands", F.array(*[F.lit(b) for b in registered]))
    expected = F.array(*[F.lit(b) for b in sorted(batch_bands)])
    error = (F.when(F.size(unknown) > 0, F.concat(F.lit("Unregistered bands: "), F.array_join(unknown, ",")))
             .when(F.col("bands") != expected, "Band set differs within the batch")
             .when((F.col("min_pixels") != expected_pixels) | (F.col("max_pixels") != expected_pixels),
                   "Unexpected frame shape"))
    return per_frame.select(*frame, F.array_join("bands", ",").alias("bands"), "min_pixels", "max_pixels",
                            error.alias("error_message"))


def require_none(bad: DataFrame, message: str) -> None:
    """Strict mode: raise with the first offending row when there is any."""
    rows = bad.take(1)
    if rows:
        raise ValueError(f"{message}: {rows[0].asDict()}")
