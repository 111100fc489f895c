"""Catalog filters, growth and summaries over the observations table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terralattice.functions import scalars as S


def files_for_period(obs: DataFrame, start: str, end: str, orbital_slot: str | None = None) -> DataFrame:
    """Files that start within [start, end]."""
    found = obs.where(F.col("time_coverage_start").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return found if orbital_slot is None else found.where(F.col("orbital_slot") == orbital_slot)


def files_contained(obs: DataFrame, start: str | None = None, end: str | None = None,
                    orbital_slot: str | None = None, scene_id: str | None = None) -> DataFrame:
    """Files that start and end within the range."""
    found = obs
    if start is not None:
        found = found.where(F.col("time_coverage_start") >= F.lit(start).cast("timestamp"))
    if end is not None:
        found = found.where(F.col("time_coverage_end") <= F.lit(end).cast("timestamp"))
    if orbital_slot is not None:
        found = found.where(F.col("orbital_slot") == orbital_slot)
    return found if scene_id is None else found.where(F.col("scene_id") == scene_id)


def files_for_platform(obs: DataFrame, platform_id: str) -> DataFrame:
    return obs.where(F.col("platform_id") == platform_id)


def valid_files(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("error_message").isNull())


def invalid_files(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("error_message").isNotNull())


def in_time_range(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    return df.where(F.col(time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def step_slice(df: DataFrame, start: int, end: int | None = None, index: str = "time_idx") -> DataFrame:
    """Time steps start <= index < end; no end means to the last."""
    found = df.where(F.col(index) >= start)
    return found if end is None else found.where(F.col(index) < end)


def single_step(df: DataFrame, step: int, index: str = "time_idx") -> DataFrame:
    return df.where(F.col(index) == step)


def selected_pixels(pixels: DataFrame, selected: DataFrame, key: str = "file_path") -> DataFrame:
    """Pixels of the selected files only; AQE broadcasts the selection when it is small."""
    return pixels.join(selected.select(key), key, "left_semi")


def not_yet_known(new: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(known.select(*keys), keys, "left_anti")


def same_columns(existing: DataFrame, new: DataFrame) -> None:
    """Refuse an append whose column set differs."""
    have, got = set(existing.columns), set(new.columns)
    if have != got:
        raise ValueError(f"Column mismatch: missing {sorted(have - got)}, unexpected {sorted(got - have)}")


def grow(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows plus the new rows whose key is not yet there, in existing column order.

    Repeats of a key inside `new` must be settled by the caller (`settle`).
    """
    same_columns(existing, new)
    return existing.unionByName(not_yet_known(new, existing, keys).select(*existing.columns))


def settle(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the least over all columns, so reruns pick the same row.

    A partial aggregate, not a window: repeats of a hot key combine before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    least = F.min(F.struct(*rest)).alias("_row")
    return df.groupBy(*keys).agg(least).select(*keys, *[F.col(f"_row.{c}") for c in rest]).select(*df.columns)


def totals(scanned: DataFrame) -> DataFrame:
    """One row: scanned, valid, invalid, time range and size of the valid files."""
    ok = F.col("error_message").isNull()
    return scanned.agg(
        F.count(F.lit(1)).alias("total_scanned"), F.count_if(ok).alias("valid_files"),
        F.count_if(~ok).alias("invalid_files"),
        F.min(F.when(ok, F.col("time_coverage_start"))).alias("earliest"),
        F.max(F.when(ok, F.col("time_coverage_end"))).alias("latest"),
        S.mib_to_gib(F.coalesce(F.sum(F.when(ok, F.col("file_size_mb"))), F.lit(0.0))).alias("total_size_gb"))


def breakdown(scanned: DataFrame) -> DataFrame:
    """Valid files per platform, slot and scene in one pass; missing values are not counted."""
    names = ("platform_id", "orbital_slot", "scene_id")
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value")) for c in names])
    return (valid_files(scanned).select(F.inline(pairs)).where(F.col("value").isNotNull())
            .groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("files")))
