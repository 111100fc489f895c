"""Scalar Column functions: rounding, time stamps, scaling, maps and defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

NAN = float("nan")


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def as_value(x: Column) -> Column:
    """A measurement as double, with missing data as NaN."""
    return F.coalesce(x.cast("double"), F.lit(NAN))


def round_half_even(x: Column, decimals: Column | int) -> Column:
    """Round to `decimals` places, ties to the even neighbour."""
    scale = F.pow(F.lit(10.0), F.lit(decimals) if isinstance(decimals, int) else decimals)
    return F.rint(x * scale) / scale


def floor_mod(x: Column, n: float) -> Column:
    """Remainder with the sign of the (positive) divisor."""
    return x - F.lit(n) * F.floor(x / F.lit(n))


def product_stamp(stamp: Column) -> Column:
    """14-digit year, day of year, time and tenth of a second -> timestamp."""
    whole = F.try_to_timestamp(F.substring(stamp, 1, 13), F.lit("yyyyDDDHHmmss"))
    tenths = F.expr("INTERVAL '0.1' SECOND") * F.substring(stamp, 14, 1).cast("int")
    return whole + tenths


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text -> timestamp; unreadable text -> null."""
    return F.try_to_timestamp(text)


def micros(column: str) -> Column:
    """Microseconds since the epoch, with or without a stored time zone."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def text_or_unknown(x: Column) -> Column:
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("unknown"))


def bytes_to_mib(x: Column) -> Column:
    return x / F.lit(1024.0 ** 2)


def mib_to_gib(x: Column) -> Column:
    return x / F.lit(1024.0)


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    """Clamp to [low, high]; NaN stays NaN."""
    low, high = F.lit(low), F.lit(high)
    return F.when(F.isnan(x), x).otherwise(F.least(F.greatest(x, low), high))


def rescale(x: Column, low: Column | float, high: Column | float) -> Column:
    """Clamp to [low, high], then map linearly to [0, 1]."""
    low, high = F.lit(low), F.lit(high)
    return (clip(x, low, high) - low) / (high - low)


def apply_gamma(x: Column, gamma: float | None) -> Column:
    """Clamp to [0, 1] and raise to 1/gamma; no gamma leaves the value alone."""
    if gamma is None:
        return x
    return F.pow(clip(x, 0.0, 1.0), F.lit(1.0 / gamma))


def to_clip_unit(x: Column, unit: str | None, is_difference: bool) -> Column:
    """Bring a channel value to the unit its clip bounds are stated in."""
    if unit == "pct":
        return x * F.lit(100.0)
    if unit == "C" and not is_difference:
        return x - F.lit(273.15)
    return x


def merge_maps(*maps: Column) -> Column:
    """Merge maps; on equal keys the later map wins."""
    return reduce(_merge_two, maps)


def _merge_two(old: Column, new: Column) -> Column:
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)


def drop_map_keys(m: Column, keys: list[str]) -> Column:
    return F.map_filter(m, lambda k, v: ~k.isin(keys))


def pixel_weight(x: Column, y: Column) -> Column:
    """Viewing-angle weight of a fixed-grid pixel."""
    return F.cos(x) * F.cos(y)
