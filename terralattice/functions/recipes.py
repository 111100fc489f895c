"""RGB composites and band differences compiled to Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from terralattice import constants as C
from terralattice.functions import scalars as S

CHANNELS = ("r", "g", "b")


def cmi_column(band: int) -> Column:
    return F.col(f"cmi_c{band:02d}")


def composite_names() -> list[str]:
    return list(dict.fromkeys(row[0] for row in C.COMPOSITES))


def difference_names() -> list[str]:
    return [row[0] for row in C.DIFFERENCES]


def _recipe_rows(name: str) -> list[tuple]:
    rows = [row for row in C.COMPOSITES if row[0] == name]
    if not rows:
        raise ValueError(f"Unknown composite {name!r}; known: {', '.join(composite_names())}")
    return rows


def _difference_row(name: str) -> tuple:
    for row in C.DIFFERENCES:
        if row[0] == name:
            return row
    raise ValueError(f"Unknown difference {name!r}; known: {', '.join(difference_names())}")


def bands_for(name: str) -> list[int]:
    """Bands a composite or difference reads, ascending."""
    if name in difference_names():
        _, a, b, *_ = _difference_row(name)
        return sorted({a, b})
    return sorted({band for row in _recipe_rows(name) for band in row[3]})


def combine(terms: dict[int, float], band: Callable[[int], Column] = cmi_column) -> Column:
    """Linear combination of bands."""
    total = None
    for number, factor in terms.items():
        value = S.as_value(band(number)) * F.lit(factor)
        total = value if total is None else total + value
    return total


def channel(row: tuple, band: Callable[[int], Column] = cmi_column) -> Column:
    """One recipe channel: combine, convert, scale, invert, gamma, final clip."""
    _, _, _, terms, unit, low, high, gamma, invert = row
    value = combine(terms, band)
    if unit is not None:
        value = S.rescale(S.to_clip_unit(value, unit, len(terms) > 1), low, high)
    if invert:
        value = F.lit(1.0) - value
    return S.clip(S.apply_gamma(value, gamma), 0.0, 1.0)


def composite(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Keys plus r, g, b in [0, 1]; only the recipe's bands are read."""
    rows = {row[2]: row for row in _recipe_rows(name)}
    return df.select(*keys, *[channel(rows[c]).alias(c) for c in CHANNELS])


def difference(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    _, a, b, *_ = _difference_row(name)
    return df.select(*keys, combine({a: 1.0, b: -1.0}).alias("difference"))


def sign_class(value: Column, name: str, is_day: Column | None = None) -> Column:
    """Interpretation class of a difference's sign; null where it has none."""
    classes = _difference_row(name)[5]
    sign = F.when(F.isnan(value), F.lit(None)).when(value > 0, "positive").when(value < 0, "negative")
    if not classes:
        raise ValueError(f"{name} states no sign classes")
    if "positive" in classes:
        return sign
    if is_day is None:
        raise ValueError(f"{name} needs a day / night flag")
    named = F.concat(F.when(is_day, "day_").otherwise("night_"), sign)
    return F.when(named.isin(list(classes)), named)


def recipes_for_time(when: str) -> list[str]:
    """Recipes usable by 'day' or 'night'; 'both' recipes are always included."""
    chosen = [row[0] for row in C.COMPOSITES if row[1] in (when, "both")]
    chosen += [row[0] for row in C.DIFFERENCES if row[4] in (when, "both")]
    return list(dict.fromkeys(chosen))
