"""Dimension tables over the fixed values; each is a fixed, small local relation."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from terralattice import constants as C


def band_kind(band: int) -> str:
    return "reflectance" if band <= C.LAST_REFLECTANCE_BAND else "brightness_temperature"


def band_record(band: int, name: str, wavelength: float, low: float, high: float) -> dict:
    reflective = band <= C.LAST_REFLECTANCE_BAND
    quantity = ("reflectance factor" if reflective
                else "brightness temperature at top of atmosphere")
    return {
        "band": band,
        "band_id": f"C{band:02d}",
        "name": name,
        "wavelength": wavelength,
        "kind": band_kind(band),
        "standard_name": "toa_bidirectional_reflectance" if reflective else "toa_brightness_temperature",
        "long_name": f"ABI Cloud and Moisture Imagery {quantity} - {name}",
        "units": "1" if reflective else "K",
        "valid_min": low,
        "valid_max": high,
    }


_BANDS = pa.schema([
    ("band", pa.int32()), ("band_id", pa.string()), ("name", pa.string()),
    ("wavelength", pa.float64()), ("kind", pa.string()), ("standard_name", pa.string()),
    ("long_name", pa.string()), ("units", pa.string()),
    ("valid_min", pa.float64()), ("valid_max", pa.float64()),
])


def bands(spark: SparkSession) -> DataFrame:
    rows = [band_record(*row) for row in C.BANDS]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=_BANDS))


def band_products(spark: SparkSession) -> DataFrame:
    """One row per (band, product), with the product's place in the band's list."""
    rows = [{"band": b, "place": i, "product": p}
            for b, products in C.BAND_PRODUCTS.items() for i, p in enumerate(products)]
    schema = pa.schema([("band", pa.int32()), ("place", pa.int32()), ("product", pa.string())])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def dqf_flags(spark: SparkSession) -> DataFrame:
    rows = [{"flag": f, "flag_name": n, "meaning": m} for f, n, m in C.DQF_FLAGS]
    schema = pa.schema([("flag", pa.int32()), ("flag_name", pa.string()), ("meaning", pa.string())])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def recipe_bands(spark: SparkSession) -> DataFrame:
    """One row per (recipe, band) over composites and differences."""
    found: dict[tuple[str, str, str], set[int]] = {}
    for name, when, _, terms, *_ in C.COMPOSITES:
        found.setdefault((name, "composite", when), set()).update(terms)
    for name, a, b, _, when, _ in C.DIFFERENCES:
        found[(name, "difference", when)] = {a, b}
    rows = [{"recipe": n, "recipe_type": t, "time_of_day": w, "band": b}
            for (n, t, w), bs in found.items() for b in sorted(bs)]
    schema = pa.schema([("recipe", pa.string()), ("recipe_type", pa.string()),
                        ("time_of_day", pa.string()), ("band", pa.int32())])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
