"""Explicit schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T

from terralattice import constants as C


# Text files keep microseconds, which the default formats cut.
TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _D, _I, _L, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType()

OBSERVATIONS = _struct(
    *[(col, _TS if col in C.TIME_ATTRS else _S) for col in C.PROMOTED_ATTRS.values()],
    ("time", _TS), ("file_path", _S), ("file_size_mb", _D),
)

BAND_STATISTICS = _struct(
    ("observation_id", _S), ("band", _I),
    ("min_reflectance", _D), ("max_reflectance", _D),
    ("mean_reflectance", _D), ("std_dev_reflectance", _D),
    ("min_brightness_temp", _D), ("max_brightness_temp", _D),
    ("mean_brightness_temp", _D), ("std_dev_brightness_temp", _D),
    ("outlier_count", _I), ("has_cmi", T.BooleanType()),
)

DATA_QUALITY = _struct(("observation_id", _S), ("grb_errors_percent", _D), ("l0_errors_percent", _D))

VALIDATION_ERRORS = _struct(("file_path", _S), ("error_message", _S), ("timestamp", _TS))

PIXELS = _struct(
    ("orbital_slot", _S), ("time", _TS), ("file_path", _S),
    ("source_id", _L), ("iy", _I), ("ix", _I),
    *[(f"cmi_c{b:02d}", T.FloatType()) for b in C.ALL_BANDS],
    *[(f"dqf_c{b:02d}", T.ShortType()) for b in C.ALL_BANDS],
)

WEIGHTS = _struct(("grid_id", _S), ("target_id", _L), ("rank", _I), ("source_id", _L),
                  ("w", _D), ("dominant", T.BooleanType()), ("max_w", _D))

FRAMES = _struct(("orbital_slot", _S), ("obs_date", T.DateType()), ("time", _TS), ("rows", _L))

RUN_LOG = _struct(("observation_id", _S), ("attempt", _I), ("status", _S), ("error", _S), ("ts", _TS))


def gridded(bands, include_dqf: bool = True) -> T.StructType:
    """Schema of a region's gridded table for the chosen bands."""
    fields = [("orbital_slot", _S), ("obs_date", T.DateType()), ("time", _TS),
              ("platform_id", _S), ("scan_mode", _S),
              ("target_id", _L), ("ilat", _I), ("ilon", _I)]
    fields += [(f"cmi_c{b:02d}", T.FloatType()) for b in bands]
    if include_dqf:
        fields += [(f"dqf_c{b:02d}", T.ShortType()) for b in bands]
    return _struct(*fields)
