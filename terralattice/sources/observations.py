"""From per-file attributes and variables to the four catalog tables.

Input: one row per file with `file_path`, `file_name`, `size_bytes`, `t` (text
time), `attrs MAP<STRING,STRING>` and `vars MAP<STRING,DOUBLE>` (scalar
variables: statistics, quality metrics, and any non-null value for each CMI variable present).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from terralattice import constants as C
from terralattice.functions import scalars as S
from terralattice.operators import validate


@dataclass(frozen=True)
class Catalog:
    observations: DataFrame
    band_statistics: DataFrame
    data_quality: DataFrame
    validation_errors: DataFrame


def promoted(attrs: str = "attrs") -> list[Column]:
    """The promoted attributes as columns; time attributes parsed, unreadable ones null."""
    value = lambda key: F.try_element_at(F.col(attrs), F.lit(key))
    return [(S.iso_timestamp(value(k)) if c in C.TIME_ATTRS else value(k)).alias(c)
            for k, c in C.PROMOTED_ATTRS.items()]


def scanned(files: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Validate every file in one pass; `error_message` is null for good ones.

    `listed(file_path[, is_file])` is what a scan of the store found: a file that
    is not in it does not exist. Without it, files are taken to be there.
    """
    attr = lambda key: F.try_element_at(F.col("attrs"), F.lit(key))
    present = F.col("attrs").isNotNull()
    exists, regular = F.lit(True), F.lit(True)
    if listed is not None:
        is_file = F.col("is_file") if "is_file" in listed.columns else F.lit(True)
        found = listed.select("file_path", is_file.alias("_file")).groupBy("file_path").agg(F.bool_or("_file").alias("_file"))
        files = files.join(found, "file_path", "left")
        exists, regular = F.col("_file").isNotNull(), F.coalesce("_file", F.lit(False))
    error = F.coalesce(
        validate.file_error(F.col("file_name"), exists, regular),
        F.when(~present, "Failed to extract metadata: no attributes"),
        validate.attribute_error(attr("orbital_slot"), attr("platform_ID"), attr("scene_id")))
    return files.withColumn("error_message", error).drop("_file")


def observations(good: DataFrame) -> DataFrame:
    return good.select(*promoted(), S.iso_timestamp(F.col("t")).alias("time"), "file_path",
                       S.bytes_to_mib(F.col("size_bytes")).alias("file_size_mb"))


def opened(files: DataFrame) -> DataFrame:
    """Normalise files for opening: strict slot rule, `time` from the scalar `t`."""
    slot = F.try_element_at(F.col("attrs"), F.lit("orbital_slot"))
    wrong = F.concat(F.lit("Invalid orbital_slot: "), F.coalesce(slot, F.lit("missing")))
    return files.select("file_path", S.iso_timestamp(F.col("t")).alias("time"), *promoted(),
                        F.when(~validate.strict_slot_ok(slot), wrong).alias("error_message"))


_STATS = ("min", "max", "mean", "std_dev")


def _statistic(stat: str, band: int) -> str:
    quantity = "reflectance_factor" if band <= C.LAST_REFLECTANCE_BAND else "brightness_temperature"
    return f"{stat}_{quantity}_C{band:02d}"


def _band_variables() -> T.StructType:
    names = [_statistic(s, b) for b in C.ALL_BANDS for s in _STATS]
    names += [f"{prefix}_C{b:02d}" for b in C.ALL_BANDS for prefix in ("outlier_pixel_count", "CMI")]
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def band_statistics(good: DataFrame) -> DataFrame:
    """Sixteen rows per file; reflectance columns are null for bands 7-16 and conversely.

    The variable map is turned into a struct once, by way of JSON, because a
    hundred lookups by key would each walk the map.
    """
    key = F.coalesce(F.try_element_at(F.col("attrs"), F.lit("id")), F.lit("unknown"))
    read = good.select(key.alias("observation_id"), F.from_json(F.to_json("vars"), _band_variables()).alias("_v"))

    def entry(b: int) -> Column:
        reflective = b <= C.LAST_REFLECTANCE_BAND
        none = F.lit(None).cast("double")
        value = lambda s, wanted: F.col(f"_v.{_statistic(s, b)}") if wanted else none
        return F.struct(
            F.lit(b).alias("band"),
            *[value(s, reflective).alias(f"{s}_reflectance") for s in _STATS],
            *[value(s, not reflective).alias(f"{s}_brightness_temp") for s in _STATS],
            F.col(f"_v.outlier_pixel_count_C{b:02d}").cast("int").alias("outlier_count"),
            F.col(f"_v.CMI_C{b:02d}").isNotNull().alias("has_cmi"))
    return read.select("observation_id", F.inline(F.array(*[entry(b) for b in C.ALL_BANDS])))


def data_quality(good: DataFrame) -> DataFrame:
    var = lambda name: F.try_element_at(F.col("vars"), F.lit(name))
    key = F.coalesce(F.try_element_at(F.col("attrs"), F.lit("id")), F.lit("unknown"))
    return good.select(key.alias("observation_id"),
                       var("percent_uncorrectable_GRB_errors").alias("grb_errors_percent"),
                       var("percent_uncorrectable_L0_errors").alias("l0_errors_percent"))


def scan(files: DataFrame, scan_time: Column | None = None) -> Catalog:
    """The four catalog tables of a set of files."""
    checked = scanned(files)
    good = checked.where(F.col("error_message").isNull())
    bad = checked.where(F.col("error_message").isNotNull())
    stamp = F.current_timestamp() if scan_time is None else scan_time
    errors = bad.select("file_path", "error_message", stamp.alias("timestamp"))
    return Catalog(observations(good), band_statistics(good), data_quality(good), errors)


def metadata_records(obs: DataFrame) -> DataFrame:
    """The promoted attributes of each observation with its file."""
    return obs.select("time", *[c for c in C.PROMOTED_ATTRS.values() if c in obs.columns], "file_path")
