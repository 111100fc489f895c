"""Band selection, long form, metadata and product lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terralattice import constants as C, dims
from terralattice.functions import scalars as S


def check_band(df: DataFrame, band: int, prefix: str = "cmi") -> str:
    """Column of a band, or an error when out of 1..16 or absent."""
    if band not in C.ALL_BANDS:
        raise ValueError(f"Band must be 1..16, got {band}")
    column = f"{prefix}_c{band:02d}"
    if column not in df.columns:
        raise KeyError(f"{column} not in table")
    return column


def select_band(df: DataFrame, band: int, keys: list[str], dqf: bool = False) -> DataFrame:
    """One band's CMI (and flag); other bands are pruned from the scan."""
    columns = [F.col(check_band(df, band)).alias("cmi")]
    if dqf:
        columns.append(F.col(check_band(df, band, "dqf")).alias("dqf"))
    return df.select(*keys, *columns)


def available_bands(df: DataFrame, prefix: str = "cmi") -> list[int]:
    """Bands a wide table carries, from its schema alone."""
    return [b for b in C.ALL_BANDS if f"{prefix}_c{b:02d}" in df.columns]


def bands_in_rows(long: DataFrame) -> DataFrame:
    return long.select("band").distinct()


def to_long(df: DataFrame, keys: list[str], with_dqf: bool = False) -> DataFrame:
    """One row per (key, band): a narrow unfolding of the wide row, no shuffle."""
    def entry(b: int) -> Column:
        fields = [F.lit(b).alias("band"), F.col(f"cmi_c{b:02d}").alias("cmi")]
        if with_dqf:
            fields.append(F.col(f"dqf_c{b:02d}").alias("dqf"))
        return F.struct(*fields)
    return df.select(*keys, F.inline(F.array(*[entry(b) for b in available_bands(df)])))


def kind(band: Column) -> Column:
    return F.when(band <= C.LAST_REFLECTANCE_BAND, "reflectance").otherwise("brightness_temperature")


def with_metadata(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Join the 16-row band dimension (fixed size, so broadcast)."""
    return df.join(F.broadcast(dims.bands(spark)), "band", "left")


def override_metadata(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per band, an overriding record replaces the whole default record."""
    fields = [c for c in defaults.columns if c != "band"]
    record = lambda df: F.struct(*[df[c] if c in df.columns else F.lit(None).cast(defaults.schema[c].dataType).alias(c)
                                   for c in fields])
    own = defaults.select("band", record(defaults).alias("_own"))
    other = overrides.select(F.col("band").cast("int").alias("band"), record(overrides).alias("_other"))
    merged = own.join(other, "band", "left").select("band", F.coalesce("_other", "_own").alias("_m"))
    return merged.select("band", *[F.col(f"_m.{c}").alias(c) for c in fields])


def outside_valid_range(long: DataFrame, spark: SparkSession) -> DataFrame:
    """Values that lie outside their band's valid range."""
    value = F.col("cmi").cast("double")
    joined = with_metadata(long, spark)
    return joined.where(S.finite(value) & ~value.between(F.col("valid_min"), F.col("valid_max")))


def flag_names(df: DataFrame, spark: SparkSession, flag: str = "dqf") -> DataFrame:
    """Join name and meaning of the seven quality flags."""
    flags = dims.dqf_flags(spark).withColumnRenamed("flag", flag)
    return df.join(F.broadcast(flags), flag, "left")


def bands_for_product(spark: SparkSession, product: str) -> DataFrame:
    return dims.band_products(spark).where(F.col("product") == product).select("band").orderBy("band")


def products_for_band(spark: SparkSession, band: int) -> DataFrame:
    return dims.band_products(spark).where(F.col("band") == band).orderBy("place").select("product")


def all_products(spark: SparkSession) -> DataFrame:
    return dims.band_products(spark).select("product").distinct().orderBy("product")


def array_attributes(spark: SparkSession) -> DataFrame:
    """Attribute rows (node_path, key, value) of every CMI and DQF array."""
    products = (dims.band_products(spark).groupBy("band")
                .agg(F.array_sort(F.collect_list(F.struct("place", "product"))).alias("p"))
                .select("band", F.array_join(F.col("p.product"), ", ").alias("products")))
    joined = dims.bands(spark).join(F.broadcast(products), "band")
    text = lambda c: F.col(c).cast("string")
    cmi = F.create_map(
        F.lit("long_name"), F.col("long_name"), F.lit("standard_name"), F.col("standard_name"),
        F.lit("units"), F.col("units"), F.lit("radiation_wavelength"), text("wavelength"),
        F.lit("radiation_wavelength_units"), F.lit("um"), F.lit("coordinates"), F.lit("time lat lon"),
        F.lit("ancillary_variables"), F.concat(F.lit("DQF_"), F.col("band_id")),
        F.lit("valid_min"), text("valid_min"), F.lit("valid_max"), text("valid_max"),
        F.lit("products"), F.col("products"))
    dqf = F.create_map(
        F.lit("long_name"), F.concat(F.lit("ABI L2+ CMI data quality flags for band "), text("band")),
        F.lit("standard_name"), F.lit("status_flag"), F.lit("units"), F.lit("1"),
        F.lit("flag_values"), F.lit(" ".join(str(f) for f, _, _ in C.DQF_FLAGS)),
        F.lit("flag_meanings"), F.lit(" ".join(m for _, _, m in C.DQF_FLAGS)),
        F.lit("coordinates"), F.lit("time lat lon"))
    nodes = F.array(F.struct(F.concat(F.lit("CMI_"), F.col("band_id")).alias("node_path"), cmi.alias("attrs")),
                    F.struct(F.concat(F.lit("DQF_"), F.col("band_id")).alias("node_path"), dqf.alias("attrs")))
    return joined.select(F.inline(nodes)).select("node_path", F.explode("attrs").alias("key", "value"))
