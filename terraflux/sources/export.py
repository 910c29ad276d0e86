"""Export of factor rows as payload records by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the record format.
_CONSTANTS = {"name": "Land use change", "node_type": "processing", "lifecycle_stage": "A3", "downstream_node_identifier": "", "output_material_name": "Land use change", "output_amount_unit": "kg"}


def payload(factors: DataFrame, blocklist: DataFrame) -> DataFrame:
    """One record per national row and per provincial row whose name starts with a national row's name of the same crop.

    ``blocklist``: (jurisdiction_name) of provinces to leave out. The path is crop, country and province.
    """
    national = factors.filter("admin_level = 'NATIONAL'")
    countries = national.select("crop_name", F.col("jurisdiction_name").alias("country"))
    parts = factors.filter("admin_level = 'PROVINCIAL'").join(blocklist, "jurisdiction_name", "left_anti")
    head = F.element_at(F.split("jurisdiction_name", r" \| "), 1)
    # names are country | province, so the first part is what a prefix can be
    parts = parts.withColumn("country", head).join(countries, ["crop_name", "country"]).withColumn("province", F.regexp_extract("jurisdiction_name", r" \| (.*)$", 1))
    rows = national.withColumn("country", F.col("jurisdiction_name")).withColumn("province", F.lit("")).unionByName(parts, allowMissingColumns=True)
    # Fixed values of the record format: the columns' names and what stands in those without data.
    kg = F.col("emissions_factor_kgco2e_per_kg") * F.col("production_kg")
    return rows.select(
        F.col("crop_name").alias("crop"), "country", "province", *[F.lit(v).alias(c) for c, v in _CONSTANTS.items()], F.col("production_kg").alias("output_amount"),
        kg.alias("emissions_kgco2e"), kg.alias("cumulative_flag_emissions_kgco2e"), F.lit(0).alias("land_use_change_ghg_emissions_kgco2e"), kg.alias("cumulative_land_use_change_ghg_emissions_kgco2e"),
        F.lit(0).alias("land_management_fossil_ghg_emissions_kgco2e"), F.lit("").alias("cumulative_land_management_fossil_ghg_emissions_kgco2e"),
        F.lit("").alias("land_management_excl_biogenic_co2_kgco2e"), F.lit("").alias("cumulative_land_management_excl_biogenic_co2_kgco2e"),
        F.lit(False).alias("flag_is_cumulative"), F.lit(False).alias("is_flag_node"), F.lit("").alias("conversion_factor_value"), F.lit(1).alias("conversion_factor_unit"),
    )


def identifier() -> Column:
    """A record's identifier in the form of a UUID, made of its path: reruns and retried tasks give the same."""
    path = F.md5(F.concat_ws("\u001f", "crop", "country", "province"))
    ends = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(path, a, n) for a, n in ends])


def write_payload(records: DataFrame, path: str) -> None:
    """CSV files under crop=/country=/province=, each record with an identifier of its own, the same on each run."""
    records.withColumn("identifier", identifier()).write.mode("overwrite").partitionBy("crop", "country", "province").option("header", True).csv(path)


def write_bands(df: DataFrame, bands: list[str], path: str) -> None:
    """Chosen bands of a gridded stage."""
    df.select("tile_id", "row", "col", *bands).write.mode("overwrite").partitionBy("tile_id").parquet(path)
