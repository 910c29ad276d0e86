"""Production, yields and emission factors: provincial rows, national rows, and their union."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from terraflux import factors as k
from terraflux.functions.nulls import ratio

SUMS = ["crop_hectares", "forest_emissions_mt", "peatland_crop_hectares", "peatland_conversion_emissions_mt", "peatland_occupation_emissions_mt", "emissions_mt", "production_kg"]
COLUMNS = ["admin_level", "crop_name", "jurisdiction_name", "methodology", "admin_id", *SUMS, "yield_kg_per_ha", "emissions_factor_kgco2e_per_kg", "peatland_occupation_fraction"]


def crop_names(method: str, few: bool = False) -> list[str]:
    """Crops of a methodology, or the three that both share most."""
    return list(k.FEW_CROPS) if few else list(k.DIRECT_CROPS if method == "JURISDICTIONAL_DIRECT" else k.STATISTICAL_CROPS)


def mean_yields(yields: DataFrame) -> DataFrame:
    """(admin_id, crop_name, yield_kg_per_ha): mean of the accounting years, crops by their common names."""
    names = F.create_map(*[F.lit(x) for pair in k.SURVEY_CROPS.items() for x in pair])
    own = yields.filter(F.col("year").isin(list(k.YIELD_YEARS)))
    mean = own.groupBy("admin_id", "crop_name").agg(F.avg("yield_kg_per_ha").alias("yield_kg_per_ha"))
    return mean.select("admin_id", F.coalesce(F.try_element_at(names, F.col("crop_name")), F.col("crop_name")).alias("crop_name"), "yield_kg_per_ha")


def direct_production(emissions: DataFrame, yields: DataFrame) -> DataFrame:
    """production_kg = hectares x mean yield, NULL without a yield."""
    joined = emissions.join(mean_yields(yields), ["admin_id", "crop_name"], "left")
    return joined.withColumn("production_kg", F.col("crop_hectares") * F.col("yield_kg_per_ha")).drop("yield_kg_per_ha")


def unmatched_yields(with_production: DataFrame) -> DataFrame:
    """How many (admin, crop) rows had no yield."""
    return with_production.agg(F.count_if(F.col("production_kg").isNull()).alias("unmatched"))


def statistical_production(emissions: DataFrame) -> DataFrame:
    return emissions.withColumn("production_kg", F.col("production_mt") * k.KG_PER_TONNE).drop("production_mt")


def attach_ratios(df: DataFrame) -> DataFrame:
    """yield, factor and occupation fraction, NULL unless the denominator is positive."""
    c = F.col
    return df.select(
        "*",
        ratio(c("production_kg"), c("crop_hectares")).alias("yield_kg_per_ha"),
        ratio(c("emissions_mt") * k.KG_PER_TONNE, c("production_kg")).alias("emissions_factor_kgco2e_per_kg"),
        ratio(c("peatland_occupation_emissions_mt"), c("emissions_mt")).alias("peatland_occupation_fraction"),
    )


def national(provincial: DataFrame, countries: DataFrame) -> DataFrame:
    """National rows per (iso, crop, methodology): sums, unknown production as 0; ratios NULL only where the denominator is 0.

    A country is the first three characters of admin_id; ``countries``: (iso, national_name).
    """
    own = provincial.withColumn("iso", F.substring("admin_id", 1, 3))
    sums = own.groupBy("iso", "crop_name", "methodology").agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in SUMS])
    over = lambda a, b: F.when(b != 0, a / b)
    c = F.col
    out = sums.join(countries, "iso").select(
        F.lit("NATIONAL").alias("admin_level"), "crop_name", c("national_name").alias("jurisdiction_name"), "methodology", c("iso").alias("admin_id"), *SUMS,
        over(c("production_kg"), c("crop_hectares")).alias("yield_kg_per_ha"),
        over(c("emissions_mt") * k.KG_PER_TONNE, c("production_kg")).alias("emissions_factor_kgco2e_per_kg"),
        over(c("peatland_occupation_emissions_mt"), c("emissions_mt")).alias("peatland_occupation_fraction"),
    )
    return out.select(*COLUMNS)


def factor_table(provincial: DataFrame, countries: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Provincial and national rows, with ``regions`` (iso, region) regional ones, too: one roll-up by grouping sets. Rows that are not provincial are an error.

    Rows of a province have its measures as they are, sums of unknown production unknown; larger units count unknown as 0. Ratios of provinces
    are NULL unless the denominator is positive, of larger units only where it is 0. ``countries``: (iso, national_name).
    """
    checked = provincial.withColumn("admin_level", F.when(F.col("admin_level") == "PROVINCIAL", F.col("admin_level")).otherwise(F.raise_error(F.lit("rows must be provincial"))))
    # the check is part of the first measure, so that no optimisation leaves it out
    own = checked.withColumn(SUMS[0], F.when(F.col("admin_level").isNotNull(), F.col(SUMS[0]))).withColumn("iso", F.substring("admin_id", 1, 3))
    own = own.join(countries.select("iso", "national_name"), "iso", "left")
    own = own.join(regions.select("iso", "region"), "iso", "left") if regions is not None else own.withColumn("region", F.lit(None).cast("string"))
    tag = ["crop_name", "methodology"]
    sets = [["admin_id", "jurisdiction_name", *tag], ["iso", "national_name", *tag], *([["region", *tag]] if regions is not None else [])]
    keys = ["admin_id", "jurisdiction_name", "iso", "national_name", "region", *tag]
    sums = own.groupingSets(sets, *keys).agg(F.grouping("admin_id").alias("_larger"), F.grouping("iso").alias("_not_national"), *[F.sum(m).alias(m) for m in SUMS])
    larger = F.col("_larger") == 1
    level = F.when(~larger, "PROVINCIAL").when(F.col("_not_national") == 0, "NATIONAL").otherwise("REGIONAL")
    named = sums.filter(~larger | F.coalesce("national_name", "region").isNotNull()).select(
        level.alias("admin_level"), "crop_name", F.when(~larger, F.col("jurisdiction_name")).otherwise(F.coalesce("national_name", "region")).alias("jurisdiction_name"), "methodology",
        F.coalesce("admin_id", "iso", "region").alias("admin_id"), *[F.when(larger, F.coalesce(m, F.lit(0.0))).otherwise(F.col(m)).alias(m) for m in SUMS],
    )
    c = F.col
    known = lambda b: F.when(c("admin_level") == "PROVINCIAL", b > 0).otherwise(b != 0)
    over = lambda a, b: F.when(known(b), a / b)
    return named.select(
        *named.columns,
        over(c("production_kg"), c("crop_hectares")).alias("yield_kg_per_ha"),
        over(c("emissions_mt") * k.KG_PER_TONNE, c("production_kg")).alias("emissions_factor_kgco2e_per_kg"),
        over(c("peatland_occupation_emissions_mt"), c("emissions_mt")).alias("peatland_occupation_fraction"),
    ).select(*COLUMNS)


def observed(provincial: DataFrame, name: str = "trace") -> tuple[DataFrame, Observation]:
    """``provincial`` and an observation that the pass which uses it fills: rows, rows without a yield (unmatched), and rows that are not provincial."""
    seen = Observation(name)
    unmatched = F.count_if(F.col("production_kg").isNull())
    others = F.count_if(~F.col("admin_level").eqNullSafe("PROVINCIAL"))
    return provincial.observe(seen, F.count(F.lit(1)).alias("rows"), unmatched.alias("unmatched"), others.alias("not_provincial")), seen


def write_factors(provincial: DataFrame, countries: DataFrame, path: str) -> dict[str, int]:
    """Writes the factor table and returns what was observed in the pass that wrote it: no second job counts anything.

    The keys are rows, unmatched (rows without a yield) and not_provincial.
    """
    rows, seen = observed(provincial)
    factor_table(rows, countries).write.mode("overwrite").parquet(path)
    return seen.get


def attribute(by_method: dict[str, DataFrame], names: DataFrame) -> DataFrame:
    """Rolled-up measures of each methodology, tagged and named, as provincial rows; ``names``: (admin_id, jurisdiction_name)."""
    out = None
    for method, df in by_method.items():
        own = df.join(names, "admin_id").select("*", F.lit("PROVINCIAL").alias("admin_level"), F.lit(method).alias("methodology"))
        out = own if out is None else out.unionByName(own)
    return out
