"""Agreement of two land-cover maps: confusion, cases, transitions and category changes, by area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux import factors as k
from terraflux.functions.nulls import in_ranges

ROW_CROPS = [c for c in k.HERBACEOUS if c not in k.HAY + k.FALLOW]


def category(code: Column) -> Column:
    """Nine simplified categories; unknown codes are 8."""
    return in_ranges(code, k.CATEGORY_RANGES, 8)


def category_name(cat: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in k.CATEGORY_NAMES]), cat + 1)


def is_row_crop(code: Column) -> Column:
    return F.coalesce(code.isin(ROW_CROPS), F.lit(False))


def crop_category(code: Column) -> Column:
    """0 other, 1 row crop, 2 hay, 3 fallow."""
    return F.when(is_row_crop(code), 1).when(code.isin(k.HAY), 2).when(code.isin(k.FALLOW), 3).otherwise(0)


def confusion(df: DataFrame, state: str, crop: Column, cover: Column) -> DataFrame:
    """Area of the four combinations per state, the crop total and the share of it that the cover confirms."""
    a, b, ha = F.coalesce(crop, F.lit(False)), F.coalesce(cover, F.lit(False)), F.col("ha")
    area = lambda x: F.coalesce(F.sum(F.when(x, ha)), F.lit(0.0))
    out = df.groupBy(state).agg(area(a & b).alias("crop_cover"), area(a & ~b).alias("crop_other"), area(~a & b).alias("other_cover"), area(~a & ~b).alias("other_other"))
    total = F.col("crop_cover") + F.col("crop_other")
    return out.select("*", total.alias("crop_total"), F.when(total > 0, 100 * F.col("crop_cover") / total).alias("confirm_pct"))


def by_region(conf: DataFrame, regions: DataFrame, state: str) -> DataFrame:
    """Confirmed share of each region's area, and the range over its member states that have data."""
    own = conf.join(regions, state)
    total = F.sum("crop_total")
    return own.groupBy("region").agg(total.alias("crop_total"), F.when(total > 0, 100 * F.sum("crop_cover") / total).otherwise(0.0).alias("confirm_pct"), F.min("confirm_pct").alias("least_pct"), F.max("confirm_pct").alias("most_pct"))


def with_case(df: DataFrame, crop_code: str, first: str, last: str) -> DataFrame:
    """Row-crop pixels with categories src and dst and the case: A cropland now, B changed, C stable."""
    own = df.filter(is_row_crop(F.col(crop_code))).select("*", category(F.col(first)).alias("src"), category(F.col(last)).alias("dst"))
    case = F.when(F.col("dst") == 6, "A").when(F.col("src") != F.col("dst"), "B").otherwise("C")
    return own.withColumn("case", case)


def case_areas(cases: DataFrame, state: str) -> DataFrame:
    """Areas of the cases and their percentages per state, with a TOTAL row."""
    sums = cases.groupBy(state).pivot("case", ["A", "B", "C"]).agg(F.sum("ha")).na.fill(0.0, ["A", "B", "C"])
    rolled = sums.rollup(state).agg(*[F.sum(c).alias(f"case_{c.lower()}") for c in "ABC"])
    total = F.col("case_a") + F.col("case_b") + F.col("case_c")
    return rolled.select(F.coalesce(state, F.lit("TOTAL")).alias("state"), "case_a", "case_b", "case_c", total.alias("total"), *[F.round(100 * F.col(f"case_{c}") / total, 1).alias(f"{c}_pct") for c in "abc"])


def transitions(cases: DataFrame) -> DataFrame:
    """Area by source and destination of the changed pixels."""
    sums = cases.filter("case = 'B'").groupBy("src", "dst").agg(F.sum("ha").alias("area"))
    return sums.select(category_name(F.col("src")).alias("source"), category_name(F.col("dst")).alias("destination"), "area")


def bucket_shares(cases: DataFrame, case: str, by: str, buckets: dict[str, str]) -> DataFrame:
    """Area per bucket of one case with its percentage of all disagreement (cases B and C)."""
    table = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair])
    lost = cases.filter("case <> 'A'").groupBy("case", by).agg(F.sum("ha").alias("area"))
    named = lost.select("case", F.coalesce(F.try_element_at(table, category_name(F.col(by))), F.lit(k.OTHER_BUCKET)).alias("bucket"), "area")
    every = F.sum("area").over(Window.partitionBy())  # a row per case and category at most
    return named.withColumn("every", every).filter(F.col("case") == case).groupBy("bucket").agg(F.sum("area").alias("area"), (100 * F.sum("area") / F.max("every")).alias("pct"))


def bucket_table(cases: DataFrame, state: str, case: str, by: str, buckets: dict[str, str]) -> DataFrame:
    """(state, bucket, area, pct): every bucket of every state, 0 where nothing falls in it; pct is of the state's disagreement (cases B and C), 0 if it has none."""
    table = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair])
    named = cases.select(state, "ha", "case", F.coalesce(F.try_element_at(table, category_name(F.col(by))), F.lit(k.OTHER_BUCKET)).alias("bucket"))
    names = [*dict.fromkeys(buckets.values()), k.OTHER_BUCKET]
    area = lambda name: F.coalesce(F.sum(F.when((F.col("case") == case) & (F.col("bucket") == name), F.col("ha"))), F.lit(0.0))
    # one row a state; its buckets are columns first, as their names are fixed
    sums = named.groupBy(state).agg(F.coalesce(F.sum(F.when(F.col("case") != "A", F.col("ha"))), F.lit(0.0)).alias("every"), F.array(*[F.struct(F.lit(n).alias("bucket"), area(n).alias("area")) for n in names]).alias("own"))
    rows = sums.select(state, "every", F.explode("own").alias("b"))
    return rows.select(state, "b.bucket", "b.area", F.when(F.col("every") > 0, 100 * F.col("b.area") / F.col("every")).otherwise(0.0).alias("pct"))


def category_change(df: DataFrame, crops: dict[str, Column]) -> DataFrame:
    """Area per crop category and cover flag in two years and the net change; ``crops``: start and end -> struct(category, flag)."""
    rows = df.select("ha", F.explode(F.array(*[F.struct(F.lit(when).alias("when"), x["category"].alias("category"), x["flag"].alias("flag")) for when, x in crops.items()])).alias("v"))
    sums = rows.groupBy("v.category", "v.flag").pivot("v.when", ["start", "end"]).agg(F.sum("ha")).na.fill(0.0, ["start", "end"])
    return sums.select("category", "flag", F.col("start").alias("start_ha"), F.col("end").alias("end_ha"), (F.col("end") - F.col("start")).alias("net_ha"))
