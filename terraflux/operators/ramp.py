"""Linear-ramp model of peat emissions after drainage, fitted to reference curves (site, t, e_ref)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YEARS = 20


def _share() -> Column:
    """The ramp's shares of 20 years: (21 - t) / 210."""
    return (YEARS + 1 - F.col("t")) / (YEARS * (YEARS + 1) / 2)


def fit(curves: DataFrame, e_lm: float) -> DataFrame:
    """Least-squares height of the ramp over the constant ``e_lm`` per site over years 1..20, and the fit's root mean square error.

    One shuffle by site and no join: curves are often made on the spot from a row a site, which the optimiser takes for a small table to broadcast.
    """
    own = curves.filter(F.col("t").between(1, YEARS) & F.col("site").isNotNull()).withColumn("w", _share())
    site = Window.partitionBy("site")
    height = F.sum((F.col("e_ref") - e_lm) * F.col("w")).over(site) / F.sum(F.col("w") * F.col("w")).over(site)
    rest = F.col("p_luc") * F.col("w") + e_lm - F.col("e_ref")
    return own.withColumn("p_luc", height).groupBy("site").agg(F.max("p_luc").alias("p_luc"), F.sqrt(F.avg(rest * rest)).alias("rmse"))


def cumulative(curves: DataFrame, heights: DataFrame, e_lm: float, at: tuple[int, ...] = (10, 20, 40, 50, 100)) -> DataFrame:
    """Cumulative reference and model emissions per site at years ``at`` and their ratio.

    The model is linear in the height, so a curve is one row of sums before it meets its height: partial sums are shuffled, not years, and
    rows of sites are merged, never broadcast.
    """
    t = F.col("t")
    parts = {"ref": lambda a: F.sum(F.when(t <= a, F.col("e_ref"))), "share": lambda a: F.sum(F.when((t <= a) & (t <= YEARS), _share()))}
    parts |= {"ramp": lambda a: F.count_if((t <= a) & (t <= YEARS)), "flat": lambda a: F.count_if((t <= a) & (t > YEARS)), "rows": lambda a: F.count_if(t == a)}
    sums = curves.groupBy("site").agg(*[f(a).alias(f"{name}_{a}") for a in at for name, f in parts.items()])

    def year(a: int) -> Column:
        ramp, flat = F.col("p_luc") * F.col(f"share_{a}") + e_lm * F.col(f"ramp_{a}"), F.when(F.col(f"flat_{a}") > 0, e_lm * F.col(f"flat_{a}"))
        row = F.struct(F.lit(a).alias("t"), F.col(f"ref_{a}").alias("ref"), F.coalesce(ramp + flat, ramp, flat).alias("model"))
        return F.array_repeat(row, F.col(f"rows_{a}").cast("int"))

    own = sums.join(heights.select("site", "p_luc").hint("merge"), "site").select("site", F.explode(F.flatten(F.array(*map(year, at)))).alias("y")).select("site", "y.*")
    return own.select("site", "t", "ref", "model", (F.col("model") / F.col("ref")).alias("ratio"))
