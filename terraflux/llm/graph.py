"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.llm.shared import discard, materialise


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a vertex on the smallest vertex around it."""
    near = _both_ways(links)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a vertex and its smaller neighbours on the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``links`` (u, v: long); the component is its smallest vertex.

    Each round is a few joins on vertices with map-side minima; links keep their number or shrink.
    Rounds grow with the logarithm of the longest path. Null ends and loops are ignored; no links
    give no rows. Every round is written to the shared folder, so a lost executor costs one round.
    """
    links = links.filter("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct()
    now = materialise(links, "links")
    seen: tuple | None = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        after = materialise(_small_star(_large_star(now).filter("u <> v").distinct()), "links")
        discard(now)
        now = after
    stars = now.select(F.greatest("u", "v").alias("vertex"), F.least("u", "v").alias("component"))
    roots = stars.select(F.col("component").alias("vertex"), "component").distinct()
    return stars.union(roots)
