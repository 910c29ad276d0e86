"""Per-pixel carbon and emissions, tonnes a hectare. Unknown inputs are NULL; each function says what they do."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraflux import factors as k
from terraflux.functions.nulls import in_ranges, look_up, or_zero, positive_part

_zones = lambda values: {i: float(v) for i, v in enumerate(values, 1)}
DEAD_FACTOR = _zones([k.CARBON_DEAD_WOOD * w + k.CARBON_LITTER * x for w, x in zip(k.DEAD_WOOD, k.LITTER, strict=True)])
SOIL_LOSS = _zones([(1 - f) * k.CO2_PER_C for f in k.SOIL_FACTOR])


def land_class(code: Column) -> Column:
    return in_ranges(code, k.LAND_CLASS_RANGES)


def aboveground_carbon(agb: Column) -> Column:
    return agb * k.CARBON_LIVE


def belowground_carbon(agb: Column, bgb: Column) -> Column:
    """Of the root biomass; of a share of the biomass above where roots are 0. Unknown roots count as 0."""
    return k.CARBON_LIVE * (or_zero(bgb > 0, bgb) + k.ROOT_TO_SHOOT * F.when(bgb == 0, agb).otherwise(0.0))


def dead_organic_carbon(agb: Column, zone: Column) -> Column:
    """0 in unknown zones whatever the biomass."""
    factor = look_up(zone, DEAD_FACTOR, None)
    return F.when(factor.isNull(), F.lit(0.0)).otherwise(agb * factor)


def grassland_carbon(zone: Column) -> Column:
    return look_up(zone, _zones(k.GRASSLAND_CARBON), 0.0)


def forest_carbon(agb: Column, bgb: Column, zone: Column) -> Column:
    return aboveground_carbon(agb) + belowground_carbon(agb, bgb) + dead_organic_carbon(agb, zone)


def vegetation_carbon(cls: Column, forest: Column, grassland: Column) -> Column:
    """Stock of a land class: of forest, of grassland, else 0."""
    return F.when(cls == k.FOREST, forest).when(cls == k.GRASSLAND, grassland).otherwise(0.0)


def vegetation_emissions(before: Column, after: Column) -> Column:
    """Carbon lost from ``before`` to ``after`` as CO2; gains are 0, unknown stays unknown."""
    return positive_part(before - after) * k.CO2_PER_C


def mineral_soil_emissions(zone: Column, soc: Column) -> Column:
    return look_up(zone, SOIL_LOSS, 0.0) * soc


def soil_emissions(before: Column, after: Column, peat: Column, mineral: Column) -> Column:
    """Of forest or grassland that became something else: a pulse on peat, a share of the carbon on mineral soil, 0 where peat is unknown."""
    natural = [k.FOREST, k.GRASSLAND]
    emissive = before.isin(natural) & ~after.isin(natural)
    return F.when(emissive & (peat == 1), k.PEAT_PULSE).when(emissive & (peat == 0), mineral).otherwise(0.0)


def peat_occupation(peat: Column, latest: Column) -> Column:
    """Yearly emissions of drained peat; the unmapped class counts as drained, unknown peat on drained land is unknown."""
    undrained = latest.isin([k.FOREST, k.GRASSLAND, k.OCEAN, k.SNOW_ICE, k.WATER])
    return F.when(undrained, F.lit(0.0)).otherwise(peat * k.PEAT_OCCUPATION)


def discounted(by_span: dict[tuple[int, int], Column]) -> Column:
    """20-year linear discount; unknown if any span is."""
    return reduce(add, [by_span[span] * weight for span, weight in k.SPAN_WEIGHTS.items()])


def forest_part(before: Column, peat: Column, vegetation: Column, soil: Column) -> Column:
    """Emissions of a span due to lost forest: its vegetation, and its soil unless it is peat (unknown is not)."""
    forest = before == k.FOREST
    return or_zero(forest, vegetation) + or_zero(forest & ~peat.eqNullSafe(F.lit(1)), soil)


def peat_conversion_part(peat: Column, soil: Column) -> Column:
    return or_zero(peat == 1, soil)
