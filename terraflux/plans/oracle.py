"""DuckDB SQL for the registered queries, on the same derived tables; written apart from the Spark operators."""

from __future__ import annotations

import math

from terraflux import factors as k
from terraflux.factors import SPANS, YEARS
from terraflux.operators.emit import PUBLISHED
from terraflux.operators.statistical import LAYERS, SHARE_SPANS
from terraflux.plans import fixtures as fx
from terraflux.plans import queries as q
from terraflux.plans.fixtures import M, N

PX = f"({fx.PIXELS_SQL}) px"
ZONED = f"({fx.ZONED_SQL}) zp"
TILES = f"(SELECT {', '.join(q.TILES)} FROM (SELECT {', '.join(q.CORNERS)} FROM orders)) t"
WANTED = f"(SELECT {', '.join(q.WANTED_TILES)} FROM (SELECT {', '.join(q.WANTED)} FROM customer)) w"
D = 10 / N
_LAT = "CASE WHEN substr(tile_id, 3, 1) = 'N' THEN 1 ELSE -1 END * CAST(substr(tile_id, 1, 2) AS INTEGER)"
_LON = "CASE WHEN substr(tile_id, 8, 1) = 'E' THEN 1 ELSE -1 END * CAST(substr(tile_id, 5, 3) AS INTEGER)"
PIXEL_LAT = f"({_LAT} - (row + 0.5) * CAST({D!r} AS DOUBLE))"
PIXEL_LON = f"({_LON} + (col + 0.5) * CAST({D!r} AS DOUBLE))"


def area(lat: str, degrees: float) -> str:
    return f"(cos(radians({lat})) * CAST({(degrees * (k.MERIDIAN_M / 360)) * (degrees * (k.EQUATOR_M / 360)) / 10_000!r} AS DOUBLE))"


HA = area(PIXEL_LAT, D)


def ranges(x: str, values: list[tuple[int, int, int]], default: int) -> str:
    return "CASE " + " ".join(f"WHEN {x} BETWEEN {a} AND {b} THEN {v}" for a, b, v in values) + f" ELSE {default} END"


def by_zone(values: list[float]) -> str:
    return "CASE zone " + " ".join(f"WHEN {i} THEN CAST({float(v)!r} AS DOUBLE)" for i, v in enumerate(values, 1)) + " END"


def r(x: str, digits: int, name: str | None = None, bias: float = 1e-9) -> str:
    return f"round({x} + {bias}, {digits}) + 0.0 AS {name or x}"


CLASS = {y: ranges(f"lc_{y}", k.LAND_CLASS_RANGES, 0) for y in YEARS}
ABOVE = "agb * 0.47"
BELOW = "0.47 * (CASE WHEN bgb > 0 THEN bgb ELSE 0 END + 0.25 * CASE WHEN bgb = 0 THEN agb ELSE 0 END)"
_DEAD = by_zone([k.CARBON_DEAD_WOOD * w + k.CARBON_LITTER * x for w, x in zip(k.DEAD_WOOD, k.LITTER, strict=True)])
DEAD = f"CASE WHEN {_DEAD} IS NULL THEN 0.0 ELSE agb * {_DEAD} END"
GRASS = f"coalesce({by_zone(k.GRASSLAND_CARBON)}, 0.0)"
SOIL = f"coalesce({by_zone([(1 - f) * k.CO2_PER_C for f in k.SOIL_FACTOR])}, 0.0) * soc"


def emitted(source: str, ha: str = HA) -> str:
    """Nested selects: classes, carbon, spans, totals, split."""
    carbon = [f"CASE class_{y} WHEN 3 THEN {ABOVE} + {BELOW} + {DEAD} WHEN 4 THEN {GRASS} ELSE 0.0 END AS carbon_{y}" for y in YEARS]
    spans = [f"CASE WHEN carbon_{a} - carbon_{b} > 0 THEN carbon_{a} - carbon_{b} WHEN carbon_{a} - carbon_{b} IS NOT NULL THEN 0.0 END * CAST({k.CO2_PER_C!r} AS DOUBLE) AS vegetation_{a}_{b}" for a, b in SPANS]
    lost = lambda a, b: f"class_{a} IN (3, 4) AND class_{b} NOT IN (3, 4)"
    spans += [f"CASE WHEN {lost(a, b)} AND peat = 1 THEN 621.0 WHEN {lost(a, b)} AND peat = 0 THEN {SOIL} ELSE 0.0 END AS soil_{a}_{b}" for a, b in SPANS]
    spans += ["CASE WHEN class_2020 IN (3, 4, 5, 6, 7) THEN 0.0 ELSE 37.3 * peat END AS occupation", f"{ha} AS ha"]
    totals = [f"vegetation_{a}_{b} + soil_{a}_{b} AS emissions_{a}_{b}" for a, b in SPANS]
    totals += [f"CASE WHEN class_{a} = 3 THEN vegetation_{a}_{b} ELSE 0 END + CASE WHEN class_{a} = 3 AND peat IS DISTINCT FROM 1 THEN soil_{a}_{b} ELSE 0 END AS forest_{a}_{b}" for a, b in SPANS]
    totals += [f"CASE WHEN peat = 1 THEN soil_{a}_{b} ELSE 0 END AS peat_conversion_{a}_{b}" for a, b in SPANS]
    weigh = lambda p: " + ".join(f"{p}_{a}_{b} * {w}" for (a, b), w in k.SPAN_WEIGHTS.items())
    s = f"SELECT *, {', '.join(f'{x} AS class_{y}' for y, x in CLASS.items())} FROM {source}"
    for more in (carbon, spans, totals, [f"{weigh('emissions')} + occupation AS per_ha", f"{weigh('forest')} AS forest_per_ha", f"{weigh('peat_conversion')} AS peat_conversion_per_ha"]):
        s = f"SELECT *, {', '.join(more)} FROM ({s})"
    return s


def from_emitted(names: list[str]) -> str:
    return f"SELECT o, {', '.join(r(n, 6) for n in names)} FROM ({emitted(PX)})"


def cols(prefix: str) -> list[str]:
    return [f"{prefix}_{a}_{b}" for a, b in SPANS]


def spread(source: str, n: int, m: int) -> str:
    """Fine rows beside the coarse cells that they meet, with the integer overlap as weight."""
    w = lambda x, kk: f"(least(({x} + 1) * {m}, ({kk} + 1) * {n}) - greatest({x} * {m}, {kk} * {n}))"
    grid = f"(SELECT unnest(range({m + 1})) AS v)"
    return f"SELECT s.*, kr.v AS crow, kc.v AS ccol, CAST({w('s.row', 'kr.v')} * {w('s.col', 'kc.v')} AS DOUBLE) AS w FROM ({source}) s JOIN {grid} kr ON {w('s.row', 'kr.v')} > 0 JOIN {grid} kc ON {w('s.col', 'kc.v')} > 0"


def spread_over_all(source: str, n: int, m: int) -> str:
    """``spread`` with no last coarse cell: those between the edges of a fine row and column."""
    w = lambda x, kk: f"(least((CAST({x} AS BIGINT) + 1) * {m}, ({kk} + 1) * {n}) - greatest(CAST({x} AS BIGINT) * {m}, {kk} * {n}))"
    near = lambda x: f"unnest(range(CAST(floor(CAST({x} AS BIGINT) * {m} / {n}) AS BIGINT), CAST(floor((CAST({x} AS BIGINT) + 1) * {m} / {n}) AS BIGINT) + 1))"
    met = f"SELECT *, {near('col')} AS ccol FROM (SELECT *, {near('row')} AS crow FROM ({source}))"
    return f"SELECT *, CAST({w('row', 'crow')} * {w('col', 'ccol')} AS DOUBLE) AS w FROM ({met}) WHERE {w('row', 'crow')} > 0 AND {w('col', 'ccol')} > 0"


def averaged(source: str, names: list[str], n: int = N) -> str:
    mean = lambda x: f"sum({x} * w) / sum(CASE WHEN {x} IS NOT NULL THEN w END) AS {x}"
    return f"SELECT tile_id, CAST(crow AS INTEGER) AS crow, CAST(ccol AS INTEGER) AS ccol, {', '.join(map(mean, names))} FROM ({spread(source, n, M)}) GROUP BY tile_id, crow, ccol"


# pixels of four tiles of 400 a side, and the nations as polygons in them
WIDE = f"({fx.WIDE_SQL}) px"
_WIDE_LAT, _WIDE_LON = f"({_LAT} - (row + 0.5) * CAST(0.025 AS DOUBLE))", f"({_LON} + (col + 0.5) * CAST(0.025 AS DOUBLE))"
WIDE_EMITTED = emitted(WIDE, area(_WIDE_LAT, 0.025))


def within(points: str, lon: str, lat: str) -> str:
    """Zone of each point (tile_id, row, col) that is in a nation, by counting the edges to its east, part by part."""
    return f"""SELECT DISTINCT zone_id, tile_id, row, col FROM (
  SELECT zone_id, part, tile_id, row, col, count(*) AS n FROM (SELECT tile_id, row, col, {lon} AS px, {lat} AS py FROM {points}) p JOIN ({fx.NATION_EDGES_SQL}) e
    ON py >= least(y1, y2) AND py < greatest(y1, y2) AND x1 + (py - y1) / (y2 - y1) * (x2 - x1) > px GROUP BY ALL) WHERE n % 2 = 1"""


# all pixels of the region, 1600 a side, that some zone may hold: eight tiles from 100 W, 50 N
_ALL_TILES = "SELECT concat(CAST(lat AS VARCHAR), 'N_', lpad(CAST(-lon AS VARCHAR), 3, '0'), 'W') AS tile_id FROM (SELECT unnest([20, 30, 40, 50]) AS lat) CROSS JOIN (SELECT unnest([-100, -90, -80, -70]) AS lon)"
ALL_WIDE = f"(SELECT tile_id, r.v AS row, k.v AS col FROM ({_ALL_TILES}) CROSS JOIN (SELECT unnest(range(400)) AS v) r CROSS JOIN (SELECT unnest(range(400)) AS v) k) px"
ZONE_COVER = f"""SELECT zone_id, tile_id, count(*) FILTER (n = 2500) AS whole_blocks, CAST(sum(n) AS BIGINT) AS pixels
FROM (SELECT zone_id, tile_id, row // 50 AS a, col // 50 AS b, count(*) AS n FROM ({within(ALL_WIDE, _WIDE_LON, _WIDE_LAT)}) GROUP BY ALL) GROUP BY ALL"""


_WHOLE = f"SELECT zone_id, tile_id, row // 50 AS a, col // 50 AS b FROM ({within(ALL_WIDE, _WIDE_LON, _WIDE_LAT)}) GROUP BY ALL HAVING count(*) = 2500"
_UP = lambda below: f"SELECT zone_id, tile_id, a // 2 AS a, b // 2 AS b FROM {below} GROUP BY ALL HAVING count(*) = 4"
_KEPT = " UNION ALL ".join(f"SELECT zone_id, {i} AS level FROM w{i} AS x WHERE NOT EXISTS (SELECT 1 FROM w{i + 1} AS y WHERE y.zone_id = x.zone_id AND y.tile_id = x.tile_id AND y.a = x.a // 2 AND y.b = x.b // 2)" for i in range(4))
QUADTREE = f"WITH w0 AS ({_WHOLE}), w1 AS ({_UP('w0')}), w2 AS ({_UP('w1')}), w3 AS ({_UP('w2')}), w4 AS ({_UP('w3')}) SELECT zone_id, level, count(*) AS squares, CAST(sum(pow(4, level)) AS BIGINT) AS blocks FROM ({_KEPT}) GROUP BY ALL"


def layer_source(emitted_: str) -> str:
    return f"SELECT tile_id, row, col, CAST(peat AS DOUBLE) AS peat_fraction, {', '.join(f'CASE WHEN class_2020 = 2 THEN {x} ELSE 0 END AS {x}' for x in LAYERS)} FROM ({emitted_})"


COARSE = averaged(layer_source(emitted(PX)), ["peat_fraction", *LAYERS])

_GROUP = k.group_of()
CROPS = "(VALUES " + ", ".join(f"('{name}', '{code}', '{_GROUP.get(code, (code, 0))[0]}', '{k.RENAMED_2020.get(code, code)}', {repr(_GROUP[code][0]) if code in _GROUP else 'NULL'}, {_GROUP[code][1] if code in _GROUP else 'NULL'})" for name, code in k.STATISTICAL_CROPS.items()) + ") AS k(crop, c05, c00, c20, grp, siblings)"
PARTS = "(VALUES " + ", ".join(f"('{g}', '{p}')" for g, parts in k.GROUPS.items() for p in parts) + ") AS g(grp, part)"
SHARED = ", ".join(f"'{x}'" for x in k.SHARED)
STATS = f"""st AS ({fx.STATISTICS_SQL}),
cells AS (SELECT DISTINCT cell FROM st),
ref AS (SELECT cell, grp, sum(area_ha) AS total FROM st JOIN {PARTS} ON st.crop = g.part WHERE year = 2005 GROUP BY cell, grp),
hz AS (
  SELECT cells.cell, y.year, k.crop, k.c05,
    coalesce(s.area_ha, 0) * f.share AS area_ha, coalesce(s.production_mt, 0) * f.share AS production_mt
  FROM cells CROSS JOIN {CROPS} CROSS JOIN (VALUES (2000), (2005), (2010), (2020)) AS y(year)
  LEFT JOIN ref ON ref.cell = cells.cell AND ref.grp = k.grp
  LEFT JOIN st b ON b.cell = cells.cell AND b.year = 2005 AND b.crop = k.c05
  LEFT JOIN st s ON s.cell = cells.cell AND s.year = y.year AND s.crop = CASE y.year WHEN 2000 THEN k.c00 WHEN 2020 THEN k.c20 ELSE k.c05 END
  CROSS JOIN LATERAL (SELECT CASE WHEN y.year <> 2000 OR k.grp IS NULL THEN 1.0::DOUBLE WHEN coalesce(ref.total, 0) > 0 THEN coalesce(b.area_ha, 0) / ref.total ELSE 1.0::DOUBLE / k.siblings END AS share) f),
sp AS (SELECT * FROM (VALUES {', '.join(f'({a}, {b})' for a, b in SHARE_SPANS)}) AS t(before, after)),
ex AS (
  SELECT a.cell, a.crop, sp.before, sp.after, greatest(b.area_ha - a.area_ha, 0) AS expansion
  FROM sp JOIN hz a ON a.year = sp.before JOIN hz b ON b.year = sp.after AND b.cell = a.cell AND b.crop = a.crop),
full_st AS (
  SELECT cells.cell, y.year, c.crop, coalesce(st.area_ha, 0) AS area_ha FROM cells CROSS JOIN (VALUES (2000), (2005), (2010), (2020)) AS y(year) CROSS JOIN (SELECT DISTINCT crop FROM st) c
  LEFT JOIN st ON st.cell = cells.cell AND st.year = y.year AND st.crop = c.crop),
common AS (
  SELECT a.cell, sp.before, sp.after, sum(greatest(b.area_ha - a.area_ha, 0)) AS x
  FROM sp JOIN full_st a ON a.year = sp.before AND a.crop IN ({SHARED}) JOIN full_st b ON b.year = sp.after AND b.cell = a.cell AND b.crop = a.crop GROUP BY ALL),
pool AS (SELECT cell, year, sum(area_ha) AS x FROM full_st WHERE crop NOT IN ({SHARED}) GROUP BY ALL),
total AS (
  SELECT a.cell, sp.before, sp.after, coalesce(c.x, 0) + greatest(b.x - a.x, 0) AS total
  FROM sp JOIN pool a ON a.year = sp.before JOIN pool b ON b.year = sp.after AND b.cell = a.cell LEFT JOIN common c ON c.cell = a.cell AND c.before = sp.before AND c.after = sp.after),
sh AS (SELECT ex.*, total, CASE WHEN total > 0 THEN expansion / total ELSE 0 END AS share FROM ex JOIN total USING (cell, before, after)),
wp AS (SELECT cell, crop, sum(production_mt * CASE year WHEN 2000 THEN 0.03125 WHEN 2005 THEN 0.125 WHEN 2010 THEN 0.46875 WHEN 2020 THEN 0.375 END) AS production_mt FROM hz GROUP BY cell, crop)"""

_share = lambda a, b: f"max(CASE WHEN before = {a} AND after = {b} THEN share END) AS share_{a}_{b}"
_weigh = lambda p: " + ".join(f"{w} * {p}_{a}_{b} * ha * share_{k.STATISTICS_SPAN[a, b][0]}_{k.STATISTICS_SPAN[a, b][1]}" for (a, b), w in k.SPAN_WEIGHTS.items())


def rolled(cell: str, coarse: str, homes: str) -> str:
    """The statistical roll-up of coarse layers, numbered by ``cell``, to the zones of ``homes`` (cell, admin_id)."""
    return f"""{STATS},
layers AS (SELECT {cell} AS cell, {area(f'({_LAT} - (crow + 0.5) * CAST({10 / M!r} AS DOUBLE))', 10 / M)} AS ha, * FROM ({coarse})),
wide AS (SELECT cell, crop, {', '.join(_share(a, b) for a, b in SHARE_SPANS)} FROM sh GROUP BY cell, crop),
homes AS ({homes}),
rolled AS (
  SELECT admin_id, w.crop AS crop_name, coalesce(sum(l.area_ha), 0) AS crop_hectares, coalesce(sum({_weigh('forest')}), 0) AS forest_emissions_mt,
    coalesce(sum({_weigh('peat_conversion')}), 0) AS peatland_conversion_emissions_mt, coalesce(sum(l.area_ha * peat_fraction), 0) AS peatland_crop_hectares,
    coalesce(sum(occupation * ha * share_2000_2020), 0) AS peatland_occupation_emissions_mt, coalesce(sum({_weigh('emissions')} + occupation * ha * share_2000_2020), 0) AS emissions_mt,
    coalesce(sum(wp.production_mt), 0) AS production_mt
  FROM wide w JOIN {CROPS} ON k.crop = w.crop LEFT JOIN st l ON l.cell = w.cell AND l.year = 2020 AND l.crop = k.c20
  JOIN wp ON wp.cell = w.cell AND wp.crop = w.crop JOIN layers ON layers.cell = w.cell JOIN homes ON homes.cell = w.cell GROUP BY admin_id, w.crop)"""


ROLLED = rolled("CASE WHEN tile_id = '50N_100W' THEN 0 ELSE 90 END + crow * 3 + ccol + 1", COARSE, f"SELECT CAST(s_suppkey AS INTEGER) AS cell, admin_id FROM supplier JOIN ({fx.PROVINCES_SQL}) ON s_nationkey = n_nationkey")

_CELL = f"CASE tile_id {' '.join(f'WHEN {t!r} THEN {i * 900}' for i, t in enumerate(['50N_100W', '50N_090W', '40N_100W', '40N_090W']))} END + row * 30 + col + 1"
_CENTRES = within("(SELECT DISTINCT tile_id, crow AS row, ccol AS col FROM wide_layers) px", f"({_LON} + (col + 0.5) * CAST({10 / M!r} AS DOUBLE))", f"({_LAT} - (row + 0.5) * CAST({10 / M!r} AS DOUBLE))")
ROLLED_BY_POLYGON = f"wide_layers AS ({averaged(layer_source(WIDE_EMITTED), ['peat_fraction', *LAYERS], 400)}), " + rolled(_CELL.replace("row", "crow").replace("col + 1", "ccol + 1"), "SELECT * FROM wide_layers", f"SELECT {_CELL} AS cell, zone_id AS admin_id FROM ({_CENTRES})")
DIRECT_CODES = "(VALUES " + ", ".join(f"({code}, '{name}')" for name, codes in k.DIRECT_CROPS.items() for code in codes) + ") AS dc(crop_code, crop_name)"
_DIRECT_SUMS = {
    "crop_hectares": "ha", "peatland_crop_hectares": "CASE WHEN peat = 1 THEN ha END", "peatland_occupation_emissions_mt": "occupation * ha",
    "emissions_mt": "per_ha * ha", "forest_emissions_mt": "forest_per_ha * ha", "peatland_conversion_emissions_mt": "peat_conversion_per_ha * ha",
}
DIRECT = f"""prov AS ({fx.PROVINCES_SQL}),
hit AS (SELECT e.*, crop_name FROM ({emitted(ZONED)}) e JOIN {DIRECT_CODES} ON e.crop_code = dc.crop_code WHERE class_2020 = 2),
direct AS (
  SELECT z.admin_id, n.crop_name, {', '.join(f'coalesce(sum({x}), 0) AS {m}' for m, x in _DIRECT_SUMS.items())}
  FROM prov z CROSS JOIN (SELECT DISTINCT crop_name FROM {DIRECT_CODES}) n LEFT JOIN hit ON hit.admin_id = z.admin_id AND hit.crop_name = n.crop_name GROUP BY z.admin_id, n.crop_name)"""
_DIRECT_AGG = ", ".join(f"coalesce(sum({x}), 0) AS {m}" for m, x in _DIRECT_SUMS.items())
BY_POLYGON = f"""prov AS ({fx.PROVINCES_SQL}),
home AS ({within(WIDE, _WIDE_LON, _WIDE_LAT)}),
hit AS (SELECT e.*, home.zone_id AS admin_id, crop_name FROM ({WIDE_EMITTED}) e JOIN home USING (tile_id, row, col) JOIN {DIRECT_CODES} ON e.crop_code = dc.crop_code WHERE class_2020 = 2),
direct AS (
  SELECT z.admin_id, n.crop_name, {_DIRECT_AGG}
  FROM prov z CROSS JOIN (SELECT DISTINCT crop_name FROM {DIRECT_CODES}) n LEFT JOIN hit ON hit.admin_id = z.admin_id AND hit.crop_name = n.crop_name GROUP BY z.admin_id, n.crop_name)"""
_POUNDS = "CASE commodity_desc " + " ".join(f"WHEN '{x}' THEN {v}" for x, v in k.LB_PER_BUSHEL.items()) + " END"
YIELDS = f"""states AS (SELECT n_nationkey + 1 AS fips, admin_id FROM ({fx.PROVINCES_SQL}) WHERE n_nationkey <> 24),
yields AS (
  SELECT admin_id, commodity_desc AS crop_name, year, CAST(replace(value, ',', '') AS DOUBLE) * {_POUNDS} * CAST(0.45359237 AS DOUBLE) / CAST(0.40468564 AS DOUBLE) AS yield_kg_per_ha
  FROM ({fx.SURVEY_SQL}) JOIN states ON fips = state_fips_code WHERE value NOT IN ('(D)', '(Z)', '(S)', '(NA)')),
mean AS (
  SELECT admin_id, CASE crop_name WHEN 'CORN' THEN 'MAIZE' WHEN 'SOYBEANS' THEN 'SOYBEAN' ELSE crop_name END AS crop_name, avg(yield_kg_per_ha) AS yield_kg_per_ha
  FROM yields WHERE year IN (2017, 2018, 2019, 2020) GROUP BY ALL)"""
_SUMS = ["crop_hectares", "forest_emissions_mt", "peatland_crop_hectares", "peatland_conversion_emissions_mt", "peatland_occupation_emissions_mt", "emissions_mt", "production_kg"]
_ratio = lambda op: f"CASE WHEN crop_hectares {op} 0 THEN production_kg / crop_hectares END AS yield_kg_per_ha, CASE WHEN production_kg {op} 0 THEN emissions_mt * 1000 / production_kg END AS emissions_factor_kgco2e_per_kg, CASE WHEN emissions_mt {op} 0 THEN peatland_occupation_emissions_mt / emissions_mt END AS peatland_occupation_fraction"


def provincial(source: str, method: str, production: str) -> str:
    """Rows of ``source`` with production and ratios."""
    sums = ", ".join(x for x in _SUMS if x != "production_kg")
    return f"SELECT *, {_ratio('>')} FROM (SELECT 'PROVINCIAL' AS admin_level, crop_name, jurisdiction_name, '{method}' AS methodology, admin_id, {sums}, {production} AS production_kg FROM {source} JOIN (SELECT admin_id, jurisdiction_name FROM ({fx.PROVINCES_SQL})) USING (admin_id))"


DIRECT_ROWS = provincial("direct LEFT JOIN mean USING (admin_id, crop_name)", "JURISDICTIONAL_DIRECT", "crop_hectares * yield_kg_per_ha")
STATISTICAL_ROWS = provincial("rolled", "STATISTICAL", "production_mt * 1000")


def national(rows: str) -> str:
    sums = ", ".join(f"coalesce(sum({x}), 0) AS {x}" for x in _SUMS)
    return f"SELECT *, {_ratio('<>')} FROM (SELECT 'NATIONAL' AS admin_level, crop_name, national_name AS jurisdiction_name, methodology, iso AS admin_id, {sums} FROM {rows} p JOIN (SELECT DISTINCT iso, national_name FROM ({fx.PROVINCES_SQL})) ON iso = substr(p.admin_id, 1, 3) GROUP BY ALL)"


def regional(rows: str) -> str:
    sums = ", ".join(f"coalesce(sum({x}), 0) AS {x}" for x in _SUMS)
    return f"SELECT *, {_ratio('<>')} FROM (SELECT 'REGIONAL' AS admin_level, crop_name, region AS jurisdiction_name, methodology, region AS admin_id, {sums} FROM {rows} p JOIN (SELECT iso, {q.REGION_OF} AS region FROM (SELECT DISTINCT iso FROM ({fx.PROVINCES_SQL}))) ON iso = substr(p.admin_id, 1, 3) WHERE region IS NOT NULL GROUP BY ALL)"


FACTORS = "admin_level, crop_name, jurisdiction_name, methodology, admin_id, " + ", ".join([*(r(x, 1, bias=0.003) for x in _SUMS), *(r(x, 4) for x in ("yield_kg_per_ha", "emissions_factor_kgco2e_per_kg", "peatland_occupation_fraction"))])

AREAS = f"(SELECT *, {HA} AS ha FROM {ZONED}) a"


def row_crop(x: str) -> str:
    """Herbaceous crops without hay (36, 37) and fallow (61), as ranges of codes."""
    inside = " OR ".join(f"{x} BETWEEN {a} AND {b}" for a, b in ((1, 6), (10, 14), (21, 35), (38, 39), (41, 54), (56, 57), (205, 209), (213, 214), (216, 216), (218, 219), (221, 223), (225, 241), (243, 249), (254, 254)))
    return f"coalesce({inside}, false)"


ROW_CROP = row_crop("crop_code")
_part = lambda x: f"coalesce(sum(CASE WHEN {x} THEN ha END), 0)"
CONFUSION = f"""SELECT *, crop_cover + crop_other AS crop_total, CASE WHEN crop_cover + crop_other > 0 THEN 100 * crop_cover / (crop_cover + crop_other) END AS confirm_pct FROM (
  SELECT admin_id, {_part('rc AND cv')} AS crop_cover, {_part('rc AND NOT cv')} AS crop_other, {_part('NOT rc AND cv')} AS other_cover, {_part('NOT rc AND NOT cv')} AS other_other
  FROM (SELECT *, {ROW_CROP} AS rc, coalesce(lc_2020 = 244, false) AS cv FROM {AREAS}) GROUP BY admin_id)"""
CATEGORY = {y: ranges(f"lc_{y}", k.CATEGORY_RANGES, 8) for y in (2000, 2020)}
CASES = f"SELECT *, CASE WHEN dst = 6 THEN 'A' WHEN src <> dst THEN 'B' ELSE 'C' END AS kind FROM (SELECT *, {CATEGORY[2000]} AS src, {CATEGORY[2020]} AS dst FROM {AREAS} WHERE {ROW_CROP})"
_name = lambda x: "CASE " + x + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(k.CATEGORY_NAMES)) + " END"
TRANSITIONS = f"SELECT {_name('src')} AS source, {_name('dst')} AS destination, round(sum(ha) + 1e-9, 3) + 0.0 AS area FROM ({CASES}) WHERE kind = 'B' GROUP BY src, dst"


def buckets(kind: str, by: str, names: dict[str, str]) -> str:
    bucket = f"CASE {_name(by)} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + f" ELSE '{k.OTHER_BUCKET}' END"
    return f"SELECT bucket, {r('sum(ha)', 3, 'area')}, {r('100 * sum(ha) / any_value(every)', 3, 'pct')} FROM (SELECT {bucket} AS bucket, ha, kind, (SELECT sum(ha) FROM ({CASES}) WHERE kind <> 'A') AS every FROM ({CASES})) WHERE kind = '{kind}' GROUP BY bucket"


# all five buckets of the stable disagreement of every state with a row crop
_BUCKET = f"CASE {_name('dst')} WHEN 'built_up' THEN 'Built-up' WHEN 'short_veg' THEN 'Short vegetation' WHEN 'forest' THEN 'Forest' WHEN 'wetland_short_veg' THEN 'Wetland' WHEN 'wetland_forest' THEN 'Wetland' ELSE 'Water/bare/other' END"
BY_STATE = f"""WITH c AS (SELECT admin_id, ha, kind, {_BUCKET} AS bucket FROM ({CASES})),
t AS (SELECT admin_id, coalesce(sum(CASE WHEN kind <> 'A' THEN ha END), 0) AS every FROM c GROUP BY admin_id),
b AS (SELECT unnest(['Built-up', 'Short vegetation', 'Forest', 'Wetland', 'Water/bare/other']) AS bucket)
SELECT admin_id, bucket, {r('a', 3, 'area')}, {r('CASE WHEN every > 0 THEN 100 * a / every ELSE 0 END', 3, 'pct')}
FROM (SELECT t.admin_id, b.bucket, every, coalesce(sum(CASE WHEN kind = 'C' THEN ha END), 0) AS a FROM t CROSS JOIN b LEFT JOIN c ON c.admin_id = t.admin_id AND c.bucket = b.bucket GROUP BY ALL)"""


_COVER = lambda y: f"CAST(coalesce(lc_{y} = 244, false) AS INTEGER)"
_CROP4 = lambda x: f"CASE WHEN {row_crop(x)} THEN 1 WHEN {x} IN (36, 37) THEN 2 WHEN {x} IN (61) THEN 3 ELSE 0 END"
CHANGE = f"""SELECT category, flag, {r('s', 3, 'start_ha')}, {r('e', 3, 'end_ha')}, {r('e - s', 3, 'net_ha')} FROM (
  SELECT category, flag, coalesce(sum(CASE WHEN w = 0 THEN ha END), 0) AS s, coalesce(sum(CASE WHEN w = 1 THEN ha END), 0) AS e FROM (
    SELECT ha, 0 AS w, {_CROP4('crop_code')} AS category, {_COVER(2010)} AS flag FROM {AREAS} UNION ALL
    SELECT ha, 1, {_CROP4('(CASE WHEN o % 3 = 0 THEN 61 WHEN o % 5 = 0 THEN 36 ELSE crop_code END)')}, {_COVER(2020)} FROM {AREAS}) GROUP BY category, flag)"""

CURVES = f"(SELECT {', '.join(q.CURVE)} FROM (SELECT c_custkey AS site, unnest(range(1, 101)) AS t FROM customer))"
FIT = f"SELECT site, sum((e_ref - 37.3) * w) / sum(w * w) AS p_luc FROM (SELECT *, (21 - t) / 210.0::DOUBLE AS w FROM {CURVES} WHERE t <= 20) GROUP BY site"

# triangle against box by separating axes: the box's two and the normals of the triangle's sides
_TRIANGLE = "(SELECT zone_id, x AS x1, y AS y1, x + d AS x2, y + h AS y2, x + h AS x3, y + d + h AS y3 FROM (SELECT " + ", ".join(q.SHAPES) + " FROM supplier))"


def _axis(a: int, b: int) -> str:
    nx, ny = f"(y{a} - y{b})", f"(x{b} - x{a})"
    tri = [f"({nx} * x{i} + {ny} * y{i})" for i in (1, 2, 3)]
    box = [f"({nx} * {x} + {ny} * {y})" for x in ("lon", "(lon + 10)") for y in ("lat", "(lat + 10)")]
    return f"greatest({', '.join(tri)}) >= least({', '.join(box)}) AND least({', '.join(tri)}) <= greatest({', '.join(box)})"


TOUCHING = f"""SELECT zone_id, concat(lpad(CAST(abs(lat + 10) AS VARCHAR), 2, '0'), CASE WHEN lat + 10 >= 0 THEN 'N' ELSE 'S' END, '_', lpad(CAST(abs(lon) AS VARCHAR), 3, '0'), CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END) AS tile_id
FROM {_TRIANGLE} CROSS JOIN (SELECT unnest(range(-18, 18)) * 10 AS lon) CROSS JOIN (SELECT unnest(range(-9, 9)) * 10 AS lat)
WHERE lon >= floor(least(x1, x2, x3) / 10) * 10 AND lon < ceil(greatest(x1, x2, x3) / 10) * 10 AND lat >= floor(least(y1, y2, y3) / 10) * 10 AND lat < ceil(greatest(y1, y2, y3) / 10) * 10
  AND greatest(x1, x2, x3) >= lon AND least(x1, x2, x3) <= lon + 10 AND greatest(y1, y2, y3) >= lat AND least(y1, y2, y3) <= lat + 10 AND {_axis(1, 2)} AND {_axis(2, 3)} AND {_axis(3, 1)}"""
INSIDE = f"""SELECT DISTINCT zone_id, tile_id, row, col FROM (
  SELECT zone_id, part, tile_id, row, col, count(*) AS n FROM (SELECT tile_id, row, col, {PIXEL_LON} AS px, {PIXEL_LAT} AS py FROM {PX}) p JOIN ({fx.EDGES_SQL}) e
    ON py >= least(y1, y2) AND py < greatest(y1, y2) AND x1 + (py - y1) / (y2 - y1) * (x2 - x1) > px GROUP BY ALL) WHERE n % 2 = 1"""


def bilinear(s: int, n: int, factor: float) -> str:
    at = lambda x: f"(({x} + 0.5) * {s} / CAST({n} AS DOUBLE) - 0.5)"
    clamp = lambda x: f"greatest(0, least({x}, {s - 1}))"
    near = f"""SELECT d.*, {clamp(f"CAST(floor({at('d.row')}) AS INTEGER) + i.v")} AS sr, {clamp(f"CAST(floor({at('d.col')}) AS INTEGER) + j.v")} AS sc,
  CASE i.v WHEN 0 THEN 1 - ({at('d.row')} - floor({at('d.row')})) ELSE {at('d.row')} - floor({at('d.row')}) END * CASE j.v WHEN 0 THEN 1 - ({at('d.col')} - floor({at('d.col')})) ELSE {at('d.col')} - floor({at('d.col')}) END AS w
  FROM (SELECT DISTINCT tile_id, CAST(floor(row * CAST({factor} AS DOUBLE)) AS INTEGER) AS row, CAST(floor(col * CAST({factor} AS DOUBLE)) AS INTEGER) AS col FROM {PX}) d CROSS JOIN (VALUES (0), (1)) AS i(v) CROSS JOIN (VALUES (0), (1)) AS j(v)"""
    return f"SELECT b.tile_id, b.row, b.col, {r('sum(agb * w) / sum(CASE WHEN agb IS NOT NULL THEN w END)', 5, 'agb')} FROM ({near}) b LEFT JOIN {PX} ON px.tile_id = b.tile_id AND px.row = sr AND px.col = sc WHERE w > 0 GROUP BY b.tile_id, b.row, b.col"


WORLD = f"(SELECT row, col, CAST(max(z) AS DOUBLE) AS z FROM (SELECT {', '.join(q.WORLD)} FROM orders) GROUP BY ALL)"
# cells of the world layer in the tiles of the test grid: rows 400 to 599 from 90 N, columns 800 to 899 from 180 W
IN_TILES = f"SELECT CASE WHEN row < 500 THEN '50N_100W' ELSE '40N_100W' END AS tile_id, row % 100 AS row, col % 100 AS col, z FROM {WORLD} w WHERE row BETWEEN 400 AND 599 AND col BETWEEN 800 AND 899"


def world_bilinear() -> str:
    y, x = "((CASE tile_id WHEN '50N_100W' THEN 4000 ELSE 5000 END + row + 0.5) / CAST(10 AS DOUBLE) - 0.5)", "((8000 + col + 0.5) / CAST(10 AS DOUBLE) - 0.5)"
    near = f"""SELECT p.tile_id, p.row, p.col, greatest(400, least(599, CAST(floor({y}) AS INTEGER) + i.v)) AS sr, greatest(800, least(899, CAST(floor({x}) AS INTEGER) + j.v)) AS sc,
  CASE i.v WHEN 0 THEN 1 - ({y} - floor({y})) ELSE {y} - floor({y}) END * CASE j.v WHEN 0 THEN 1 - ({x} - floor({x})) ELSE {x} - floor({x}) END AS w
  FROM (SELECT tile_id, row, col FROM {PX}) p CROSS JOIN (VALUES (0), (1)) AS i(v) CROSS JOIN (VALUES (0), (1)) AS j(v)"""
    return f"SELECT b.tile_id, b.row, b.col, {r('sum(z * w) / sum(CASE WHEN z IS NOT NULL THEN w END)', 6, 'z')} FROM ({near}) b LEFT JOIN {WORLD} l ON l.row = sr AND l.col = sc WHERE w > 0 GROUP BY b.tile_id, b.row, b.col"


def projected() -> str:
    """Equal-area conic coordinates of pixel centres: standard parallels 29.5 and 45.5 N, origin 23 N 96 W, GRS 80."""
    a, e2 = 6378137.0, 0.00669438002290342
    e = math.sqrt(e2)
    area_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    scale = lambda d: math.cos(math.radians(d)) ** 2 / (1 - e2 * math.sin(math.radians(d)) ** 2)
    alpha = lambda d: area_of(math.sin(math.radians(d)))
    n = (scale(29.5) - scale(45.5)) / (alpha(45.5) - alpha(29.5))
    c = scale(29.5) + n * alpha(29.5)
    d = lambda v: f"CAST({v!r} AS DOUBLE)"
    s = f"sin(radians({PIXEL_LAT}))"
    alpha_sql = f"({d(1 - e2)} * ({s} / (1 - {d(e2)} * {s} * {s}) - ln((1 - {d(e)} * {s}) / (1 + {d(e)} * {s})) / {d(2 * e)}))"
    rho = f"({d(a)} * sqrt({d(c)} - {d(n)} * {alpha_sql}) / {d(n)})"
    theta = f"({d(n)} * radians({PIXEL_LON} + 96))"
    return f"SELECT tile_id, row, col, {rho} * sin({theta}) AS x, {d(a * math.sqrt(c - n * alpha(23.0)) / n)} - {rho} * cos({theta}) AS y FROM {PX}"


GRID = f"SELECT g, x0, y0, (x1 - x0) // 10 + 1 AS tiles_x, (y0 - y1) // 10 + 1 AS tiles_y FROM (SELECT g, min(lon) AS x0, max(lat) AS y0, max(lon) AS x1, min(lat) AS y1 FROM (SELECT c % 40 AS g, {_LAT} AS lat, {_LON} AS lon FROM {TILES}) GROUP BY g)"
_PATTERNS = {"one_degree": "[0-9]{2}[NS]_[0-9]{3}[EW]", "ten_degree": "[0-9]0[NS]_[0-9]{2}0[EW]", "whole_world": "world", "xyz_mercator": "[0-9]{3}X_[0-9]{3}Y_[0-9]{2}Z"}
CONTINENTS = f"(SELECT DISTINCT r_name AS continent, tile_id FROM (SELECT c_nationkey, {q.TILE} AS tile_id FROM (SELECT {', '.join(q.WANTED)} FROM customer)) JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
NATIONS = "(SELECT r_name AS continent, n_name AS iso FROM nation JOIN region ON n_regionkey = r_regionkey)"
_KIND = "CASE dataset " + " ".join(f"WHEN '{d}' THEN '{p}'" for d, p in q.DATASETS.items()) + " END"

ORACLE: dict[str, str] = {
    "tile_parse_format": f"SELECT o, tile_id, {_LAT} AS lat, {_LON} AS lon, tile_id AS formatted FROM {TILES}",
    "tile_boxes": f"SELECT o, {_LON} AS west, {_LON} + 10 AS east, {_LAT} - 10 AS south, {_LAT} AS north FROM {TILES}",
    "tile_validity": f"SELECT tile_id, {', '.join(f'regexp_full_match(tile_id, {p!r}) AS is_{n}' for n, p in _PATTERNS.items())}, count(*) AS n FROM (SELECT {', '.join(q.LABELS)} FROM (SELECT {', '.join(q.CORNERS)} FROM orders)) GROUP BY tile_id",
    "grid_from_tiles": f"SELECT *, tiles_x * 120 AS width, tiles_y * 120 AS height, {r('10 / 120.0::DOUBLE', 9, 'pixel')} FROM ({GRID})",
    "tile_offsets": f"SELECT o, t.g, tile_id, (lon - x0) // 10 * 120 AS offset_x, (y0 - lat) // 10 * 120 AS offset_y FROM (SELECT o, c % 40 AS g, tile_id, {_LAT} AS lat, {_LON} AS lon FROM {TILES}) t JOIN ({GRID}) g ON t.g = g.g",
    "world_window": f"SELECT *, tiles_x * 120 AS width, tiles_y * 120 AS height, (x0 + 180) * 12 AS window_x, (90 - y0) * 12 AS window_y, tiles_x * 120 AS window_w, tiles_y * 120 AS window_h FROM ({GRID})",
    "country_clusters": f"SELECT n.continent, n.isos, coalesce(t.tiles, '') AS tiles FROM (SELECT continent, string_agg(iso, ',' ORDER BY iso) AS isos FROM {NATIONS} GROUP BY continent) n LEFT JOIN (SELECT continent, string_agg(tile_id, ',' ORDER BY tile_id) AS tiles FROM {CONTINENTS} GROUP BY continent) t ON n.continent = t.continent",
    "continent_counts": f"SELECT n.continent, n_countries, coalesce(n_tiles, 0) AS n_tiles FROM (SELECT continent, count(*) AS n_countries FROM {NATIONS} GROUP BY continent) n LEFT JOIN (SELECT continent, count(*) AS n_tiles FROM {CONTINENTS} GROUP BY continent) t ON n.continent = t.continent",
    "pixel_area": f"SELECT o, round({PIXEL_LON}, 6) AS lon, round({PIXEL_LAT}, 6) AS lat, round({HA}, 6) AS ha FROM {PX}",
    "nodata_clean": f"SELECT l_orderkey, l_linenumber, CASE WHEN isnan(x) OR x <= -1e30 OR x = CAST('Infinity' AS DOUBLE) OR x = -9999.0 THEN NULL ELSE x END AS x FROM (SELECT {', '.join(q.RAW_VALUES)} FROM lineitem)",
    "band_stack_pivot": f"SELECT tile_id, row, col, {', '.join(f'lc_{y}' for y in YEARS)} FROM {PX}",
    "skip_existing_tiles": f"SELECT DISTINCT dataset, tile_id FROM {WANTED} EXCEPT SELECT dataset, tile_id FROM {WANTED} WHERE c_nationkey % 2 = 0",
    "missing_tiles": f"SELECT dataset, tile_id FROM {WANTED} WHERE tile_id <> 'bad' EXCEPT SELECT dataset, tile_id FROM {WANTED} WHERE c_nationkey % 3 = 1",
    "quarantine_rows": f"""SELECT DISTINCT dataset, tile_id, CASE WHEN part IS NULL THEN 'unknown dataset' WHEN NOT (CASE part {' '.join(f"WHEN '{n.upper()}' THEN regexp_full_match(tile_id, '{p}')" for n, p in _PATTERNS.items())} END) THEN 'invalid tile id' END AS reason
FROM (SELECT dataset, CASE WHEN {_KIND} = 'WHOLE_WORLD' THEN 'world' ELSE tile_id END AS tile_id, {_KIND} AS part FROM {WANTED})""",
    "raster_validation": f"SELECT o, CASE WHEN epsg IS DISTINCT FROM 4326 THEN 'not EPSG 4326' WHEN width <= 0 OR height <= 0 THEN 'empty' WHEN step_x <= 0 THEN 'x step' WHEN step_y >= 0 THEN 'y step' END AS reason FROM (SELECT {', '.join(q.RASTERS)} FROM orders)",
    "yield_parse": f"WITH {YIELDS} SELECT admin_id, crop_name, year, {r('yield_kg_per_ha', 4)} FROM yields",
    "loss_year": "SELECT o_orderkey AS o, CAST(CASE WHEN o_orderkey % 25 > 0 THEN o_orderkey % 25 + 2000 ELSE 0 END AS INTEGER) AS year FROM orders",
    "resample_nearest": f"SELECT d.tile_id, d.row, d.col, lc_2000, zone FROM (SELECT DISTINCT tile_id, CAST(floor(row * CAST(0.7 AS DOUBLE)) AS INTEGER) AS row, CAST(floor(col * CAST(0.7 AS DOUBLE)) AS INTEGER) AS col FROM {PX}) d LEFT JOIN {PX} ON px.tile_id = d.tile_id AND px.row = CAST(floor((d.row + 0.5) * 1000 / 700) AS INTEGER) AND px.col = CAST(floor((d.col + 0.5) * 1000 / 700) AS INTEGER)",
    "resample_bilinear": bilinear(N, 1700, 1.7),
    "resample_mode": f"SELECT tile_id, CAST(crow AS INTEGER) AS crow, CAST(ccol AS INTEGER) AS ccol, lc_2010 FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, crow, ccol ORDER BY lc_2010 IS NULL, w DESC, lc_2010) AS n FROM (SELECT tile_id, crow, ccol, lc_2010, sum(w) AS w FROM ({spread_over_all(f'SELECT * FROM {PX}', N, M)}) GROUP BY ALL)) WHERE n = 1",
    "resample_average": f"SELECT tile_id, crow, ccol, {r('agb', 5)}, {r('soc', 5)} FROM ({averaged(f'SELECT * FROM {PX}', ['agb', 'soc'])})",
    "downscale_weighted": f"SELECT tile_id, crow, ccol, {', '.join(r(x, 5) for x in ['peat_fraction', *LAYERS])} FROM ({COARSE})",
    "band_type_rule": f"SELECT name, CASE WHEN contains(name, '-per-ha') THEN 'INTENSIVE' WHEN suffix(name, ':ha') OR suffix(name, ':tco2e') THEN 'EXTENSIVE' ELSE 'CATEGORICAL' END AS band_type, count(*) AS n FROM (SELECT {', '.join(q.NAMES)} FROM lineitem) GROUP BY ALL",
    "pixel_merge": f"SELECT tile_id, row, col, agb, bgb, soc, peat FROM {PX}",
    "zone_spans": INSIDE,
    "zone_cover": ZONE_COVER,
    "zone_quadtree": QUADTREE,
    "few_crops_rollup": f"WITH {DIRECT}, {ROLLED} SELECT methodology, admin_id, crop_name, {r('crop_hectares', 2, bias=1e-4)}, {r('emissions_mt', 2, bias=1e-4)} FROM (SELECT 'JURISDICTIONAL_DIRECT' AS methodology, admin_id, crop_name, crop_hectares, emissions_mt FROM direct UNION ALL SELECT 'STATISTICAL', admin_id, crop_name, crop_hectares, emissions_mt FROM rolled) WHERE crop_name IN ('MAIZE', 'SOYBEAN', 'WHEAT')",
    "breakdown_by_state": BY_STATE,
    "incremental_rollup": f"WITH {BY_POLYGON} SELECT admin_id, crop_name, {', '.join(r(x, 3) for x in _DIRECT_SUMS)}, CAST(1 AS INTEGER) AS tiles_made FROM direct",
    "manifest_after_rerun": f"""WITH n AS (SELECT tile_id, count(*) AS n FROM {WIDE} GROUP BY tile_id)
SELECT 'crop-map' AS dataset, tile_id, CASE WHEN tile_id = '40N_090W' THEN 'failed' ELSE 'done' END AS status, CASE WHEN tile_id = '40N_090W' THEN 'outside of its tile' END AS reason, CASE WHEN tile_id <> '40N_090W' THEN n END AS n_rows, 1 AS run FROM n
UNION ALL SELECT 'crop-map', tile_id, 'done', NULL, n, 2 FROM n WHERE tile_id = '40N_090W'
UNION ALL SELECT 'crop-map', tile_id, 'failed', reason, NULL, run FROM (VALUES ('30N_100W', 'no pixels'), ('bad', 'invalid tile id')) t(tile_id, reason) CROSS JOIN (VALUES (1), (2)) k(run)""",
    "stage_filled_by_tile": f"SELECT tile_id, count(*) AS n, {r('sum(occupation)', 3, 'occupation')}, CASE tile_id WHEN '40N_100W' THEN 2 ELSE 1 END AS made_by_call FROM ({WIDE_EMITTED}) WHERE tile_id <> '40N_090W' GROUP BY tile_id",
    "layers_merged": f"SELECT tile_id, row, col, agb, bgb, soc, peat, crop_code FROM {PX}",
    "factor_regions": f"WITH {DIRECT}, {YIELDS}, pv AS ({DIRECT_ROWS}) SELECT {FACTORS} FROM (SELECT * FROM pv UNION ALL {national('pv')} UNION ALL {regional('pv')})",
    "observed_trace": f"WITH {DIRECT}, {YIELDS}, pv AS ({DIRECT_ROWS}) SELECT count(*) AS rows, count(*) FILTER (production_kg IS NULL) AS unmatched, CAST(0 AS BIGINT) AS not_provincial, count(*) + (SELECT count(*) FROM ({national('pv')})) AS written FROM pv",
    "direct_by_polygon": f"WITH {BY_POLYGON} SELECT admin_id, crop_name, {', '.join(r(x, 3) for x in _DIRECT_SUMS)} FROM direct WHERE admin_id LIKE 'RG1%'",
    "statistical_by_polygon": f"WITH {ROLLED_BY_POLYGON} SELECT admin_id, crop_name, {', '.join(r(x, 2, bias=1e-4) for x in [*_SUMS[:-1], 'production_mt'])} FROM rolled",
    "tiles_for_zone": TOUCHING,
    "world_layer": f"SELECT tile_id, px.row, px.col, z FROM {PX} LEFT JOIN (SELECT row, col, max(z) AS z FROM (SELECT {', '.join(q.WORLD)} FROM orders) GROUP BY ALL) w ON w.row = CAST(floor((90 - {PIXEL_LAT.replace('row', 'px.row')}) * 1800 / 180) AS INTEGER) AND w.col = CAST(floor(({PIXEL_LON.replace('col', 'px.col')} + 180) * 3600 / 360) AS INTEGER)",
    "world_layer_mode": f"SELECT tile_id, CAST(crow AS INTEGER) AS row, CAST(ccol AS INTEGER) AS col, z FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, crow, ccol ORDER BY w DESC, z) AS n FROM (SELECT tile_id, crow, ccol, z, sum(w) AS w FROM ({spread(IN_TILES, 100, M)}) GROUP BY ALL)) WHERE n = 1",
    "world_layer_average": f"SELECT tile_id, CAST(crow AS INTEGER) AS row, CAST(ccol AS INTEGER) AS col, {r('sum(z * w) / sum(w)', 6, 'z')} FROM ({spread(IN_TILES, 100, M)}) GROUP BY ALL",
    "world_layer_bilinear": world_bilinear(),
    "crop_map_nearest": f"SELECT p.tile_id, p.row, p.col, code FROM ({projected()}) p LEFT JOIN (SELECT row, col, max(code) AS code FROM (SELECT {', '.join(q.CROP_MAP)} FROM orders) GROUP BY ALL) m ON m.row = CAST(floor((3002000.0 - y) / 2500) AS INTEGER) AND m.col = CAST(floor((x + 297000.0) / 2500) AS INTEGER)",
    "clip_global_grid": f"SELECT '50N_100W' AS tile_id, CAST(i AS INTEGER) AS row, CAST(j AS INTEGER) AS col, coalesce(roots, 0.0) AS roots FROM (SELECT unnest(range(21)) AS i) CROSS JOIN (SELECT unnest(range(21)) AS j) LEFT JOIN (SELECT lat, lon, max(CASE WHEN NOT isnan(roots) THEN roots END) AS roots FROM (SELECT {', '.join(q.GLOBAL_CELLS)} FROM orders) GROUP BY ALL) g ON g.lat = 50 - 0.5 * i AND g.lon = -100 + 0.5 * j",
    "kernel_choice": "SELECT *, CASE WHEN src_x = dest_x AND src_y = dest_y THEN 'nearest' WHEN band_type = 'UNHEARD_OF' THEN 'refused: band type' WHEN src_x > dest_x AND src_y > dest_y THEN CASE band_type WHEN 'CATEGORICAL' THEN 'mode' WHEN 'INTENSIVE' THEN 'average' ELSE 'refused: sum resampling' END ELSE CASE band_type WHEN 'CATEGORICAL' THEN 'nearest' WHEN 'INTENSIVE' THEN 'bilinear' ELSE 'refused: distribution resampling' END END AS kernel FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'CATEGORICAL' WHEN 1 THEN 'INTENSIVE' WHEN 2 THEN 'EXTENSIVE' ELSE 'UNHEARD_OF' END AS band_type, o_custkey % 2 + 1 AS dest_x, o_custkey % 3 + 1 AS dest_y, o_custkey % 5 + 1 AS src_x, o_custkey % 4 + 1 AS src_y, count(*) AS n FROM orders GROUP BY ALL)",
    "scanned_source": f"SELECT tile_id, row, col, nullif(crop_code, 0) AS crop_code FROM {PX}",
    "qualified_bands": f'SELECT tile_id, row, col, agb AS "aboveground-biomass:density:agb" FROM {PX}',
    "staged_yields": f"WITH {YIELDS} SELECT admin_id, crop_name, year, {r('yield_kg_per_ha', 4)} FROM yields",
    "pasted_canvas": f"SELECT row + 50 AS row, col + 20 AS col, z FROM {WORLD} w",
    "exported_bands": f"SELECT tile_id, row, col, agb, peat FROM {PX}",
    "few_crops": f"SELECT CASE WHEN crop_code = 1 THEN 'MAIZE' WHEN crop_code = 5 THEN 'SOYBEAN' ELSE 'WHEAT' END AS crop_name, count(*) AS n FROM {PX} WHERE crop_code IN (1, 5, 22, 23, 24) GROUP BY ALL",
    "backfill_report": f"WITH {DIRECT}, {YIELDS}, pv AS ({DIRECT_ROWS}), f AS (SELECT substr(admin_id, 1, 3) AS iso, count(*) AS n_rows FROM (SELECT {FACTORS} FROM (SELECT * FROM pv UNION ALL {national('pv')})) GROUP BY 1), k AS (SELECT DISTINCT iso, national_name AS continent FROM ({fx.PROVINCES_SQL}) WHERE national_name <> 'ASIA' UNION ALL SELECT 'XX0', 'NOWHERE') SELECT k.iso, continent, coalesce(n_rows, 0) AS n_rows, n_rows IS NULL AS failed FROM k LEFT JOIN f ON f.iso = k.iso",
    "dissolved_shapes": f"SELECT concat(iso, lpad(CAST(n_nationkey AS VARCHAR), 3, '0')) AS id, concat(national_name, ' | ', n_name) AS name, CAST(count(*) AS INTEGER) AS n_rings FROM supplier JOIN ({fx.PROVINCES_SQL}) ON s_nationkey = n_nationkey GROUP BY ALL",
    "jurisdictions_of_country": f"SELECT admin_id, jurisdiction_name, count(*) AS customers FROM customer JOIN ({fx.PROVINCES_SQL}) ON c_nationkey = n_nationkey WHERE substr(admin_id, 1, 3) = 'RG2' GROUP BY ALL",
    "tile_coverage": f"SELECT coalesce(a.tile_id, b.tile_id) AS tile_id, CASE WHEN a.tile_id IS NULL THEN 'missing' WHEN b.tile_id IS NULL THEN 'extra' ELSE 'both' END AS status FROM (SELECT DISTINCT tile_id FROM {TILES} WHERE o % 3 = 0) a FULL JOIN (SELECT DISTINCT tile_id FROM {TILES} WHERE c % 4 = 1) b ON a.tile_id = b.tile_id",
    "classified_countries": "SELECT r_name AS continent, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA' GROUP BY ALL",
    "crop_codes": f"WITH st AS ({fx.STATISTICS_SQL}), tx AS (SELECT * FROM (VALUES {', '.join(map(repr, k.taxonomy()))}) AS t(year, code, label)) SELECT st.year, crop, a.label, b.code AS crop_there, {r('sum(area_ha)', 2, 'area_ha')} FROM st LEFT JOIN tx a ON a.year = st.year AND a.code = crop LEFT JOIN tx b ON b.year = 2020 AND b.label = a.label GROUP BY ALL",
    "published_emissions": f"SELECT tile_id, {', '.join(r(f'sum({x})', 3, f's{i}') for i, x in enumerate(PUBLISHED))} FROM ({emitted(PX)}) GROUP BY tile_id",
    "land_class": f"SELECT o, {', '.join(f'{x} AS class_{y}' for y, x in CLASS.items())} FROM {PX}",
    "belowground_carbon": f"SELECT o, {r(ABOVE, 6, 'above')}, {r(BELOW, 6, 'below')} FROM {PX}",
    "dead_organic_carbon": f"SELECT o, {r(DEAD, 6, 'dead')}, {r(GRASS, 6, 'grass')} FROM {PX}",
    "vegetation_emissions": from_emitted(cols("vegetation")),
    "soil_emissions": from_emitted(cols("soil")),
    "peat_occupation": from_emitted(["occupation"]),
    "emissions_per_ha": from_emitted([*cols("emissions"), "per_ha", "ha"]),
    "forest_peat_split": from_emitted([*cols("forest"), *cols("peat_conversion"), "forest_per_ha", "peat_conversion_per_ha"]),
    "year_pairs": f"SELECT before, after, from_class, to_class, count(*) AS n FROM (SELECT year AS before, lead(year) OVER p AS after, class AS from_class, lead(class) OVER p AS to_class FROM ({' UNION ALL '.join(f'SELECT o, {y} AS year, {x} AS class FROM {PX}' for y, x in CLASS.items())}) WINDOW p AS (PARTITION BY o ORDER BY year)) WHERE after IS NOT NULL GROUP BY ALL",
    "crop_harmonized": f"WITH {STATS} SELECT cell, year, crop, {r('area_ha', 3)}, {r('production_mt', 3)} FROM hz",
    "crop_expansion_share": f"WITH {STATS} SELECT cell, crop, before, after, {r('expansion', 3)}, {r('total', 3)}, {r('share', 6)} FROM sh",
    "windowed_production": f"WITH {STATS} SELECT cell, crop, {r('production_mt', 2, bias=1e-4)} FROM wp",
    "statistical_rollup": f"WITH {ROLLED} SELECT admin_id, crop_name, {', '.join(r(x, 2, bias=1e-4) for x in [*_SUMS[:-1], 'production_mt'])} FROM rolled",
    "direct_rollup": f"WITH {DIRECT} SELECT admin_id, crop_name, {', '.join(r(x, 3) for x in _DIRECT_SUMS)} FROM direct",
    "mean_yield": f"WITH {YIELDS} SELECT admin_id, crop_name, {r('yield_kg_per_ha', 4)} FROM mean",
    "factor_direct": f"WITH {DIRECT}, {YIELDS} SELECT {FACTORS} FROM ({DIRECT_ROWS})",
    "factor_statistical": f"WITH {ROLLED} SELECT {FACTORS} FROM ({STATISTICAL_ROWS})",
    "factor_national": f"WITH {DIRECT}, {YIELDS}, pv AS ({DIRECT_ROWS}) SELECT {FACTORS} FROM ({national('pv')})",
    "factor_table": f"WITH {DIRECT}, {YIELDS}, pv AS ({DIRECT_ROWS}) SELECT {FACTORS} FROM (SELECT * FROM pv UNION ALL {national('pv')})",
    "factor_table_both": f"WITH {DIRECT}, {YIELDS}, {ROLLED}, pv AS ({DIRECT_ROWS} UNION ALL {STATISTICAL_ROWS}) SELECT {FACTORS} FROM (SELECT * FROM pv UNION ALL {national('pv')})",
    "unmatched_yields": f"WITH {DIRECT}, {YIELDS} SELECT count(*) AS unmatched FROM direct LEFT JOIN mean USING (admin_id, crop_name) WHERE yield_kg_per_ha IS NULL",
    "confusion_2x2": f"SELECT admin_id, {', '.join(r(x, 3) for x in [*q._AREAS, 'confirm_pct'])} FROM ({CONFUSION})",
    "confusion_total": f"SELECT 'ALL' AS \"all\", *, {r('100 * crop_cover / crop_total', 3, 'confirm_pct')} FROM (SELECT {', '.join(r(f'sum({x})', 3, x) for x in q._AREAS)} FROM ({CONFUSION}))",
    "confusion_by_region": f"SELECT region, {r('sum(crop_total)', 3, 'crop_total')}, {r('CASE WHEN sum(crop_total) > 0 THEN 100 * sum(crop_cover) / sum(crop_total) ELSE 0 END', 3, 'confirm_pct')}, {r('min(confirm_pct)', 3, 'least_pct')}, {r('max(confirm_pct)', 3, 'most_pct')} FROM ({CONFUSION}) JOIN (SELECT admin_id, CASE n_nationkey % 4 {' '.join(f'WHEN {i} THEN {n!r}' for n, i in q.REGIONS.items())} END AS region FROM ({fx.PROVINCES_SQL})) USING (admin_id) WHERE region IS NOT NULL GROUP BY region",
    "case_abc": f"SELECT state, {r('a', 3, 'case_a')}, {r('b', 3, 'case_b')}, {r('c', 3, 'case_c')}, {r('a + b + c', 3, 'total')}, {', '.join(f'round(100 * {x} / (a + b + c), 1) AS {x}_pct' for x in 'abc')} FROM (SELECT coalesce(admin_id, 'TOTAL') AS state, {', '.join(f'coalesce(sum(CASE WHEN kind = {x.upper()!r} THEN ha END), 0) AS {x}' for x in 'abc')} FROM ({CASES}) GROUP BY ROLLUP (admin_id))",
    "transition_matrix": TRANSITIONS,
    "top_transitions": f"{TRANSITIONS} ORDER BY area DESC, source, destination LIMIT 10",
    "stable_breakdown": buckets("C", "dst", k.STABLE_BUCKETS),
    "source_breakdown": buckets("B", "src", k.SOURCE_BUCKETS),
    "category_change": CHANGE,
    "ramp_fit": f"SELECT site, {r('any_value(p_luc)', 4, 'p_luc')}, {r('sqrt(avg((p_luc * w + 37.3 - e_ref) * (p_luc * w + 37.3 - e_ref)))', 4, 'rmse')} FROM (SELECT *, (21 - t) / 210.0::DOUBLE AS w FROM {CURVES} WHERE t <= 20) JOIN ({FIT}) USING (site) GROUP BY site",
    "cumulative_profile": f"SELECT site, t, {r('ref', 3)}, {r('model', 3)}, {r('model / ref', 3, 'ratio')} FROM (SELECT site, t, sum(e_ref) OVER p AS ref, sum(CASE WHEN t <= 20 THEN p_luc * (21 - t) / 210.0::DOUBLE + 37.3 ELSE 37.3 END) OVER p AS model FROM {CURVES} JOIN ({FIT}) USING (site) WINDOW p AS (PARTITION BY site ORDER BY t)) WHERE t IN (10, 20, 40, 50, 100)",
    "export_payload": f"""WITH {DIRECT}, {YIELDS}, pv AS ({DIRECT_ROWS}), nat AS ({national('pv')}),
rec AS (SELECT crop_name, jurisdiction_name AS country, '' AS province, production_kg, emissions_factor_kgco2e_per_kg FROM nat UNION ALL
  SELECT pv.crop_name, nat.jurisdiction_name, split_part(pv.jurisdiction_name, ' | ', 2), pv.production_kg, pv.emissions_factor_kgco2e_per_kg
  FROM pv JOIN nat ON pv.crop_name = nat.crop_name AND starts_with(pv.jurisdiction_name, nat.jurisdiction_name) WHERE pv.jurisdiction_name NOT IN (SELECT jurisdiction_name FROM prov WHERE n_nationkey = 3))
SELECT crop_name AS crop, country, province, 'Land use change' AS name, {r('production_kg', 0, 'output_amount')}, {r('emissions_factor_kgco2e_per_kg * production_kg', 0, 'emissions_kgco2e')} FROM rec""",
}
