"""Published constants of the methodology: land classes, carbon factors, crop taxonomies."""

from __future__ import annotations

YEARS = (2000, 2005, 2010, 2015, 2020)
SPANS = tuple(zip(YEARS, YEARS[1:], strict=False))

# Land classes; 0 is unmapped.
BUILT_UP, CROPLAND, FOREST, GRASSLAND, OCEAN, SNOW_ICE, WATER = 1, 2, 3, 4, 5, 6, 7
# Land-cover codes of each class: first and last code, class.
LAND_CLASS_RANGES = [
    (0, 24, GRASSLAND), (25, 48, FOREST), (100, 124, GRASSLAND), (125, 148, FOREST), (200, 207, WATER), (241, 241, SNOW_ICE), (244, 244, CROPLAND), (250, 250, BUILT_UP), (254, 254, OCEAN),
]
# Nine simplified categories of the agreement analysis: first and last code, category; all else is 8.
CATEGORY_RANGES = [(0, 0, 0), (1, 24, 1), (25, 48, 2), (100, 124, 3), (125, 148, 4), (200, 207, 5), (241, 241, 8), (244, 244, 6), (250, 250, 7)]
CATEGORY_NAMES = ["bare", "short_veg", "forest", "wetland_short_veg", "wetland_forest", "water", "cropland", "built_up", "snow_ice_other"]

# Fixed values by climate zone 1..10: tropical montane, wet, moist, dry; warm temperate moist, dry;
# cool temperate moist, dry; boreal moist, dry.
DEAD_WOOD = [0.07, 0.06, 0.01, 0.02, 0.08, 0.08, 0.08, 0.08, 0.08, 0.08]
LITTER = [0.01, 0.01, 0.01, 0.04, 0.04, 0.04, 0.04, 0.04, 0.04, 0.04]
GRASSLAND_CARBON = [7, 18, 18, 7, 7, 5, 7, 5, 6, 3]
SOIL_FACTOR = [0.76, 0.83, 0.83, 0.92, 0.69, 0.76, 0.70, 0.77, 0.70, 0.77]

# Carbon fractions, root-to-shoot ratio, emissions of peat, discount of the spans, lengths of equator and meridian.
CARBON_LIVE, CARBON_DEAD_WOOD, CARBON_LITTER = 0.47, 0.50, 0.37
ROOT_TO_SHOOT = 0.25
CO2_PER_C = 44 / 12
PEAT_PULSE, PEAT_OCCUPATION = 621.0, 37.3
#: 20-year linear discount of the four spans.
SPAN_WEIGHTS = {(2000, 2005): 0.0125, (2005, 2010): 0.0375, (2010, 2015): 0.0625, (2015, 2020): 0.0875}
EQUATOR_M, MERIDIAN_M = 40_075_017, 40_007_863

# Crops that all statistics years share, and groups of the year 2000 with their later parts.
SHARED = ["BARL", "BEAN", "CASS", "COTT", "GROU", "MAIZ", "POTA", "RICE", "SORG", "SOYB", "SUGB", "SUGC", "WHEA"]
GROUPS = {
    "BANP": ["BANA", "PLNT"],
    "COFF": ["ACOF", "RCOF"],
    "MILL": ["PMIL", "SMIL"],
    "OOIL": ["CNUT", "OILP", "SUNF", "RAPE", "SESA", "OOIL"],
    "OPUL": ["CHIC", "COWP", "PIGE", "LENT", "OPUL"],
    "SWPY": ["SWPO", "YAMS"],
}
STATISTICS_YEARS = (2000, 2005, 2010, 2020)
# Labels of crop codes in 2005 and 2010, and in 2000.
LABELS_2005 = {
    "ACOF": "Arabic Coffee", "BANA": "Banana", "BARL": "Barley", "BEAN": "Bean", "CASS": "Cassava", "CHIC": "Chickpea", "CNUT": "Coconut", "COCO": "Cocoa",
    "COTT": "Cotton", "COWP": "Cowpea", "GROU": "Groundnut", "LENT": "Lentil", "MAIZ": "Maize", "OCER": "Other Cereals", "OFIB": "Other Fibre Crops",
    "OILP": "Oilpalm", "OOIL": "Other Oil Crops", "OPUL": "Other Pulses", "ORTS": "Other Roots", "PIGE": "Pigeon Pea", "PLNT": "Plantain", "PMIL": "Pearl Millet",
    "POTA": "Potato", "RAPE": "Rapeseed", "RCOF": "Robust Coffee", "REST": "Rest Of Crops", "RICE": "Rice", "SESA": "Sesame Seed", "SMIL": "Small Millet",
    "SORG": "Sorghum", "SOYB": "Soybean", "SUGB": "Sugarbeet", "SUGC": "Sugarcane", "SUNF": "Sunflower", "SWPO": "Sweet Potato", "TEAS": "Tea",
    "TEMF": "Temperate Fruit", "TOBA": "Tobacco", "TROF": "Other Tropical Fruit", "VEGE": "Other Vegetables", "WHEA": "Wheat", "YAMS": "Yams",
}
LABELS_2000 = {
    "BANP": "Banana And Plantain", "BARL": "Barley", "BEAN": "Bean", "CASS": "Cassava", "COFF": "Coffee", "COTT": "Cotton", "GROU": "Groundnut", "MAIZ": "Maize",
    "MILL": "Millet", "OFIB": "Other Fibre Crops", "OOIL": "Other Oil Crops", "OPUL": "Other Pulses", "OTHE": "Rest Of Crops", "POTA": "Potato", "RICE": "Rice",
    "SORG": "Sorghum", "SOYB": "Soybean", "SUGB": "Sugarbeet", "SUGC": "Sugarcane", "SWPY": "Sweet Potato And Yam", "WHEA": "Wheat",
}
#: Codes that only 2020 has.
NEW_2020 = {"CITR": "Citrus", "ONIO": "Onion", "RUBB": "Rubber", "TOMA": "Tomato"}
#: Codes of 2020 for crops that other years code otherwise.
RENAMED_2020 = {"ACOF": "COFF", "SMIL": "MILL"}
#: Statistics span that stands for each land-cover span.
STATISTICS_SPAN = {(2000, 2005): (2000, 2005), (2005, 2010): (2005, 2010), (2010, 2015): (2010, 2020), (2015, 2020): (2010, 2020)}

# Published names of the statistical crops by their 2005 code.
STATISTICAL_CROPS = {
    "BARLEY": "BARL", "BEAN": "BEAN", "CASSAVE": "CASS", "COTTON": "COTT", "GROUNDNUT": "GROU", "MAIZE": "MAIZ", "POTATO": "POTA", "RICE": "RICE",
    "SORGHUM": "SORG", "SOYBEAN": "SOYB", "SUGARBEET": "SUGB", "SUGARCANE": "SUGC", "WHEAT": "WHEA", "BANANA": "BANA", "PLANTAIN": "PLNT",
    "ARABICA_COFFEE": "ACOF", "ROBUSTA_COFFEE": "RCOF", "PEARL_MILLET": "PMIL", "SMALL_MILLET": "SMIL", "COCONUT": "CNUT", "OILPALM": "OILP",
    "SUNFLOWER": "SUNF", "RAPESEED": "RAPE", "SESAME_SEED": "SESA", "OTHER_OILCROPS": "OOIL", "CHICKPEA": "CHIC", "COWPEA": "COWP",
    "PIGEONPEA": "PIGE", "LENTIL": "LENT", "OTHER_PULSES": "OPUL", "SWEET_POTATO": "SWPO", "YAM": "YAMS",
}
# Crop-map codes of the directly attributed crops.
DIRECT_CROPS = {"MAIZE": [1], "COTTON": [2], "RICE": [3], "SORGHUM": [4], "SOYBEAN": [5], "BARLEY": [21], "WHEAT": [22, 23, 24], "SUGARBEET": [41], "BEAN": [42], "POTATO": [43], "SUGARCANE": [45]}
FEW_CROPS = ["MAIZE", "SOYBEAN", "WHEAT"]
# Commodity names of the yield survey and of the crop list; pounds per bushel; units; suppressed values; accounting years.
SURVEY_CROPS = {"CORN": "MAIZE", "SOYBEANS": "SOYBEAN", "WHEAT": "WHEAT"}
LB_PER_BUSHEL = {"CORN": 56, "SOYBEANS": 60, "WHEAT": 60}
KG_PER_LB, HA_PER_ACRE = 0.45359237, 0.40468564
# Admin id of each state by its FIPS code.
US_STATES = {
    1: "USA001", 2: "USA002", 4: "USA003", 5: "USA004", 6: "USA005", 8: "USA006", 9: "USA007", 10: "USA008",
    11: "USA009", 12: "USA010", 13: "USA011", 15: "USA012", 16: "USA013", 17: "USA014", 18: "USA015", 19: "USA016",
    20: "USA017", 21: "USA018", 22: "USA019", 23: "USA020", 24: "USA021", 25: "USA022", 26: "USA023", 27: "USA024",
    28: "USA025", 29: "USA026", 30: "USA027", 31: "USA028", 32: "USA029", 33: "USA030", 34: "USA031", 35: "USA032",
    36: "USA033", 37: "USA034", 38: "USA035", 39: "USA036", 40: "USA037", 41: "USA038", 42: "USA039", 44: "USA040",
    45: "USA041", 46: "USA042", 47: "USA043", 48: "USA044", 49: "USA045", 50: "USA046", 51: "USA047", 53: "USA048",
    54: "USA049", 55: "USA050", 56: "USA051",
}
SUPPRESSED = ["(D)", "(Z)", "(S)", "(NA)"]
YIELD_YEARS = (2017, 2018, 2019, 2020)
KG_PER_TONNE = 1000

# Crop-map codes of herbaceous crops; row crops are these without hay and fallow.
HERBACEOUS = [
    1, 2, 3, 4, 5, 6, 10, 11, 12, 13, 14,
    21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 37, 38, 39,
    41, 42, 43, 44, 45, 46, 47, 48, 49, 50, 51, 52, 53, 54, 56, 57, 61,
    205, 206, 207, 208, 209, 213, 214, 216, 218, 219, 221, 222, 223, 225, 226, 227, 228, 229,
    230, 231, 232, 233, 234, 235, 236, 237, 238, 239, 240, 241, 243, 244, 245, 246, 247, 248, 249, 254,
]
HAY, FALLOW = [36, 37], [61]
# Names of the breakdown tables.
SOURCE_BUCKETS = {"cropland": "Cropland", "short_veg": "Short veg", "forest": "Forest", "wetland_short_veg": "Wetland", "wetland_forest": "Wetland"}
STABLE_BUCKETS = {"built_up": "Built-up", "short_veg": "Short vegetation", "forest": "Forest", "wetland_short_veg": "Wetland", "wetland_forest": "Wetland"}
OTHER_BUCKET = "Water/bare/other"


def group_of() -> dict[str, tuple[str, int]]:
    """Constituent -> (group of 2000, number of siblings)."""
    return {part: (group, len(parts)) for group, parts in GROUPS.items() for part in parts}


def taxonomy() -> list[tuple[int, str, str]]:
    """(year, code, label) of all crops of all statistics years."""
    latest = {RENAMED_2020.get(code, code): label for code, label in LABELS_2005.items()} | NEW_2020
    years = {2000: LABELS_2000, 2005: LABELS_2005, 2010: LABELS_2005, 2020: latest}
    return [(year, code, label) for year, labels in years.items() for code, label in labels.items()]
