"""Feature registry: which column is a flag, a measure, a text or a coordinate."""

from __future__ import annotations

# Flag columns in the order of the Hamming code.
FLAGS = (
    "is_deliverable", "is_residential", "is_unit",
    "has_outdoor_space", "has_garage", "has_pool", "has_central_air", "has_fireplace",
    "is_commercial", "is_ag", "is_mobile",
    "has_hardwood", "has_carpet", "has_tile",
)

# Scored measures, always known and known only for listed properties.
BASE_MEASURES = ("yr_built", "building_sqft", "land_sqft")
LISTING_MEASURES = ("baths", "beds", "floorsize", "yearbuilt")
MEASURES = BASE_MEASURES + LISTING_MEASURES

# State-code descriptions used as 0/1 features by the sign-projection search.
STATE_FEATURES = (
    "commercial_real_property",
    "multifamily_residence",
    "single_family_residence",
    "rural_land,_non_qualified_open_space_land,_imprvs",
    "tangible_other_personal,_mobile_homes",
    "improvements_on_qualified_open_space_land",
    "residential_inventory",
    "electric_company_(including_co-op)",
    "industrial_and_manufacturing_real_property",
    "vacant_lots_and_land_tracts",
    "water_systems",
    "telephone_company_(including_co-op)",
    "totally_exempt_property",
    "gas_distribution_system",
    "qualified_open-space_land",
)

# The 36 raw features of the sign-projection search.
PROJECTION_FEATURES = (
    ("lat", "lon", "is_deliverable", "is_residential")
    + STATE_FEATURES
    + (
        "yr_built", "building_sqft", "has_outdoor_space", "has_garage", "has_pool",
        "has_central_air", "has_fireplace", "land_sqft", "is_commercial", "is_ag", "is_mobile",
        "beds", "baths", "floorsize", "has_carpet", "has_hardwood", "has_tile",
    )
)

# Text columns of a published document (upper-cased there).
DOCUMENT_TEXTS = (
    "address", "City", "State", "imprv_state_cd", "land_state_cd", "state_cd",
    "ptd_state_cd_description", "hood_cd", "situs_num",
)
# Text columns beyond the ones above; published as text as well instead of 0.
EXTRA_TEXTS = ("geo_address", "type", "geo_id", "situs_zip", "situs_unit", "zone")

# Latitude of properties without one, list length, years of the appraisal history.
DEFAULT_LAT = 30.2672
NEIGHBOURS = 20
HISTORY_YEARS = (2015, 2016, 2017, 2018)

# One schema for the scores of all metrics.
SCORES = "search_prop bigint, sim_prop bigint, sim_score double, sim_rank int, metric string"

# Zones whose listings are collected, one partition each.
LISTING_ZONES = (
    78730, 78731, 78735, 78702, 78701, 78703, 78704, 78750, 78759, 78758, 78757, 78753,
    78752, 78727, 78723, 78721, 78742, 78745, 78749, 78741, 78729, 78756, 78722,
)
