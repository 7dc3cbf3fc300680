"""Input tables: keys, declared column types and file names (fixed values)."""

# Declared columns as DDL; columns not listed keep the type found in the file.
COLUMNS = {
    "parcels": "parcel_id long, block_id string, apn string, zone_id long, x double, y double",
    "buildings": "building_id long, parcel_id long, residential_sqft double, "
    "residential_units double, building_type_id long, sqft_per_unit double",
    "jobs": "job_id long, building_id long, sector_id long",
    "establishments": "establishment_id long, building_id long, primary_id long",
    "households": "household_id long, block_group_id string, state string, county string, "
    "tract string, block_group string, building_id long, unit_id long, persons double, "
    "income double, tenure long, race_of_head long, hispanic_head string, age_of_head long, "
    "children long, workers long, single_family long, building_type long, cars long",
    "persons": "person_id long, household_id long, age long, sex long, race_id long, edu long, "
    "worker long, work_at_home long, hours long, job_id long, TOD long, HW_ST double, WH_ST double",
    "rentals": "pid long, date string, region string, neighborhood string, rent double, "
    "sqft double, rent_sqft double, longitude double, latitude double, county string, "
    "fips_block string, state string, bathrooms string",
    "units": "unit_id long, building_id long",
    "zones": "zone_id long",
    "access_indicators": "block_id string",
    "mtc_skims": "orig long, dest long",
    "beam_skims_raw": "from_zone_id long, to_zone_id long, mode string, hour long, "
    "generalizedTimeInS double, gen_cost double, distanceInM double, numObservations long",
    "beam_skims_imputed": "from_zone_id long, to_zone_id long, dist double",
    "drive_nodes": "osmid long, x double, y double",
    "drive_edges": "uniqueid long, u long, v long, length double",
    "walk_nodes": "osmid long, x double, y double",
    "walk_edges": "uniqueid long, u long, v long, length double",
    "zone_accessibility": "taz1454 long",
    "survey_persons": "SAMPN long, AGE long, EDUCA long, EMPLY long, WLOC long, job_id long, "
    "building_id long",
    "survey_households": "SAMPN long, INCOM long",
    "nodeswalk": "osmid long",
    "nodessmall": "osmid long",
}

# Columns that stay text or are renamed are declared above; every other column of
# these tables is a measure.
MEASURE_TABLES = {
    "access_indicators",
    "mtc_skims",
    "beam_skims_imputed",
    "zone_accessibility",
    "nodeswalk",
    "nodessmall",
    "zones",
}

# Primary key, other accepted key names, and whether the first column of the file
# stands in for a missing key.
KEYS = {
    "parcels": ("parcel_id", ("primary_id",), False),
    "buildings": ("building_id", (), False),
    "jobs": ("job_id", (), True),
    "establishments": ("establishment_id", (), False),
    "households": ("household_id", (), True),
    "persons": ("person_id", (), True),
    "rentals": ("pid", (), True),
    "units": ("unit_id", (), False),
    "zones": ("zone_id", (), False),
    "drive_nodes": ("osmid", (), False),
    "walk_nodes": ("osmid", (), False),
    "drive_edges": ("uniqueid", (), False),
    "walk_edges": ("uniqueid", (), False),
    "zone_accessibility": ("taz1454", (), False),
    "nodeswalk": ("osmid", (), False),
    "nodessmall": ("osmid", (), False),
}

RENAMES = {
    "beam_skims_raw": {
        "generalizedCost": "gen_cost",
        "origTaz": "from_zone_id",
        "destTaz": "to_zone_id",
    },
}

DROPS = {"zones": ("tract",)}

FILE_NAMES = {
    "parcels": "parcels",
    "buildings": "buildings",
    "jobs": "jobs",
    "establishments": "establishments",
    "households": "households",
    "persons": "persons",
    "rentals": "craigslist",
    "units": "units",
    "mtc_skims": "mtc_skims",
    "beam_skims_raw": "beam_skims_raw",
    "beam_skims_imputed": "beam_skims_imputed",
    "drive_nodes": "drive_nodes",
    "drive_edges": "drive_edges",
    "nodessmall": "drive_net_vars",
    "walk_nodes": "walk_nodes",
    "walk_edges": "walk_edges",
    "nodeswalk": "walk_net_vars",
    "zones": "zones",
    "zone_access_vars": "zones_w_access_vars",
    "access_indicators": "access_indicators_ampeak",
    "zone_accessibility": "MTC_TAZ_accessibility",
}

OUTPUT_TABLES = (
    "parcels", "buildings", "jobs", "persons", "households", "establishments", "rentals",
    "units", "zones", "beam_skims_imputed", "mtc_skims", "plans", "walk_edges", "walk_nodes",
    "drive_edges", "drive_nodes",
)

ARCHIVE_TABLES = ("persons", "households", "jobs", "parcels", "buildings", "units")

# Foreign keys: (parent, child, child column, parent key)
RELATIONS = (
    ("parcels", "buildings", "parcel_id", "parcel_id"),
    ("buildings", "units", "building_id", "building_id"),
    ("units", "households", "unit_id", "unit_id"),
    ("households", "persons", "household_id", "household_id"),
    ("buildings", "jobs", "building_id", "building_id"),
    ("buildings", "establishments", "building_id", "building_id"),
    ("nodeswalk", "parcels", "node_id_walk", "osmid"),
    ("nodeswalk", "rentals", "node_id_walk", "osmid"),
    ("nodessmall", "rentals", "node_id_small", "osmid"),
    ("nodessmall", "parcels", "node_id_small", "osmid"),
    ("zones", "parcels", "zone_id", "zone_id"),
    ("jobs", "persons", "job_id", "job_id"),  # holds once workplaces are assigned
)
