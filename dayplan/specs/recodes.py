"""Code tables of the dummy columns and recodes (fixed values)."""

JOB_SECTORS = {
    "sector_retail": [44, 45],
    "sector_healthcare": [62],
    "sector_tech": [51, 54],
    "sector_food_and_hosp": [72],
    "sector_mfg": [31, 32, 33],
    "sector_edu_serv": [61],
    "sector_oth_serv": [81],
    "sector_constr": [23],
    "sector_gov": [92],
    "sector_fire": [52, 53],
    "sector_whlsale": [42],
    "sector_admin": [56],
    "sector_transport": [48],
    "sector_arts": [71],
    "sector_util": [22],
}

# Sectors of the time-of-day model
TOD_SECTORS = {"finance": [52], "info": [51], "scitech": [54]}

# Right-closed income bins: name, lower bound, upper bound. The first bin is closed
# on both sides, the last has no upper bound.
INCOME_BINS = (
    ("income_2", 0, 20000),
    ("income_4", 20000, 40000),
    ("income_6", 40000, 60000),
    ("income_8", 60000, 80000),
    ("income_10", 80000, 100000),
    ("income_12", 100000, 120000),
    ("income_12p", 120000, None),
)

PARCEL_ACCESS = (
    "average_income_20",
    "above_jobs_20", "above_jobs_40", "above_jobs_60",
    "below_jobs_20", "below_jobs_40", "below_jobs_60",
    "employment_20", "employment_40", "employment_60",
    "population_20", "population_40", "population_60",
)

# Survey codes of the commute-mode model
RACE = {1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: 4, 7: 5, 8: 97, 9: 97}
EDUCATION = {
    **{code: 1 for code in range(0, 16)},
    16: 2, 17: 2, 18: 3, 19: 3, 20: 4, 21: 5, 22: 6, 23: 6, 24: 6,
}
TOD_PERIOD = {2: "EA", 3: "EA", 12: "AM", 14: "AM", 22: "MD", 23: "MD", 24: "MD"}

PERIODS = ("EA", "AM", "MD", "PM", "EV")
MODE_PERIODS = ("EA", "AM", "MD")
