"""Registered queries against DuckDB; the slow iterative ones run in checks.compare."""

import pytest

from checks import all_queries
from checks.compare import difference, duck, types_of

QUERIES, ORACLES = all_queries()
FAST = [
    "q_read_parcels", "q_buildings_sqft", "q_read_entities", "q_rentals_clamped", "q_access_indicators",
    "q_parcel_access", "q_job_sectors", "q_person_dummies", "q_household_dummies", "q_zone_home_work",
    "q_merge_jobs", "q_merge_households", "q_update_column", "q_survey_obs", "q_zone_totals", "q_zone_avg_income",
    "q_profile", "q_mode_rates", "q_impute_skims", "q_skim_access_all", "q_tod_choice", "q_mode_choice",
    "q_departure_times", "q_activity_plans", "q_coverage", "q_nearest_node",
]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"q_fit_workplace"}


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    left = df.toPandas()
    arrow = duck(folder).sql(ORACLES[name]).to_arrow_table()
    assert len(left) > 0
    assert difference(left, arrow.to_pandas()) is None
    assert types_of(df, arrow) == []


def test_entry_gives_five_rows_per_person(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["personId", "planElement", "planElementIndex", "activityType", "x", "y", "endTime"]
    assert df.count() % 5 == 0
