"""Departure times, autos, trips, activity plans, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import Model
from checks.oracle import step, u
from checks.q_choice import mode_tables, salted, wide_choice, wide_sql
from checks.q_skims import commuters
from checks.q_tables import round_all
from checks.registry import query
from dayplan.functions import laws
from dayplan.operators.qa import coverage
from dayplan.plans.activities import activity_plans, trip_table
from dayplan.plans.departures import departure_times, early_24
from dayplan.plans.modes import primary_mode_choice_simulate
from dayplan.session import materialize
from dayplan.specs.departures import EARLY_24, HOME_TO_WORK, LATE_24, WORK_TO_HOME

SALT = "depart"


# ---------------------------------------------------------------- SQL of the laws


def _horner(coefficients, x: str) -> str:
    acc = f"CAST({coefficients[0]!r} AS DOUBLE)"
    for c in coefficients[1:]:
        acc = f"({acc} * {x} + {c!r})"
    return acc


def normal_sql(p: str) -> str:
    def tail(q: str) -> str:
        return f"({_horner(laws.ACKLAM_C, q)} / ({_horner(laws.ACKLAM_D, q)} * {q} + 1))"

    mid, r = f"({p} - 0.5)", f"(({p} - 0.5) * ({p} - 0.5))"
    low, high = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"
    return (
        f"CASE WHEN {p} < {laws.ACKLAM_LOW} THEN {tail(low)} WHEN {p} > {1 - laws.ACKLAM_LOW!r} THEN -{tail(high)} "
        f"ELSE {_horner(laws.ACKLAM_A, r)} * {mid} / ({_horner(laws.ACKLAM_B, r)} * {r} + 1) END"
    )


def minus_log(x: str) -> str:
    """-ln(1 - x), by its series where 1 - x would lose the digits of a small x."""
    return f"(CASE WHEN {x} < 1e-5 THEN {x} * (1 + {x} / 2 + {x} * {x} / 3) ELSE -ln(1 - {x}) END)"


def law_sql(law: laws.Law, v: str) -> str:
    """Time of day for the uniform draw in SQL expression ``v``."""
    if law.tabulated:
        table = "[" + ", ".join(repr(x) for x in law.knots) + "]"
        at = f"({v} * {laws.KNOTS})"
        i = f"CAST(floor({at}) AS BIGINT)"
        return (
            f"(SELECT t[i + 1] + (t[i + 2] - t[i + 1]) * (at_ - i) FROM "
            f"(SELECT CAST({table} AS DOUBLE[]) AS t, {at} AS at_, {i} AS i))"
        )
    low, high = law.mass
    q = f"(CAST({low!r} AS DOUBLE) + {v} * CAST({high - low!r} AS DOUBLE))"
    s = law.shape
    z = {
        "bradford": lambda: f"((pow({1 + s[0]!r}, {q}) - 1) / {s[0]!r})",
        "burr": lambda: f"pow(pow({q}, {-1 / s[1]!r}) - 1, {-1 / s[0]!r})",
        "genlogistic": lambda: f"(-ln(pow({q}, {-1 / s[0]!r}) - 1))",
        "johnsonsb": lambda: f"(1 / (1 + exp(-(({normal_sql(q)}) - {s[0]!r}) / {s[1]!r})))",
        "pareto": lambda: f"pow(1 - {q}, {-1 / s[0]!r})",
        "weibull_min": lambda: f"pow({minus_log(q)}, {1 / s[0]!r})",
        "levy": lambda: f"(1 / pow({normal_sql(q + ' / 2')}, 2))",
        "triang": lambda: f"(CASE WHEN {q} < {s[0]!r} THEN sqrt({s[0]!r} * {q}) "
        f"ELSE 1 - sqrt({1 - s[0]!r} * (1 - {q})) END)",
        "exponweib": lambda: f"pow({minus_log(f'pow({q}, {1 / s[0]!r})')}, {1 / s[1]!r})",
    }[law.kind]()
    return f"(CAST({law.loc!r} AS DOUBLE) + CAST({law.scale!r} AS DOUBLE) * {z})"


def open_u(salt: str, key: str, slot: int) -> str:
    return f"(({salted(salt, key, slot)} + 0.5::DOUBLE) / CAST(4294967296 AS DOUBLE))"


step("c_coded", "SELECT p.person_id, w.TOD FROM fx_persons p JOIN fx_persons_work w USING (person_id)")
step(
    "c_early",
    f"SELECT person_id, row_number() OVER (ORDER BY {salted(SALT + '|24', 'person_id', 0)}, person_id) <= "
    "round((SELECT count(*) FROM c_coded WHERE TOD = 24) * CAST(241 AS DOUBLE) / 377) AS early "
    "FROM c_coded WHERE TOD = 24",
)
# the quantile tables of the three laws without a closed form, one row per knot
_TABLES = {
    f"{side}_{code}": law
    for side, group in (("hw", HOME_TO_WORK), ("wh", WORK_TO_HOME)) for code, law in group.items() if law.tabulated
}
for _name, _law in _TABLES.items():
    step(
        f"c_knots_{_name}",
        "SELECT i, t[i + 1] AS a, t[i + 2] AS b FROM (SELECT CAST([" + ", ".join(map(repr, _law.knots))
        + f"] AS DOUBLE[]) AS t, unnest(range({laws.KNOTS})) AS i)",
    )
step("c_draws", f"SELECT *, {open_u(SALT, 'person_id', 0)} AS uh, {open_u(SALT, 'person_id', 1)} AS uw FROM c_coded")


def _side(group, v: str, side: str) -> str:
    out = ""
    for code, law in group.items():
        if law.tabulated:
            text = f"k_{side}_{code}.a + (k_{side}_{code}.b - k_{side}_{code}.a) * ({v} * {laws.KNOTS} - k_{side}_{code}.i)"
        else:
            text = law_sql(law, v)
        out += f" WHEN d.TOD = {code} THEN {text}"
    return out


step(
    "c_drawn",
    f"SELECT d.person_id, d.TOD, CASE WHEN e.early THEN {law_sql(EARLY_24, 'uh')} WHEN d.TOD = 24 THEN "
    f"{law_sql(LATE_24, 'uh')}{_side(HOME_TO_WORK, 'uh', 'hw')} END AS hw, CASE{_side(WORK_TO_HOME, 'uw', 'wh')} END AS wh "
    "FROM c_draws d LEFT JOIN c_early e ON e.person_id = d.person_id"
    + "".join(
        f" LEFT JOIN c_knots_{n} k_{n} ON k_{n}.i = floor({'uh' if n.startswith('hw') else 'uw'} * {laws.KNOTS})"
        for n in _TABLES
    ),
)
# pairs of code 22 in the wrong order: work by its law given that home came first, then home
step(
    "c_knots_later",
    "SELECT i, t[i + 1] AS a, t[i + 2] AS b FROM (SELECT CAST(["
    + ", ".join(map(repr, laws.later_knots(HOME_TO_WORK[22], WORK_TO_HOME[22])))
    + f"] AS DOUBLE[]) AS t, unnest(range({laws.KNOTS})) AS i)",
)
_home = HOME_TO_WORK[22]
_upto = f"u_hw * (1 - exp(-pow((wh - {_home.loc!r}) / {_home.scale!r}, {_home.shape[0]!r})))"
step(
    "c_ordered",
    f"SELECT person_id, {_home.loc!r} + {_home.scale!r} * pow({minus_log('q')}, {1 / _home.shape[0]!r}) AS hw, wh FROM ("
    f"SELECT *, {_upto} AS q FROM (SELECT person_id, u_hw, k.a + (k.b - k.a) * (u_wh * {laws.KNOTS} - k.i) AS wh FROM ("
    f"SELECT person_id, {open_u(SALT + '|again', 'person_id', 0)} AS u_wh, {open_u(SALT + '|again', 'person_id', 1)} AS u_hw "
    f"FROM c_drawn WHERE TOD = 22 AND hw >= wh) x JOIN c_knots_later k ON k.i = floor(u_wh * {laws.KNOTS})))",
)
step(
    "c_times",
    "SELECT d.person_id, d.TOD, coalesce(o.hw, d.hw) AS HW_ST, coalesce(o.wh, "
    "CASE WHEN d.TOD IN (14, 24) AND d.wh > 24 THEN d.wh - 24 ELSE d.wh END) AS WH_ST "
    "FROM c_drawn d LEFT JOIN c_ordered o ON o.person_id = d.person_id",
)


def stored_codes(m: Model):
    coded = m["persons"].select("person_id").join(m["persons_work"], "person_id")
    return materialize(coded.select("person_id", "TOD"), "codes")


def times_of(m: Model):
    if "_times" not in m._tables:
        m._tables["_times"] = departure_times(stored_codes(m), SALT)
    return m._tables["_times"]


@query("q_departure_times", "SELECT person_id, TOD, " + round_all(("HW_ST", "WH_ST"), 6) + " FROM c_times", 6)
def _(m: Model):
    return times_of(m)


@query(
    "q_tod22_order",
    "SELECT person_id, round(HW_ST, 6) AS HW_ST, round(WH_ST, 6) AS WH_ST, CAST(HW_ST < WH_ST AS BIGINT) AS ordered "
    "FROM c_times WHERE TOD = 22", 6,
)
def _(m: Model):
    rows = times_of(m).where("TOD = 22").select("person_id", "HW_ST", "WH_ST")
    return rows.withColumn("ordered", F.expr("HW_ST < WH_ST"))


@query("q_tod24_split", "SELECT person_id, CAST(early AS BIGINT) AS early FROM c_early")
def _(m: Model):
    rows, _ = early_24(stored_codes(m), f"{SALT}|24")
    return rows


# ---------------------------------------------------------------- trips and plans


def day_tables(m: Model) -> dict:
    """Model tables whose persons hold a job, a code and both departure times."""
    times = times_of(m).drop("TOD")
    persons = commuters(m)["persons"].join(times, "person_id", "left")
    return {**commuters(m), "persons": persons}


step(
    "c_trips",
    "SELECT p.person_id, t.HW_ST AS Home, t.WH_ST AS Work, hp.x AS x_home, hp.y AS y_home, jp.x AS x_work, jp.y AS y_work "
    "FROM fx_persons p JOIN fx_persons_work w ON w.person_id = p.person_id "
    "LEFT JOIN c_times t ON t.person_id = p.person_id "
    "JOIN fx_households h ON h.household_id = p.household_id JOIN fx_units n ON n.unit_id = h.unit_id "
    "JOIN fx_buildings hb ON hb.building_id = n.building_id JOIN fx_parcels hp ON hp.parcel_id = hb.parcel_id "
    "JOIN fx_jobs j ON j.job_id = w.job_id JOIN fx_buildings jb ON jb.building_id = j.building_id "
    "JOIN fx_parcels jp ON jp.parcel_id = jb.parcel_id",
)


@query(
    "q_trip_coords",
    "SELECT person_id, " + round_all(("Home", "Work"), 6) + ", x_home, y_home, x_work, y_work FROM c_trips",
)
def _(m: Model):
    return trip_table(day_tables(m)).withColumns({c: F.round(c, 6) for c in ("Home", "Work")})


step(
    "c_acts",
    "SELECT person_id, kind, x, y, endTime, row_number() OVER (PARTITION BY person_id ORDER BY endTime NULLS LAST, kind) "
    "* 2 - 1 AS i FROM (SELECT person_id, 'Home' AS kind, x_home AS x, y_home AS y, Home AS endTime FROM c_trips "
    "UNION ALL SELECT person_id, 'Work', x_work, y_work, Work FROM c_trips)",
)
step(
    "c_plans",
    "SELECT person_id AS personId, 'activity' AS planElement, CAST(i AS BIGINT) AS planElementIndex, kind AS activityType, "
    "x, y, endTime FROM c_acts UNION ALL SELECT person_id, 'activity', 5, kind, x, y, NULL FROM c_acts WHERE i = 1 "
    "UNION ALL SELECT person_id, 'leg', i + 1, '', NULL, NULL, NULL FROM c_acts",
)


@query(
    "q_activity_plans",
    "SELECT personId, planElement, planElementIndex, activityType, x, y, round(endTime, 6) AS endTime FROM c_plans",
)
def plans_of(m: Model):
    plans = activity_plans(trip_table(day_tables(m)))
    return plans.withColumn("endTime", F.round("endTime", 6))


step("c_placed", "SELECT count(job_id) AS n FROM fx_persons_work")
step(
    "c_cover",
    "SELECT 'workplace' AS step, (SELECT n FROM c_placed) AS covered, count(*) AS total FROM c_choosers "
    "UNION ALL SELECT 'departure', (SELECT count(HW_ST) FROM c_times), (SELECT n FROM c_placed) "
    "UNION ALL SELECT 'autos', count(cars), count(*) FROM fx_households "
    "UNION ALL SELECT 'mode', count(primary_commute_mode), (SELECT n FROM c_placed) FROM c_modes "
    "UNION ALL SELECT 'plans', count(DISTINCT personId), (SELECT n FROM c_placed) FROM c_plans",
)


@query("q_coverage", "SELECT step, covered, total, round(covered / total * 100, 1) AS percent FROM c_cover")
def _(m: Model):
    from checks.q_tables import home_persons

    day = day_tables(m)
    zones = home_persons(m).select("person_id", "zone_id_home")
    persons = materialize(day["persons"].join(zones, "person_id"), "day-persons")
    day = {**day, "persons": persons}
    modes = primary_mode_choice_simulate({**mode_tables(m), "persons": persons})
    return coverage(persons, m["households"], modes, activity_plans(trip_table(day)))
