"""Choice models: sampling, utilities, probabilities, draws, capacity rounds, fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import Model
from checks.oracle import step, u
from checks.q_skims import commuters, imputed, zones_with_access
from checks.q_tables import round_all
from checks.registry import query
from dayplan.functions.draws import uniform
from dayplan.operators.choice import (
    choice_table,
    draw_choice,
    mnl_probabilities,
    sample_alternatives,
    utility,
    wide_probabilities,
)
from dayplan.operators.fit import fit_conditional_logit
from dayplan.plans.modes import mode_base, primary_mode_choice_simulate
from dayplan.plans.survey import estimate_workplace_model, survey_choice_table
from dayplan.plans.timeofday import tod_choice_simulate, tod_features
from dayplan.plans.workplace import (
    CHOOSER_COLUMNS,
    home_work_interactions,
    wlcm_simulate,
    workplace_alternatives,
    workplace_choosers,
)
from dayplan.specs.choice import (
    ALTERNATIVES_SAMPLED,
    MODE_CHOICE,
    TOD_CHOICE,
    WLCM_GEN_TT,
    WLCM_GEN_TT_SIMPLE,
    WideLogit,
)
from dayplan.specs.recodes import JOB_SECTORS

K = ALTERNATIVES_SAMPLED
ACCESS = ("total_jobs_gen_tt_CAR_15", "total_jobs_gen_tt_WALK_TRANSIT_15")
INTER = ("dist", "gen_tt_CAR", "gen_cost_CAR", "gen_tt_WALK_TRANSIT")


def wlcm_tables(m: Model) -> dict:
    names = ("persons", "households", "units", "buildings", "parcels", "jobs")
    m.keep("jobs")
    return {
        **m.tables(*names), "zones": zones_with_access(m), "beam_skims_imputed": imputed(m)
    }


# ---------------------------------------------------------------- SQL parts


def salted(salt: str, key: str, slot: int) -> str:
    return (
        f"(CAST('0x' || substr(md5('{salt}|' || CAST({key} AS VARCHAR)), {1 + 8 * slot}, 8) AS BIGINT))"
    )


def picks_sql(source: str, key: str, salt: str, size: str, k: int, keep: str) -> str:
    """k distinct indices below size per row: draw i falls on 0..size-k+i and gives way to
    the newest index when taken. Long form (row, idx)."""
    text = f"SELECT {keep}, CAST({size} AS BIGINT) AS size_ FROM {source}"
    for i in range(k):
        draw = f"{salted(f'{salt}|{i // 4}', key, i % 4)} / CAST(4294967296 AS DOUBLE)"
        top = f"(size_ - {k - i})"
        text = f"SELECT *, CAST(floor({draw} * ({top} + 1)) AS BIGINT) AS d{i} FROM ({text})"
        taken = ", ".join(f"t{j}" for j in range(i))
        new = f"CASE WHEN d{i} IN ({taken}) THEN {top} ELSE d{i} END" if i else f"d{i}"
        text = f"SELECT *, {new} AS t{i} FROM ({text})"
    return f"SELECT {keep}, unnest([{', '.join(f't{i}' for i in range(k))}]) AS idx FROM ({text})"


def sql_terms(terms) -> str:
    def factor(f: str) -> str:
        return f"ln(1 + {f[6:-1]})" if f.startswith("log1p(") else f

    return " + ".join(f"CAST({c!r} AS DOUBLE) * " + " * ".join(map(factor, fs)) for c, fs in terms)


def draw_sql(source: str, chooser: str, alternative: str, value: str, u_sql: str) -> str:
    """Inverse CDF over the alternatives in key order."""
    w = f"OVER (PARTITION BY {chooser}"
    return (
        f"SELECT {chooser}, min({alternative}) AS {alternative} FROM (SELECT {chooser}, {alternative}, "
        f"sum(e) {w} ORDER BY {alternative}) AS s, sum(e) {w}) AS total, "
        f"max({alternative}) {w}) AS last FROM (SELECT *, exp({value} - max({value}) {w})) AS e FROM {source} "
        f"WHERE {value} IS NOT NULL)) WHERE s > {u_sql} * total OR {alternative} = last GROUP BY {chooser}"
    )


def wide_sql(spec: WideLogit, source: str, keep: str) -> str:
    """Utilities v*, weights e* and their total as columns."""
    vs = []
    for a in spec.alternatives:
        parts = [
            f"CAST({c[a]!r} AS DOUBLE)" + ("" if name == "intercept" else f" * {name}")
            for name, c in spec.coefficients.items() if a in c
        ]
        vs.append(f"{' + '.join(parts) or '0'} AS v{a}")
    names = [f"v{a}" for a in spec.alternatives]
    weights = ", ".join(
        f"CASE WHEN {' + '.join(names)} IS NOT NULL THEN exp({v} - greatest({', '.join(names)})) END AS e{v[1:]}"
        for v in names
    )
    total = " + ".join(f"e{a}" for a in spec.alternatives)
    return f"SELECT *, {total} AS total FROM (SELECT *, {weights} FROM (SELECT {keep}, {', '.join(vs)} FROM {source}))"


def wide_choice(spec: WideLogit, u_sql: str) -> str:
    out, acc = "CASE WHEN total IS NULL THEN NULL", ""
    for a in spec.alternatives[:-1]:
        acc = f"{acc} + e{a}" if acc else f"e{a}"
        out += f" WHEN {acc} > {u_sql} * total THEN {a}"
    return f"CAST({out} ELSE {spec.alternatives[-1]} END AS BIGINT)"


step(
    "c_choosers",
    "SELECT p.person_id, p.zone_id_home, p.no_higher_ed, p.age_under_45, h.hh_inc_under_25k, h.hh_inc_25_to_75k, "
    "h.hh_inc_75_to_200k FROM c_person_zone p JOIN c_households h ON h.household_id = p.household_id "
    "WHERE p.worker = 1 AND p.work_at_home = 0 AND p.zone_id_home IS NOT NULL",
)
_SECTORS = ", ".join(f"j.{s}" for s in JOB_SECTORS)
step(
    "c_alts",
    f"SELECT j.job_id, j.zone_id_work, {_SECTORS}, " + ", ".join(f"z.{a}" for a in ACCESS)
    + ", row_number() OVER (ORDER BY j.job_id) - 1 AS idx FROM c_job_zone j "
    "JOIN c_zone_access z ON z.zone_id = j.zone_id_work",
)
step(
    "c_sampled",
    picks_sql("c_choosers", "person_id", "wlcm|alt|1", "(SELECT count(*) FROM c_alts)", K, ", ".join(CHOOSER_COLUMNS)),
)
_JOINED = (
    "SELECT s.* EXCLUDE (idx), a.* EXCLUDE (idx), " + ", ".join(f"k.{c}" for c in INTER)
    + " FROM {picks} s JOIN {alts} a ON a.idx = s.idx LEFT JOIN c_imputed k "
    "ON k.from_zone_id = s.zone_id_home AND k.to_zone_id = a.zone_id_work"
)
step("c_table", _JOINED.format(picks="c_sampled", alts="c_alts"))
step("c_priced", f"SELECT person_id, job_id, {sql_terms(WLCM_GEN_TT_SIMPLE)} AS v FROM c_table")


@query("q_sample_alternatives", "SELECT person_id, job_id FROM c_sampled JOIN c_alts USING (idx)")
def _(m: Model):
    t = wlcm_tables(m)
    return sample_alternatives(
        workplace_choosers(t), workplace_alternatives(t, ACCESS), "person_id", "job_id", K, "wlcm|alt|1"
    )


def wlcm_table(m: Model):
    t = wlcm_tables(m)
    inter = home_work_interactions(t["beam_skims_imputed"]).select("zone_id_home", "zone_id_work", *INTER)
    return choice_table(
        workplace_choosers(t), workplace_alternatives(t, ACCESS), "person_id", "job_id", K, "wlcm|alt|1",
        inter, ["zone_id_home", "zone_id_work"],
    )


_TABLE = [*CHOOSER_COLUMNS, "job_id", "zone_id_work", *JOB_SECTORS]
_MEASURES = [*ACCESS, *INTER]


@query("q_choice_table", f"SELECT {', '.join(_TABLE)}, {round_all(_MEASURES, 9)} FROM c_table", 9)
def _(m: Model):
    return wlcm_table(m).select(*_TABLE, *_MEASURES)


@query(
    "q_wlcm_utilities",
    "SELECT person_id, job_id, round(v, 6) AS v, round(w, 6) AS w FROM (SELECT person_id, job_id, "
    f"{sql_terms(WLCM_GEN_TT_SIMPLE)} AS v, {sql_terms(WLCM_GEN_TT)} AS w FROM c_table)", 6,
)
def _(m: Model):
    return wlcm_table(m).select(
        "person_id", "job_id", utility(WLCM_GEN_TT_SIMPLE).alias("v"), utility(WLCM_GEN_TT).alias("w")
    )


@query(
    "q_mnl_probabilities",
    "SELECT person_id, job_id, round(exp(v - max(v) OVER p) / sum(exp(v - m)) OVER p, 9) AS probability FROM "
    "(SELECT *, max(v) OVER (PARTITION BY person_id) AS m FROM c_priced) WINDOW p AS (PARTITION BY person_id)",
    9,
)
def _(m: Model):
    priced = wlcm_table(m).select("person_id", "job_id", utility(WLCM_GEN_TT_SIMPLE).alias("v"))
    return mnl_probabilities(priced, "person_id", "v").drop("v")


@query("q_draw_choice", draw_sql("c_priced", "person_id", "job_id", "v", u("once", "person_id")))
def _(m: Model):
    priced = wlcm_table(m).select("person_id", "job_id", utility(WLCM_GEN_TT_SIMPLE).alias("v"))
    return draw_choice(priced, "person_id", "job_id", "v", uniform("once", "person_id"))


# ---------------------------------------------------------------- capacity rounds

ROUNDS = 8  # more than the capacity loop takes on the checked data; an idle round adds nothing

for _r in range(1, ROUNDS + 1):
    if _r > 1:
        _before, _old = ("c_choosers", "c_alts") if _r == 2 else (f"c_waiting{_r - 1}", f"c_free{_r - 1}")
        step(
            f"c_waiting{_r}",
            f"SELECT * FROM {_before} WHERE person_id NOT IN (SELECT person_id FROM c_won{_r - 1})",
        )
        step(
            f"c_free{_r}",
            f"SELECT * EXCLUDE (idx), row_number() OVER (ORDER BY job_id) - 1 AS idx FROM {_old} "
            f"WHERE job_id NOT IN (SELECT job_id FROM c_won{_r - 1})",
        )
        step(
            f"c_sampled{_r}",
            picks_sql(f"c_waiting{_r}", "person_id", f"wlcm|alt|{_r}", f"(SELECT count(*) FROM c_free{_r})", K,
                      ", ".join(CHOOSER_COLUMNS)),
        )
        step(f"c_table{_r}", _JOINED.format(picks=f"c_sampled{_r}", alts=f"c_free{_r}"))
        step(
            f"c_priced{_r}", f"SELECT person_id, job_id, {sql_terms(WLCM_GEN_TT_SIMPLE)} AS v FROM c_table{_r}"
        )
    _source = "c_priced" if _r == 1 else f"c_priced{_r}"
    step(f"c_wish{_r}", draw_sql(_source, "person_id", "job_id", "v", u(f"wlcm|draw|{_r}", "person_id")))
    step(
        f"c_won{_r}",
        f"SELECT person_id, job_id, CAST({_r} AS BIGINT) AS round FROM (SELECT *, row_number() OVER (PARTITION BY "
        f"job_id ORDER BY {salted(f'wlcm|prio|{_r}', 'person_id', 0)}, person_id) AS n FROM c_wish{_r}) WHERE n = 1",
    )


@query("q_wlcm_two_rounds", "SELECT * FROM c_won1 UNION ALL SELECT * FROM c_won2")
def _(m: Model):
    return wlcm_simulate(wlcm_tables(m), rounds=2)


@query("q_wlcm", " UNION ALL ".join(f"SELECT * FROM c_won{r}" for r in range(1, ROUNDS + 1)))
def _(m: Model):
    return wlcm_simulate(wlcm_tables(m))


# ---------------------------------------------------------------- wide models

step("c_tod_weights", wide_sql(TOD_CHOICE, "c_tod_features", "person_id"))


@query(
    "q_tod_probabilities",
    "SELECT person_id, " + ", ".join(f"round(e{a} / total, 9) AS p_{a}" for a in TOD_CHOICE.alternatives)
    + " FROM c_tod_weights", 9,
)
def _(m: Model):
    rows = wide_probabilities(tod_features(commuters(m)), TOD_CHOICE)
    return rows.select("person_id", *[f"p_{a}" for a in TOD_CHOICE.alternatives])


@query("q_tod_choice", f"SELECT person_id, {wide_choice(TOD_CHOICE, u('tod', 'person_id'))} AS TOD FROM c_tod_weights")
def _(m: Model):
    return tod_choice_simulate(commuters(m))


_SKIMS = [n for n in MODE_CHOICE.coefficients if "_" in n and not n.endswith("_15")]
_ZONE = ("da_15", "wTrnW_15", "bike_15", "walk_15")
step(
    "c_mode_base",
    "SELECT r.person_id, GEND, AGE, RACE1, JOBS, EDUCA, r.household_id, r.job_id, r.TOD, h.cars AS HHVEH, h.tenure, "
    "h.income AS INCOM, h.persons AS HHSIZ, hp.zone_id AS orig, jp.zone_id AS dest, "
    "coalesce(a.taz1454, 0) AS taz1454, " + ", ".join(f"coalesce(a.{c}, 0) AS {c}" for c in _ZONE) + ", "
    + ", ".join(f"s.{c}" for c in _SKIMS)
    + ", CAST(CASE WHEN h.tenure = 1 THEN 1 ELSE 0 END AS BIGINT) AS OWN FROM c_recoded r "
    "JOIN fx_jobs j ON j.job_id = r.job_id LEFT JOIN fx_households h ON h.household_id = r.household_id "
    "LEFT JOIN fx_buildings hb ON hb.building_id = h.building_id LEFT JOIN fx_parcels hp ON hp.parcel_id = hb.parcel_id "
    "LEFT JOIN fx_buildings jb ON jb.building_id = j.building_id LEFT JOIN fx_parcels jp ON jp.parcel_id = jb.parcel_id "
    "LEFT JOIN fx_zone_accessibility a ON a.taz1454 = hp.zone_id LEFT JOIN c_by_period s ON s.orig = hp.zone_id "
    "AND s.dest = jp.zone_id AND s.TOD = r.TOD",
)
_BASE = ["person_id", "GEND", "AGE", "RACE1", "JOBS", "EDUCA", "household_id", "job_id", "TOD", "HHVEH", "tenure",
         "INCOM", "HHSIZ", "orig", "dest", "taz1454", *_ZONE, *_SKIMS, "OWN"]


def mode_tables(m: Model) -> dict:
    return {**commuters(m), "zone_accessibility": m["zone_accessibility"]}


@query("q_mode_base", f"SELECT {', '.join(_BASE)} FROM c_mode_base")
def _(m: Model):
    return mode_base(mode_tables(m)).select(*_BASE)


step("c_mode_weights", wide_sql(MODE_CHOICE, "c_mode_base", "person_id"))
step(
    "c_modes",
    f"SELECT person_id, {wide_choice(MODE_CHOICE, u('mode', 'person_id'))} AS primary_commute_mode FROM c_mode_weights",
)


@query("q_mode_choice", "SELECT * FROM c_modes")
def _(m: Model):
    return primary_mode_choice_simulate(mode_tables(m)).select("person_id", "primary_commute_mode")


# ---------------------------------------------------------------- estimation


def survey_tables(m: Model) -> dict:
    return {**wlcm_tables(m), **m.tables("survey_persons", "survey_households")}


step(
    "c_survey_own",
    "SELECT o.*, a.idx AS own FROM c_survey o JOIN c_alts a ON a.job_id = o.job_id",
)
_OBS = ("obs_id", "zone_id_home", "no_higher_ed", "own")
step(
    "c_survey_picks",
    "SELECT obs_id, own AS idx, CAST(1 AS BIGINT) AS chosen FROM c_survey_own UNION ALL SELECT obs_id, "
    "CASE WHEN idx >= own THEN idx + 1 ELSE idx END, CAST(0 AS BIGINT) FROM ("
    + picks_sql("c_survey_own", "obs_id", "survey", "((SELECT count(*) FROM c_alts) - 1)", K - 1, "obs_id, own") + ")",
)


@query("q_survey_choice_table", "SELECT obs_id, job_id, chosen FROM c_survey_picks JOIN c_alts USING (idx)")
def _(m: Model):
    rows = survey_choice_table(survey_tables(m), ACCESS, INTER)
    return rows.select("obs_id", "job_id", "chosen")


FIT_TERMS = [["log1p(dist)"], ["log1p(gen_tt_CAR)"]]
FIT_STEPS = 12  # Newton steps in SQL; the last ones change nothing

step(
    "c_fit_known",
    "SELECT p.obs_id, p.chosen, ln(1 + k.dist) AS x, ln(1 + k.gen_tt_CAR) AS y FROM (SELECT s.*, o.zone_id_home FROM c_survey_picks s "
    "JOIN c_survey_own o USING (obs_id)) p JOIN c_alts a ON a.idx = p.idx LEFT JOIN c_imputed k "
    "ON k.from_zone_id = p.zone_id_home AND k.to_zone_id = a.zone_id_work",
)
step(
    "c_fit_rows",
    "SELECT * FROM c_fit_known WHERE obs_id IN (SELECT obs_id FROM c_fit_known GROUP BY obs_id "
    "HAVING sum(chosen) = 1 AND count(*) FILTER (WHERE x + y IS NULL) = 0)",
)
step("c_fit_b0", "SELECT CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS c")
for _i in range(FIT_STEPS + 1):
    step(
        f"c_fit_p{_i}",
        "SELECT obs_id, chosen, x, y, v, m, e / sum(e) OVER w AS p, ln(sum(e) OVER w) AS l FROM (SELECT *, exp(v - m) AS e FROM "
        "(SELECT *, max(v) OVER w AS m FROM (SELECT r.*, b * x + c * y AS v "
        f"FROM c_fit_rows r, c_fit_b{_i}) WINDOW w AS (PARTITION BY obs_id))) WINDOW w AS (PARTITION BY obs_id)",
    )
    step(
        f"c_fit_d{_i}",
        "SELECT sum(ll) AS ll, count(*) AS n, sum(null_) AS null_, sum(cx - mx) AS g, sum(cy - my) AS h, sum(xx - mx * mx) AS xx, "
        "sum(xy - mx * my) AS xy, sum(yy - my * my) AS yy FROM (SELECT sum(chosen * (v - m - l)) AS ll, -ln(count(*)) AS null_, "
        "sum(chosen * x) AS cx, sum(chosen * y) AS cy, sum(p * x) AS mx, sum(p * y) AS my, sum(p * x * x) AS xx, "
        f"sum(p * x * y) AS xy, sum(p * y * y) AS yy FROM c_fit_p{_i} GROUP BY obs_id)",
    )
    step(
        f"c_fit_b{_i + 1}",
        "SELECT b + (yy * g - xy * h) / (xx * yy - xy * xy) AS b, c + (xx * h - xy * g) / (xx * yy - xy * xy) AS c "
        f"FROM c_fit_b{_i}, c_fit_d{_i}",
    )


@query(
    "q_fit_two_terms",
    "SELECT term, round(coef, 6) AS coef, round(std_err, 6) AS std_err, n, round(ll, 6) AS ll, round(null_, 6) AS ll_null, "
    "round(1 - ll / null_, 6) AS r2, round(4 - 2 * ll, 6) AS aic, round(2 * ln(n) - 2 * ll, 6) AS bic, CAST(1 AS BIGINT) AS converged FROM "
    f"(SELECT '{FIT_TERMS[0][0]}' AS term, b AS coef, sqrt(yy / (xx * yy - xy * xy)) AS std_err, ll, null_, n "
    f"FROM c_fit_b{FIT_STEPS}, c_fit_d{FIT_STEPS} UNION ALL "
    f"SELECT '{FIT_TERMS[1][0]}', c, sqrt(xx / (xx * yy - xy * xy)), ll, null_, n FROM c_fit_b{FIT_STEPS}, c_fit_d{FIT_STEPS})",
    6,
)
def _(m: Model):
    rows = survey_choice_table(survey_tables(m), ACCESS, INTER)
    fit = fit_conditional_logit(rows, "obs_id", "chosen", FIT_TERMS, tolerance=1e-14)
    s = fit.summary()
    out = [(r["term"], r["coef"], r["std_err"], s["n"], s["ll"], s["ll_null"], s["r2"], s["aic"], s["bic"], 1) for r in fit.table()]
    return m.spark.createDataFrame(
        out, "term string, coef double, std_err double, n bigint, ll double, ll_null double, r2 double, aic double, bic double, converged int")


@query("q_fit_workplace")
def _(m: Model):
    fit = estimate_workplace_model(survey_tables(m), WLCM_GEN_TT)
    rows = [(r["term"], r["coef"], r["std_err"], r["z"], r["p"]) for r in fit.table()]
    return m.spark.createDataFrame(rows, "term string, coef double, std_err double, z double, p double")
