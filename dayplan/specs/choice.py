"""Published coefficients of the choice models (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class WideLogit:
    """Multinomial logit over a fixed list of alternatives.

    ``coefficients`` maps an attribute to the coefficient it has in the utility of
    each alternative; an alternative that is not listed does not use the attribute.
    """

    name: str
    alternatives: tuple[int, ...]
    coefficients: dict[str, dict[int, float]]

    def attributes(self) -> list[str]:
        return [a for a in self.coefficients if a != "intercept"]


TOD_CHOICE = WideLogit(
    "TOD_choice",
    (2, 3, 12, 13, 14, 22, 23, 24),
    {
        "intercept": {2: -0.7288, 3: -0.3466, 12: 4.2615, 13: 3.8435, 22: 4.0048, 23: 4.0123, 24: 2.9939},
        "da_Time_AM_MD": {12: -0.0237},
        "da_Time_AM_PM": {13: -0.0167},
        "da_Time_AM_EV": {14: -0.0184},
        "da_Time_MD_MD": {22: -0.0371},
        "da_Time_MD_PM": {23: -0.0308},
        "da_Time_MD_EV": {24: -0.0277},
        "sector_constr": {3: 1.2810, 12: 1.0110},
        "sector_mfg": {12: -0.5690, 23: -0.7864},
        "sector_retail": {2: 0.8089, 3: -1.3072, 14: 0.6161, 23: 0.4962, 24: 1.2478},
        "info": {2: -1.6392, 3: -0.8759, 12: -0.8854},
        "finance": {2: -0.7686, 12: -0.9116, 24: -0.8152},
        "scitech": {14: 0.4510},
        "sector_edu_serv": {3: -0.9509, 12: 0.7659, 22: 0.6958, 24: -0.5117},
        "sector_healthcare": {3: -0.6347, 23: -0.6287},
        "sector_oth_serv": {2: -0.8793, 3: -1.1758},
        "sector_gov": {14: -0.4983, 22: -2.0506, 23: -1.2396, 24: -1.2853},
        "age_16less25": {23: 0.6925, 24: 0.9264},
        "female": {2: -0.5590, 3: -0.6831},
        "minority": {14: 0.3354, 24: 0.3887},
        "hh_inc_150kplus": {2: -0.5333, 24: -0.3920},
        "lessGED": {2: 3.1684, 3: 1.8962},
        "GED": {2: 2.5983, 3: 1.0383},
        "somebach": {2: 2.0158, 3: 0.6770},
        "Assoc": {2: 2.3107, 3: 0.9696},
        "Bach": {2: 1.3809},
        "hours": {3: 0.0180, 12: -0.0431, 14: 0.0454, 22: -0.0625, 23: -0.0336, 24: -0.0172},
        "hh_size_1per": {22: 0.6008, 23: 0.3693, 24: 0.3629},
    },
)

AUTO_OWNERSHIP = WideLogit(
    "auto_ownership",
    (0, 1, 2, 3),
    {
        "intercept": {1: 3.7588, 2: 0.9033, 3: -3.2486},
        "income_2": {0: 0.0826},
        "income_4": {0: -0.9485},
        "income_6": {0: -1.5834, 1: -0.5895},
        "income_8": {0: -1.8994, 1: -0.6596},
        "income_10": {1: 1.3189, 2: 2.0529, 3: 2.3368},
        "income_12": {1: 1.3585, 2: 2.3681, 3: 2.7286},
        "income_12p": {1: 1.3104, 2: 2.3772, 3: 2.7486},
        "persons": {1: -0.5580, 2: 0.4012, 3: 1.1028},
        "age_of_head": {1: -0.0192, 2: -0.0260, 3: -0.0192},
        "workers": {1: 0.0924, 2: 0.2270, 3: 0.4511},
        "children": {1: 0.6577, 2: -0.1136, 3: -0.7659},
        "single_family_int": {1: 0.0411, 2: 1.2583, 3: 2.4430},
        "tenure_1": {1: 1.3267, 2: 1.3267, 3: 1.3267},  # one shared coefficient
        "tenure_2": {1: 0.0867, 2: 0.0867, 3: 0.0867},  # one shared coefficient
        "units_10000": {0: -3.494e-07},
        "units_mf_10000": {0: -6.375e-05},
        "hh_10000": {0: 1.504e-06},
        "poor_10000": {0: -0.0002},
        "renters_10000": {0: 0.0001},
        "jobs_10000": {0: -3.454e-06},
        "med_rent_10000": {0: 3.584e-05},
        "pop_white_10000": {0: 5.042e-06},
        "pop_black_10000": {0: 1.213e-05},
        "units_25000": {0: -7.298e-06},
        "units_mf_25000": {0: -9.619e-07},
        "hh_25000": {0: 9.388e-06},
        "poor_25000": {0: 2.269e-05},
        "renters_25000": {0: -1.087e-05},
        "jobs_25000": {0: -1.405e-06},
        "pop_white_25000": {0: 1.864e-06},
        "pop_black_25000": {0: 2.982e-06},
        "prop_singles_500_walk": {0: -0.7168},
        "prop_poor_500_walk": {0: 0.7784},
        "prop_poor_1500_walk": {0: 6.2940},
        "population_40": {0: 2.516e-06},
        "below_jobs_20": {0: 1.711e-06},
        "below_jobs_60": {0: 3.938e-07},
        "employment_20": {0: 8.947e-06},
        "population_20": {0: -2.438e-06},
        "average_income_20": {0: -1.233e-06},
        "above_jobs_40": {0: -2.277e-05},
        "above_jobs_20": {0: -2.986e-05},
    },
)

# Attributes whose coefficient is estimated once for several alternatives
SHARED_COEFFICIENTS = {"auto_ownership": ("tenure_1", "tenure_2")}

MODE_CHOICE = WideLogit(
    "primary_mode_choice",
    (0, 1, 2, 3, 4, 5, 6),
    {
        "intercept": {1: -2.9788, 2: -1.6976, 3: -4.8152, 4: -3.9672, 5: -0.0439, 6: -0.8615},
        "GEND": {2: -0.1894, 3: -0.0494, 4: -0.1433, 5: -0.9269, 6: 0.3186},
        "AGE": {2: -0.0062, 3: 0.0031, 4: -0.0167, 5: -0.0231, 6: -0.0197},
        "RACE1": {2: -0.0514, 3: 0.1119, 4: 0.0775, 5: -0.4819, 6: -0.1268},
        "JOBS": {2: 0.1283, 3: -0.0948, 4: -0.1000, 5: 0.1300, 6: 0.0906},
        "EDUCA": {2: 0.1396, 3: 0.1310, 4: 0.2249, 5: 0.3648, 6: 0.1855},
        "HHVEH": {2: -1.6888, 3: -0.3636, 4: -0.4062, 5: -0.8846, 6: -0.7953},
        "OWN": {2: 0.5212, 3: -0.1171, 4: -0.0730, 5: -0.4562, 6: 0.5794},
        "INCOM": {2: -0.0657, 3: 0.0690, 4: 0.0717, 5: 0.0949, 6: 0.0049},
        "HHSIZ": {2: 0.1685, 3: -0.0485, 4: -0.0734, 5: 0.2215, 6: 0.0760},
        "da_Distance": {0: 0.0956},
        "da_Cost": {0: -0.0004},
        "da_Time": {0: -0.1086},
        "da_15": {1: 8.805e-07},
        "s2_Distance": {1: 0.0315},
        "s2_Cost": {1: 0.0018},
        "s2_Time": {1: -0.0876},
        "wTrnW_Cost": {2: -0.0003},
        "wTrnW_Time": {2: -3.11e-05},
        "wTrnW_15": {2: 9.944e-06},
        "dTrnW_Cost": {3: -6.162e-06},
        "dTrnW_Time": {3: -0.0002},
        "wTrnD_Time": {4: -0.0003},
        "wTrnD_Cost": {5: -7.762e-05},
        "bike_Distance": {5: -0.2822},
        "bike_Time": {5: 0.0013},
        "bike_15": {5: 1.345e-06},
        "walk_Distance": {6: 0.0001},
        "walk_Time": {6: -0.0484},
        "walk_15": {6: 1.049e-05},
    },
)

# Workplace models. A term is (coefficient, factors); factors are SQL expressions
# over the columns of a choice table and are multiplied.
WLCM_GEN_TT_SIMPLE = [
    (-5.204786074426704e-05, ["dist"]),
    (-0.3001866325091665, ["log1p(gen_tt_CAR)"]),
    (-0.08039918766760883, ["log1p(total_jobs_gen_tt_CAR_15)"]),
    (-0.6071897562724802, ["log1p(gen_cost_CAR)", "hh_inc_under_25k"]),
    (-0.42280047602363585, ["log1p(gen_cost_CAR)", "hh_inc_25_to_75k"]),
    (-0.11724034774878948, ["log1p(gen_cost_CAR)", "hh_inc_75_to_200k"]),
    (0.4997846452611589, ["no_higher_ed", "sector_retail"]),
    (-0.983069872053255, ["no_higher_ed", "sector_fire"]),
    (-0.8032630208239648, ["no_higher_ed", "sector_healthcare"]),
    (-1.4570358414787221, ["no_higher_ed", "sector_tech"]),
    (-0.5360336083510515, ["no_higher_ed", "sector_mfg"]),
    (0.976080218987677, ["no_higher_ed", "sector_food_and_hosp"]),
    (-1.4672813755249314, ["no_higher_ed", "sector_edu_serv"]),
    (-0.4066698726321619, ["no_higher_ed", "sector_gov"]),
    (-1.217799589222074, ["sector_retail"]),
    (0.6407385303657774, ["sector_tech"]),
    (-0.551802879345215, ["sector_mfg"]),
    (-1.9391432583361685, ["sector_food_and_hosp"]),
    (1.0759813934846032, ["sector_edu_serv"]),
    (-0.6499749765557833, ["sector_oth_serv"]),
    (-1.2466347773648931, ["sector_constr"]),
    (0.4066330802099743, ["sector_gov"]),
    (-1.93798204460151, ["sector_whlsale"]),
    (-1.1856227094785443, ["sector_admin"]),
    (0.6413224102626847, ["sector_util"]),
]

WLCM_GEN_TT = [
    (0.04496435035298315, ["log1p(gen_tt_CAR)", "log1p(gen_tt_WALK_TRANSIT)"]),
    (-9.9123717053718e-05, ["dist"]),
    (-0.3940080308481324, ["log1p(gen_tt_CAR)"]),
    (9.27582624026469e-06, ["dist", "log1p(gen_tt_CAR)"]),
    (-0.15621664659705028, ["log1p(gen_tt_WALK_TRANSIT)"]),
    (-0.06111003315269964, ["log1p(total_jobs_gen_tt_WALK_TRANSIT_15)"]),
    (-0.4887253865529219, ["log1p(gen_cost_CAR)", "hh_inc_under_25k"]),
    (-0.3936017348363237, ["log1p(gen_cost_CAR)", "hh_inc_25_to_75k"]),
    (-0.15312066816800923, ["log1p(gen_cost_CAR)", "hh_inc_75_to_200k"]),
    (0.30943643186362485, ["no_higher_ed", "sector_retail"]),
    (-1.123189861221489, ["no_higher_ed", "sector_fire"]),
    (-0.7766707874187231, ["no_higher_ed", "sector_healthcare"]),
    (-1.564364724949148, ["no_higher_ed", "sector_tech"]),
    (-0.650242547978425, ["no_higher_ed", "sector_mfg"]),
    (1.0236291219329199, ["no_higher_ed", "sector_food_and_hosp"]),
    (-1.38674466920115, ["no_higher_ed", "sector_edu_serv"]),
    (-0.6528952296841796, ["no_higher_ed", "sector_gov"]),
    (-1.1849390613715483, ["sector_retail"]),
    (0.6547351908168072, ["sector_tech"]),
    (-0.5517078769771097, ["sector_mfg"]),
    (-2.0921088177471874, ["sector_food_and_hosp"]),
    (1.0573995729314252, ["sector_edu_serv"]),
    (-0.6721190810458257, ["sector_oth_serv"]),
    (-1.2509677098100385, ["sector_constr"]),
    (0.43471714518366, ["sector_gov"]),
    (-2.0188011859721087, ["sector_whlsale"]),
    (-1.2373546555095571, ["sector_admin"]),
    (0.84707636954069, ["sector_util"]),
]

WLCM = [
    (-0.11093513765122329, ["dist_da"]),
    (0.00021451856236086276, ["dist_da", "tt_da"]),
    (-0.00010496424117609582, ["tt_wTrnW"]),
    (0.012433512972498234, ["log1p(jobs_1500_walk_retail)"]),
    (-0.5689579090165822, ["log1p(cost_da_toll)", "hh_inc_under_25k"]),
    (-0.47912610162495944, ["log1p(cost_da_toll)", "hh_inc_25_to_75k"]),
    (-0.2584279932612762, ["log1p(cost_da_toll)", "hh_inc_75_to_200k"]),
    (0.3597418473883604, ["no_higher_ed", "sector_retail"]),
    (-1.0086728730402355, ["no_higher_ed", "sector_fire"]),
    (-0.7369829720548989, ["no_higher_ed", "sector_healthcare"]),
    (-1.5648198533852742, ["no_higher_ed", "sector_tech"]),
    (-0.6124782957888832, ["no_higher_ed", "sector_mfg"]),
    (1.1383595140472669, ["no_higher_ed", "sector_food_and_hosp"]),
    (-1.550869736324329, ["no_higher_ed", "sector_edu_serv"]),
    (-0.605108227214032, ["no_higher_ed", "sector_gov"]),
    (0.5762811003442693, ["no_higher_ed", "sector_whlsale"]),
    (-1.2032149449656924, ["sector_retail"]),
    (0.6909571819787215, ["sector_tech"]),
    (-0.5331780597389811, ["sector_mfg"]),
    (-2.0472236323335937, ["sector_food_and_hosp"]),
    (1.1642025300756003, ["sector_edu_serv"]),
    (-0.5929040344799994, ["sector_oth_serv"]),
    (-1.1920636052481741, ["sector_constr"]),
    (0.45496934915313403, ["sector_gov"]),
    (-2.2616850816506138, ["sector_whlsale"]),
    (-1.1840214551890318, ["sector_admin"]),
    (0.5491123085376665, ["sector_util"]),
]

WORKPLACE_MODELS = {
    "WLCM_gen_tt_simple": WLCM_GEN_TT_SIMPLE,
    "WLCM_gen_tt": WLCM_GEN_TT,
    "WLCM": WLCM,
}

WORKER_FILTERS = ["worker = 1", "work_at_home = 0", "zone_id_home is not null"]
SURVEY_FILTERS = ["age < 115", "income < 98", "edu < 98"]
ALTERNATIVES_SAMPLED = 10
