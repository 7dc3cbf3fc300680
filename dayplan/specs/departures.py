"""Fitted departure-time laws per time-of-day code (fixed values).

First digit: period of leaving home, second digit: period of leaving work.
0 = 3-6 h, 1 = 6-9 h, 2 = 9-15.5 h, 3 = 15.5-18.5 h, 4 = 18.5-27 h; codes 2 and 3 leave
home in period 0.
"""

from dayplan.functions.laws import Law

HOME_TO_WORK = {
    2: Law("burr", (104.46, 0.03), 2.13, 3.72, 3.0, 6.0),
    3: Law("genlogistic", (0.08,), 5.86, 0.05, 3.0, 6.0),
    12: Law("vonmises", (0.33,), 7.48, 0.47, 6.0, 9.0),
    13: Law("vonmises", (0.46,), 7.48, 0.47, 6.0, 9.0),
    14: Law("beta", (1.58, 1.14), 5.90, 3.07, 6.0, 9.0),
    22: Law("weibull_min", (0.95,), 9.00, 1.04, 9.0, 15.5),
    23: Law("levy", (), 8.93, 0.30, 9.0, 15.5),
}

WORK_TO_HOME = {
    2: Law("argus", (3.02,), 7.70, 7.66, 9.0, 15.5),
    3: Law("bradford", (8.91,), 15.50, 3.01, 15.5, 18.5),
    12: Law("johnsonsb", (-0.95, 0.71), 8.69, 6.80, 9.0, 15.5),
    13: Law("vonmises", (0.41,), 16.99, 0.47, 15.5, 18.5),
    14: Law("pareto", (19.93,), -0.36, 18.86, 18.5, 27.0),
    22: Law("burr", (263.97, 0.03), -1.00, 16.33, 9.0, 15.5),
    23: Law("triang", (0.90,), 15.17, 3.34, 15.5, 18.5),
    24: Law("bradford", (21.60,), 18.50, 7.76, 18.5, 27.0),
}

# Code 24 leaves home before noon with an exact share, the rest after noon.
EARLY_24 = Law("bradford", (9.63,), 9.00, 2.83, 9.0, 12.0)
LATE_24 = Law("exponweib", (0.05, 21.50), 11.99, 3.23, 12.0, 15.5)
EARLY_24_SHARE = (241, 377)
