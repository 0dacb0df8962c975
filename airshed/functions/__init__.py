"""Column builders: classifiers, rounding, time parts, ids."""

from airshed.functions.classify import *  # noqa: F401,F403
from airshed.functions.numeric import count_when, flag, percentage, ratio, round2, round_dp  # noqa: F401
from airshed.functions.timeparts import daily_summary_id, measurement_id, time_parts, ts_text  # noqa: F401
