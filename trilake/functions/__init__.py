"""Column expressions: typing of raw text, guarded statistics, KPI text."""
from trilake.functions.clean import (  # noqa: F401
    NULL_LIKE, code, has_text, identifier, known_text, not_negative, real, three_way, token_list, truth, typed, valid_id,
    whole, within,
)
from trilake.functions.stats import safe_corr, weighted_mean  # noqa: F401
from trilake.functions.text import coef_text, count_text, money_text, percent_text  # noqa: F401
