from trilake.operators.dedupe import best_per_key  # noqa: F401
from trilake.operators.finance import (  # noqa: F401
    add_profit_roi, convert_currency, financial_metrics, rate_for, roi_local,
)
from trilake.operators.joins import attach_scalar, cross_scalar, dealt_alike, distinct_keys, keep_known  # noqa: F401
from trilake.operators.multivalue import bridge, id_rows, token_rows  # noqa: F401
from trilake.operators.sample import hash_sample, sample_n, top_then_resort  # noqa: F401
