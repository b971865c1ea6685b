from .columns import (  # noqa: F401
    concat_key, deterministic_id, lag_months, month_start, normalize_key, parse_txn_date,
    property_type_label, rate_direction, safe_corr, safe_divide, strip_ws,
)
from .fixed_values import (  # noqa: F401
    CATCH_ALL_REGION, COUNTY_TO_REGION, MIN_TRANSACTION_DATE, PROPERTY_TYPE_LABELS,
    RATE_HISTORY, county_map_rows,
)
