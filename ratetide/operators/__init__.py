from .asof import asof_lookup, step_intervals  # noqa: F401
from .bucket import bucket_dimension, county_lookup  # noqa: F401
from .calendar import calendar_lag  # noqa: F401
from .changes import detect_changes  # noqa: F401
from .dedup import dedup_latest  # noqa: F401
