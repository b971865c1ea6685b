from .checks import (  # noqa: F401
    AcceptedRange, Between, Check, ColumnExists, DataQualityError, InSet, NoRowsWhere, NotNull,
    RowCountBetween, RowsPerFile, Unique, evaluate, gate, newest_partition, run_checks,
)
from .suites import SUITES  # noqa: F401
from .quarantine import mark_rows, split_rows  # noqa: F401
