"""Which checks belong to which table (file suites, model tests, assertions)."""

from __future__ import annotations

from .checks import (AcceptedRange, Between, ColumnExists, InSet, NoRowsWhere, NotNull,
                     RowCountBetween, RowsPerFile, Unique)

# FIXED VALUES: the bounds and value sets below are those of the pipeline's
# expectation files and model tests.
PROPERTY_TYPES = ("D", "S", "T", "F", "O")

# landed transaction file
RAW_TRANSACTIONS = [
    ColumnExists("transaction_id"),
    NotNull("transaction_id"),
    # raw files may repeat a sale across reloads: a warning here, an error
    # on the staged table
    Unique("transaction_id", severity="warn"),
    NotNull("price"),
    Between("price", 1, 100_000_000, mostly=0.999),
    NotNull("transaction_date"),
    Between("transaction_date", "1995-01-01", "2030-12-31"),
    InSet("property_type", PROPERTY_TYPES),
    NotNull("county"),
    InSet("record_status", ("A", "C", "D")),
    RowCountBetween(None, 1000, 2_000_000),
]

# landed daily rate file
RAW_RATES = [
    ColumnExists("effective_date"),
    NotNull("effective_date"),
    ColumnExists("base_rate"),
    NotNull("base_rate"),
    Between("base_rate", 0, 20),
    RowCountBetween(None, 1, 10),
]


def per_file(suite: list, min_rows: int | None = None, max_rows: int | None = None) -> list:
    """A file suite for a batch of landed files: its row-count bounds (or the
    given ones) hold for each file instead of for all rows."""
    return [RowsPerFile(None, c.min_value if min_rows is None else min_rows,
                        c.max_value if max_rows is None else max_rows)
            if isinstance(c, RowCountBetween) else c for c in suite]


#: Gates of raw batches in a pipeline run.
RAW_GATES = {"transactions": per_file(RAW_TRANSACTIONS), "rates": per_file(RAW_RATES)}


def no_future_dates(today: str | None = None) -> NoRowsWhere:
    ref = f"DATE'{today}'" if today else "current_date()"
    return NoRowsWhere("transaction_date", f"transaction_date > {ref}", "no_future_dates")


POSITIVE_PRICES = NoRowsWhere("price", "price <= 0", "positive_prices")

LAG_COMPLETENESS = NoRowsWhere(
    "rate_at_month",
    "rate_at_month IS NULL AND month >= DATE'1997-06-01' AND transaction_count > 0",
    "lag_completeness")

SUITES = {
    "raw_transactions": RAW_TRANSACTIONS,
    "raw_rates": RAW_RATES,
    "raw_yields": [NotNull("date")],
    "raw_rate_events": [NotNull("event_id")],
    "stg_transactions": [
        Unique("transaction_id"), NotNull("transaction_id"), NotNull("price"),
        AcceptedRange("price", 1, None, True), NotNull("transaction_date"),
        InSet("property_type", PROPERTY_TYPES), POSITIVE_PRICES,
    ],
    "stg_rates": [Unique("effective_date"), NotNull("effective_date"), NotNull("base_rate"),
                  AcceptedRange("base_rate", 0, 20)],
    "stg_yields": [Unique("date"), NotNull("date"), AcceptedRange("yield_pct", 0, 25)],
    "stg_rate_events": [Unique("event_id"), NotNull("event_id")],
    "int_rates_reconciled": [Unique("effective_date"), NotNull("effective_date"),
                             NotNull("base_rate"), InSet("source_type", ("batch", "streaming"))],
    "int_transactions_with_rates": [Unique("transaction_id"), NotNull("transaction_id"),
                                    NotNull("price"), NotNull("transaction_date")],
    "monthly_transactions_by_region": [
        Unique("month_region_key"), NotNull("month_region_key"), NotNull("month"),
        NotNull("region"), AcceptedRange("transaction_count", 0, None, False),
        AcceptedRange("avg_price", 0, None, False)],
    "rate_change_events": [Unique("effective_date"), NotNull("effective_date"),
                           InSet("direction", ("hike", "cut"))],
    "rate_lag_analysis": [NotNull("month"), NotNull("region"), LAG_COMPLETENESS],
    # the model has no `region` column; its grain is broad_region x property_type
    "regional_sensitivity": [NotNull("broad_region"), NotNull("property_type")],
}
