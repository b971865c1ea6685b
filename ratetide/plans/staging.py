"""Staging models: dedup + light cleaning of the four raw tables (lazy views)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normalize_key, parse_txn_date
from ..functions.fixed_values import MIN_TRANSACTION_DATE
from ..operators.bucket import bucket_dimension, county_lookup
from ..operators.dedup import dedup_latest, dedup_latest_few


def stg_transactions(raw: DataFrame, county_map=None, min_date: str = MIN_TRANSACTION_DATE,
                     strict_dates: bool = True, since: str | None = None) -> DataFrame:
    """One row per transaction: newest version wins, *then* only active rows
    dated on/after ``min_date`` are kept (a sale whose newest row is a
    change/delete disappears).

    ``county_map``: dict (fixed county list, default) or DataFrame(key, value).
    Ingestion columns ``run_date``/``loaded_at`` on the raw rows, when
    present, break ties between reloads of the same version, then every
    other column, so the kept row never depends on file or row order.  The
    wider scan this takes is paid once: the pipeline writes this table.

    ``since`` (``yyyy-MM-dd``) keeps only transactions dated on/after it and
    is applied *before* the dedup shuffle: the version order is the date
    itself, so a transaction's newest version is >= ``since`` exactly when it
    survives the pre-filter, and the result equals filtering afterwards.
    """
    if since is not None:
        raw = raw.filter(F.left(F.col("transaction_date"), F.lit(10)) >= F.lit(str(since)))
    return stage_versions(newest_versions(raw), county_map, min_date, strict_dates)


def version_order(columns: Sequence[str], key: str = "transaction_id") -> list[str]:
    """Columns that rank the versions of a transaction, newest first: the date,
    then ingestion columns, then every other column."""
    order = ["transaction_date"] + [c for c in ("run_date", "loaded_at") if c in columns]
    return order + [c for c in columns if c not in {key, *order}]


def newest_versions(raw: DataFrame) -> DataFrame:
    """The newest raw row per transaction, deletions included."""
    return dedup_latest(raw, ["transaction_id"], version_order(raw.columns), tie_break=[])


def is_staged(min_date: str = MIN_TRANSACTION_DATE) -> Column:
    """Is the newest version of a transaction staged: active and from ``min_date`` on?"""
    return (F.col("record_status") == "A") & (F.left(F.col("transaction_date"), F.lit(10)) >= F.lit(min_date))


def stage_versions(versions: DataFrame, county_map=None, min_date: str = MIN_TRANSACTION_DATE,
                   strict_dates: bool = True) -> DataFrame:
    """Staged rows of the newest versions: active ones from ``min_date`` on."""
    kept = versions.filter(is_staged(min_date))
    mapping = county_lookup() if county_map is None else county_map
    bucketed = bucket_dimension(kept, "county", mapping, "broad_region")
    return bucketed.select(
        "transaction_id", "price",
        parse_txn_date("transaction_date", strict=strict_dates).alias("transaction_date"),
        normalize_key("postcode").alias("postcode"),
        "property_type", "old_new", "duration", "paon", "saon", "street", "locality",
        "town_city", "district",
        F.col("county").alias("region"),
        "broad_region", "ppd_category", "record_status",
    )


def stg_rates(raw: DataFrame) -> DataFrame:
    """Batch policy rates: valid range 0..20, one row per effective date (newest load)."""
    valid = raw.filter(F.col("base_rate").between(0, 20) & F.col("effective_date").isNotNull())
    return dedup_latest(valid.select("effective_date", "base_rate", "source", "loaded_at"),
                        ["effective_date"], ["loaded_at"])


def stg_yields(raw: DataFrame, ticker: str | None = None) -> DataFrame:
    """Daily yields: one row per date (newest load).  ``ticker`` optionally
    restricts to one series (mixed tickers otherwise share the date key)."""
    valid = raw.filter(F.col("date").isNotNull())
    if ticker is not None:
        valid = valid.filter(F.col("ticker") == ticker)
    return dedup_latest_few(valid.select("date", "yield_pct", "ticker", "loaded_at"),
                            ["date"], ["loaded_at"])


def stg_rate_events(raw: DataFrame) -> DataFrame:
    """Streamed rate-change events: at-least-once delivery, latest publish wins."""
    valid = raw.filter(F.col("event_id").isNotNull() & F.col("new_rate").isNotNull())
    return dedup_latest(
        valid.select("event_id", "effective_date", "previous_rate", "new_rate", "published_at"),
        ["event_id"], ["published_at"])
