"""The model graph wired to concrete raw inputs: lazy frames, but for the month
context of the enriched facts and the monthly mart, which are written when the
models that use them are first asked for."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import bindings
from . import enrich, marts, rates, staging


@dataclass
class ModelGraph:
    """Raw tables in, every model out as a DataFrame.

    ``raw`` holds the four raw tables (``transactions``, ``rates``,
    ``rate_events``, ``yields``); ``county_map`` is a dict or a
    DataFrame(key, value) (default: the fixed county list).
    """

    spark: SparkSession
    raw: dict[str, DataFrame]
    county_map: object = None
    lags: tuple[int, ...] = (1, 2, 3, 6)
    min_months: int = 12
    params: dict = field(default_factory=dict)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "ModelGraph":
        """Graph over the raw tables bound from the driver's test tables."""
        return cls(spark, bindings.raw_tables(spark, sf_dir),
                   county_map=bindings.county_map(spark, sf_dir), **kw)

    # ---- staging
    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.raw["transactions"], county_map=self.county_map,
                                        **self.params.get("stg_transactions", {}))

    @cached_property
    def stg_rates(self) -> DataFrame:
        return staging.stg_rates(self.raw["rates"])

    @cached_property
    def stg_yields(self) -> DataFrame:
        return staging.stg_yields(self.raw["yields"])

    @cached_property
    def stg_rate_events(self) -> DataFrame:
        return staging.stg_rate_events(self.raw["rate_events"])

    # ---- intermediate
    @cached_property
    def int_rates_reconciled(self) -> DataFrame:
        return rates.int_rates_reconciled(self.stg_rates, self.stg_rate_events)

    @cached_property
    def transaction_months(self) -> DataFrame:
        raw = self.raw["transactions"]
        since = self.params.get("stg_transactions", {}).get("since")
        if since is not None:  # same pre-filter as staging: only recent months
            raw = raw.filter(F.left(F.col("transaction_date"), F.lit(10)) >= F.lit(str(since)))
        return enrich.raw_transaction_months(raw)

    @cached_property
    def int_transactions_with_rates(self) -> DataFrame:
        return enrich.int_transactions_with_rates(self.stg_transactions,
                                                  self.int_rates_reconciled, self.stg_yields,
                                                  months=self.transaction_months)

    # ---- marts
    @cached_property
    def rate_change_events(self) -> DataFrame:
        return rates.rate_change_events(self.int_rates_reconciled)

    @cached_property
    def monthly_transactions_by_region(self) -> DataFrame:
        return marts.monthly_transactions_by_region(self.int_transactions_with_rates)

    @cached_property
    def monthly_table(self) -> DataFrame:
        """The monthly mart written once (it is read twice by the lag model:
        rows and distinct months), so the fact-side dedup and aggregation
        run once instead of once per use."""
        from ..sinks.writers import materialize

        return materialize(self.monthly_transactions_by_region, "monthly")

    @cached_property
    def rate_lag_analysis(self) -> DataFrame:
        return marts.rate_lag_analysis(self.monthly_table, self.int_rates_reconciled, self.lags)

    @cached_property
    def regional_sensitivity(self) -> DataFrame:
        return marts.regional_sensitivity(self.rate_lag_analysis, self.min_months)
