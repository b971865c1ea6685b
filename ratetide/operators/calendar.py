"""Calendar-lag context: values N calendar months earlier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_lag(df: DataFrame, month_col: str, value_col: str,
                 lags: Sequence[int] = (1, 2, 3, 6),
                 name=lambda n: f"lag_{n}m") -> DataFrame:
    """One row per month with ``value_col`` at that month and at ``month - N``
    calendar months for every N in ``lags``; NULL when that month has no row
    (a calendar lag, not a row offset).

    ``df`` must hold at most one row per month.  Instead of one self-join per
    lag, every row is fanned out to the months it serves (``m + N``) and one
    aggregation pivots the lags into columns: a single shuffle whose size is
    ``(1 + len(lags)) x months``.  Months that only appear as ``m + N`` carry
    a NULL current value, so a left join from facts on month is exact.
    """
    lags = [int(n) for n in lags]
    fan = F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), F.add_months(F.col(month_col), n).alias("target"))
        for n in [0] + lags
    ]))
    spread = df.select(F.col(value_col).alias("_v"), fan.alias("_f"))
    aggs = [F.max(F.when(F.col("_f.n") == 0, F.col("_v"))).alias(value_col)]
    aggs += [F.max(F.when(F.col("_f.n") == n, F.col("_v"))).alias(name(n)) for n in lags]
    return spread.groupBy(F.col("_f.target").alias(month_col)).agg(*aggs)
