"""Stateful change detection over a stream of observed rates.

Per series key the state holds the last published rate.  Every observation
whose rate differs from that state (or the first one, with no state) emits a
change event with ``previous_rate`` = the state; the state is updated after
the event is emitted.  Event ids are deterministic (series, date, rate), so a
replayed observation maps to the same id and collapses in staging.

State follows **arrival** order across micro-batches; inside a micro-batch
observations are taken in ``effective_date`` order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_SCHEMA = ("series string, event_id string, effective_date date, previous_rate double, "
                 "new_rate double")
STATE_SCHEMA = "last_rate double"


def _changes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState):
    import hashlib

    series = key[0]
    last = state.get[0] if state.exists else None
    frames = [b for b in batches if len(b)]
    if not frames:
        return
    pdf = pd.concat(frames, ignore_index=True).dropna(subset=["base_rate"])
    pdf = pdf.sort_values("effective_date", kind="stable")
    if not len(pdf):
        return
    before = pdf["base_rate"].shift()
    if last is not None:
        before.iloc[0] = last
    pdf = pdf.assign(previous_rate=before)[before.isna() | (before != pdf["base_rate"])]
    if len(pdf):
        state.update((float(pdf["base_rate"].iloc[-1]),))
    ids = [hashlib.sha256(f"{series}|{d}|{r:.6f}".encode()).hexdigest()
           for d, r in zip(pdf["effective_date"], pdf["base_rate"])]
    yield pd.DataFrame({"series": series, "event_id": ids, "effective_date": pdf["effective_date"].tolist(),
                        "previous_rate": pdf["previous_rate"].tolist(), "new_rate": pdf["base_rate"].tolist()})


def detect_changes_stream(observations: DataFrame, series_col: str = "series",
                          published_at: str | None = None) -> DataFrame:
    """``observations``: streaming (or batch) rows ``(series, effective_date,
    base_rate)``.  Returns the change events (append mode) with the time of
    publication (now, unless given), ready for ``events.event_messages``.
    Bound a trigger at the source (``maxFilesPerTrigger``,
    ``maxOffsetsPerTrigger``): what one brings of a series is one group."""
    now = F.current_timestamp() if published_at is None else F.lit(published_at).cast("timestamp")
    obs = observations.select(F.col(series_col).alias("series"), "effective_date", "base_rate")
    return obs.groupBy("series").applyInPandasWithState(
        _changes, OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout).withColumn("published_at", now)
