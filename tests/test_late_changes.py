"""Change detection with late observations, against all observations in order."""

import datetime as dt
import random

import pytest

from ratetide.streaming import late_changes
from ratetide.streaming.late_changes import apply_batch, current_changes, replayed_events


def by_force(batches):
    known = {}
    for batch in batches:
        now = {}
        for s, d, r in batch:
            if None not in (s, d, r):
                now[s, d] = max(r, now.get((s, d), r))
        known |= now
    out, last = [], {}
    for (s, d), r in sorted(known.items()):
        if last.get(s) != r:
            out.append((s, d, last.get(s), r))
        last[s] = r
    return sorted(out, key=str)


def columns(df):
    return sorted(map(tuple, df.select("series", "effective_date", "previous_rate", "new_rate").collect()), key=str)


def feed(spark, state, n, rows, ingest="a"):
    frame = spark.createDataFrame(rows, "series string, effective_date date, base_rate double")
    apply_batch(spark, frame, state, f"ingest={ingest}/batch_id={n:010d}", f"2024-01-01 00:00:{n:02}")


def day(month, d):
    return dt.date(2020, month, d)


HAND = [
    [("x", day(5, 10), 2.0), ("x", day(5, 20), 2.0), ("y", day(5, 1), 1.0), (None, day(5, 1), 1.0), ("y", None, 1.0), ("y", day(5, 2), None)],
    # late: before all, between two equal ones, in a month of its own
    [("x", day(1, 1), 2.0), ("x", day(5, 15), 3.0), ("x", day(3, 3), 4.0), ("x", day(3, 3), 3.0)],
    # a correction ends changes on both sides; the same row again changes nothing
    [("x", day(5, 15), 2.0), ("x", day(3, 3), 2.0), ("y", day(5, 1), 1.0)],
    [],
    [("x", day(7, 1), 5.0), ("y", day(4, 30), 1.0)],
]


def test_late_rows_alter_and_retract(spark, tmp_dir):
    for n, rows in enumerate(HAND):
        feed(spark, tmp_dir, n, rows)
        want = by_force(HAND[:n + 1])
        assert columns(current_changes(spark, tmp_dir)) == columns(replayed_events(spark, tmp_dir)) == want
    events = spark.read.parquet(f"{tmp_dir}/events").orderBy("batch_id", "effective_date").collect()
    assert {r.retracted for r in events if int(r.batch_id) == 2} == {True}
    assert [r for r in events if int(r.batch_id) == 3] == []
    # y's first change moved a day back: one retraction, one event
    assert [(r.series, r.retracted) for r in events if int(r.batch_id) == 4] == [("y", False), ("y", True), ("x", False)]


def test_any_order_of_arrival(spark, tmp_dir):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), day(rng.randrange(1, 7), rng.randrange(1, 28)), float(rng.randrange(3))) for _ in range(150)]
    batches = [rows[i:i + 50] for i in range(0, 150, 50)]
    for n, batch in enumerate(batches):
        feed(spark, tmp_dir, n, batch)
    want = by_force(batches)
    assert len(want) > 30
    assert columns(current_changes(spark, tmp_dir)) == columns(replayed_events(spark, tmp_dir)) == want


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_batch_done_again_after_a_loss(spark, tmp_dir, monkeypatch, step):
    """Lost before the observations are published, before the ends, after both."""
    feed(spark, tmp_dir, 0, HAND[0])
    whole, left = late_changes._publish, [step]

    def publish(*a):
        if not left[0]:
            raise RuntimeError("lost")
        left[0] -= 1
        whole(*a)

    with monkeypatch.context() as m:
        m.setattr(late_changes, "_publish", publish)
        if step < 2:
            with pytest.raises(RuntimeError):
                feed(spark, tmp_dir, 1, HAND[1])
        else:
            feed(spark, tmp_dir, 1, HAND[1])
    feed(spark, tmp_dir, 1, HAND[1])
    feed(spark, tmp_dir, 2, HAND[2])
    assert columns(current_changes(spark, tmp_dir)) == columns(replayed_events(spark, tmp_dir)) == by_force(HAND[:3])
