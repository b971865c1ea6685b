"""Late changes over a long span of dates: bounded folders, the same changes."""

import datetime as dt
import random

import pytest

from ratetide.streaming import late_changes
from ratetide.streaming.late_changes import current_changes, replayed_events
from ratetide.streaming.periods import MOST_FOLDERS, table_width
from test_late_changes import by_force, columns, feed
from test_periods import folders


def observations():
    rng = random.Random(5)
    at = lambda y: dt.date(y, rng.randrange(1, 13), rng.randrange(1, 28))
    few = [(s, at(rng.choice((1999, 2000))), float(rng.randrange(3))) for s in "ab" for _ in range(20)]
    many = [(rng.choice("abc"), at(y), float(rng.randrange(3))) for y in range(1900, 2020) for _ in range(2)]
    return [few, many, [(s, d, r + 1) for s, d, r in few[::3] + many[::9]]]


@pytest.mark.parametrize("lost", [None, 0, 1])
def test_late_changes_over_a_long_span(spark, tmp_dir, monkeypatch, lost):
    """Also where the driver is lost before one of the two rewrites to longer periods."""
    batches = observations()
    feed(spark, tmp_dir, 0, batches[0])
    if lost is not None:
        whole, left = late_changes.publish_periods, [lost]

        def publish(*a):
            if not left[0]:
                raise RuntimeError("lost")
            left[0] -= 1
            whole(*a)

        with monkeypatch.context() as m:
            m.setattr(late_changes, "publish_periods", publish)
            with pytest.raises(RuntimeError):
                feed(spark, tmp_dir, 1, batches[1])
    for n in (1, 2):
        feed(spark, tmp_dir, n, batches[n])
        assert columns(current_changes(spark, tmp_dir)) == columns(replayed_events(spark, tmp_dir)) == by_force(batches[:n + 1])
    for table in ("observations", "ends"):
        assert len(folders(f"{tmp_dir}/{table}")) <= MOST_FOLDERS and table_width(spark, f"{tmp_dir}/{table}") > 1
