"""Compaction of the event table: same events, bounded files, lost drivers."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ratetide.plans.staging import stg_rate_events
from ratetide.streaming import compact
from ratetide.streaming.compact import EVENT_SCHEMA, compact_events, held_batches, landed_batches, read_events


def event(i, month, rate, minute, day=5):
    return (f"e{i}", month and dt.date(2020, month, day), None, rate, dt.datetime(2021, 1, 1, 0, minute))


def land(spark, sink, ingest, batch, rows):
    spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{sink}/ingest={ingest}/batch_id={batch}")


def staged(spark, sink, table):
    return sorted(map(tuple, stg_rate_events(read_events(spark, sink, table)).collect()), key=str)


def files(table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table}/**/*.parquet", recursive=True)}


def best(rows):
    """Latest publish, then the greatest date (null last), by force."""
    out = {}
    for r in rows:
        rank = (r[4], r[1] is not None, r[1] or dt.date.min, r[3])
        if r[3] is not None and (r[0] not in out or rank > out[r[0]][0]):
            out[r[0]] = (rank, r)
    return sorted((r for _, r in out.values()), key=str)


BATCHES = [("a", 0, [event(1, 1, 1.0, 1), event(2, 2, 1.0, 1), event(3, 3, 1.0, 1)]),
           ("a", 1, [event(1, 1, 2.0, 2), event(4, None, 1.0, 1), event(2, 2, 0.5, 0), event(5, 5, None, 1)]),
           ("a", 2, []),
           ("b", 0, [event(2, 6, 3.0, 9), event(3, 3, 1.0, 1), event(4, 4, 4.0, 4)]),
           ("b", 1, [event(6, 1, 6.0, 1), event(6, 1, 6.0, 1)])]


def test_every_order_of_compaction_gives_the_same_events(spark, tmp_dir):
    rows = []
    for n, step in enumerate((1, 2, 5)):
        sink, table, rows = f"{tmp_dir}/s{n}", f"{tmp_dir}/t{n}", []
        for i, (ingest, batch, part) in enumerate(BATCHES):
            land(spark, sink, ingest, batch, part)
            rows += part
            if i % step == 0:
                compact_events(spark, sink, table, keep_newest=bool(n))
                assert staged(spark, sink, table) == best(rows)
        compact_events(spark, sink, table, keep_newest=False)
        assert staged(spark, sink, table) == best(rows)
        assert landed_batches(spark, sink) == {"a": [], "b": []} and held_batches(spark, table) == {"a": 2, "b": 1}
        held = spark.read.parquet(table)
        assert held.count() == held.select("event_id").distinct().count() == len(best(rows))
        # e2 moved from February to June, e4 from no month to April
        assert sorted(os.listdir(table))[-1] != "effective_month=2020-02-01"
        assert not os.path.exists(f"{table}/effective_month=2020-02-01")


def test_a_rerun_and_a_replay_change_nothing(spark, tmp_dir):
    sink, table = f"{tmp_dir}/s", f"{tmp_dir}/t"
    assert compact_events(spark, sink, table) == 0 and staged(spark, sink, table) == []
    for b in BATCHES:
        land(spark, sink, *b)
    assert compact_events(spark, sink, table, keep_newest=False) == 5
    before = files(table)
    assert compact_events(spark, sink, table, keep_newest=False) == 0 and files(table) == before
    land(spark, sink, "a", 2, [])  # the newest batch, written again by a restarted ingest
    assert compact_events(spark, sink, table, keep_newest=False) == 0 and landed_batches(spark, sink)["a"] == []
    land(spark, sink, "c", 0, BATCHES[0][2])  # the same messages under a new checkpoint, older than what is held
    assert compact_events(spark, sink, table, keep_newest=False) == 1 and files(table) == before
    land(spark, sink, "c", 1, [event(3, 3, 7.0, 30)])  # one month changes
    compact_events(spark, sink, table, keep_newest=False)
    same = {f for f, t in files(table).items() if before.get(f) == t}
    assert {f for f in before if "2020-03-01" not in f} <= same
    assert staged(spark, sink, table) == best([r for b in BATCHES for r in b[2]] + [event(3, 3, 7.0, 30)])


def test_unfinished_folders_wait(spark, tmp_dir):
    sink, table = f"{tmp_dir}/s", f"{tmp_dir}/t"
    land(spark, sink, "a", 0, BATCHES[0][2])
    land(spark, sink, "a", 1, BATCHES[1][2])
    os.remove(f"{sink}/ingest=a/batch_id=1/_SUCCESS")
    assert compact_events(spark, sink, table, keep_newest=False) == 1
    assert held_batches(spark, table) == {"a": 0} and os.path.exists(f"{sink}/ingest=a/batch_id=1")


class Lost(Exception):
    pass


@pytest.mark.parametrize("name", ["_note", "publish_partitions", "_merge"])
@pytest.mark.parametrize("after", [False, True])
def test_a_lost_driver_loses_no_event(spark, tmp_dir, monkeypatch, name, after):
    sink, table = f"{tmp_dir}/s", f"{tmp_dir}/t"
    for b in BATCHES[:3]:
        land(spark, sink, *b)
    compact_events(spark, sink, table, keep_newest=False)
    for b in BATCHES[3:]:
        land(spark, sink, *b)
    whole = getattr(compact, name)

    def stop(*a, **k):
        if after:
            whole(*a, **k)
        raise Lost

    want = best([r for b in BATCHES for r in b[2]])
    with monkeypatch.context() as m:
        m.setattr(compact, name, stop)
        with pytest.raises(Lost):
            compact_events(spark, sink, table, keep_newest=False)
    assert staged(spark, sink, table) == want
    compact_events(spark, sink, table, keep_newest=False)
    assert staged(spark, sink, table) == want and landed_batches(spark, sink) == {"a": [], "b": []}


def test_the_table_is_not_shuffled(spark, tmp_dir):
    """Held versions are looked up behind a broadcast bitmap."""
    from ratetide.operators.prefilter import semi_join_few

    sink, table = f"{tmp_dir}/s", f"{tmp_dir}/t"
    land(spark, sink, "a", 0, [event(i, i % 12 + 1, 1.0, 1) for i in range(500)])
    compact_events(spark, sink, table, keep_newest=False)
    held = compact._read_table(spark, table)
    few = held.limit(0).unionByName(held.filter(F.col("event_id") == "e7"))
    assert [r.event_id for r in semi_join_few(held, few.select("event_id"), "event_id").collect()] == ["e7"]


def test_command_line(spark, tmp_dir, capsys):
    from ratetide.__main__ import main

    for b in BATCHES:
        land(spark, f"{tmp_dir}/s", *b)
    assert main(["compact", "--sink", f"{tmp_dir}/s", "--table", f"{tmp_dir}/t"], spark) == {"folders": 3}
    main(["run", "--rate-events", f"{tmp_dir}/s", "--events-table", f"{tmp_dir}/t", "--out", f"{tmp_dir}/o",
          "--targets", "stg_rate_events", "--warn", "--shuffle-partitions", "8"], spark)
    want = best([r for b in BATCHES for r in b[2]])
    assert staged(spark, f"{tmp_dir}/s", f"{tmp_dir}/t") == want
