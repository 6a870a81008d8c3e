"""Running totals, snapshots and window counts (golden G1 and properties)."""

import datetime as dt

from pyspark.sql import functions as F

from logwise.operators import count_by, sliding_counts, total_intervals, total_snapshots, tumbling_counts
from logwise.plans import log_analysis
from conftest import rows

T0 = dt.datetime(2020, 6, 6, 21, 58, 30)


def _line(level, sec):
    ts = (T0 + dt.timedelta(seconds=sec)).strftime("%Y%m%d%H%M%S")
    return f"[{level}]\tmain\tDate:{ts}"


def g1_frame(spark):
    """Batches of 2 s: 6 errors, then none (two infos), then 3 errors."""
    data = [(1, "[error]")] * 6 + [(2, "[info]")] * 2 + [(3, "[error]")] * 3
    return spark.createDataFrame(data, "batch int, log_level string")


def test_g1_running_totals(spark):
    snaps = total_snapshots(g1_frame(spark), "log_level", "batch")
    got = {(r.batch, r.log_level): r.total for r in snaps.collect()}
    assert [got[(b, "[error]")] for b in (1, 2, 3)] == [6, 6, 9]
    # a key appears from its first batch on
    assert (1, "[info]") not in got and got[(3, "[info]")] == 2


def test_g1_sliding_window(spark):
    # errors of batch k carry event times inside [2(k-1), 2k) seconds after T0
    lines = [_line("error", 0)] * 6 + [_line("info", 2)] * 2 + [_line("error", 4)] * 3
    la = log_analysis(spark.createDataFrame([(x,) for x in lines], "value string"))
    w = la.windows.where(F.col("log_level") == "[error]")
    got = {r.we.replace(tzinfo=None): r.n for r in w.collect()}
    assert got[T0 + dt.timedelta(seconds=2)] == 6
    assert got[T0 + dt.timedelta(seconds=4)] == 6
    assert got[T0 + dt.timedelta(seconds=6)] == 3
    assert {r.log_level: r.n for r in la.totals.collect()} == {"[error]": 9, "[info]": 2}


def test_snapshot_properties(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_type", F.to_date("ts").alias("batch")
    )
    snaps = total_snapshots(ev, "event_type", "batch").collect()
    by_key = {}
    for r in sorted(snaps, key=lambda r: r.batch):
        by_key.setdefault(r.event_type, []).append((r.batch, r.total))
    totals = {r.event_type: r.n for r in count_by(ev, "event_type").collect()}
    last = max(r.batch for r in snaps)
    for k, series in by_key.items():
        vals = [t for _, t in series]
        assert vals == sorted(vals)  # non-decreasing
        assert series[-1] == (last, totals[k])  # last snapshot = total
        days = [b for b, _ in series]
        assert all((b - a).days == 1 for a, b in zip(days, days[1:]))  # no gaps


def test_sliding_sum_is_twice_rows(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    w = sliding_counts(ev, "ts", "event_type", "4 hours", "2 hours")
    assert w.agg(F.sum("n")).first()[0] == 2 * ev.count()
    t = tumbling_counts(ev, "ts", "event_type", "3 hours")
    assert t.agg(F.sum("n")).first()[0] == ev.count()


def test_window_not_multiple_of_slide(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, h), "a") for h in range(6)], "ts timestamp_ntz, k string"
    )
    got = rows(sliding_counts(df, "ts", "k", "3 hours", "2 hours").select(F.hour("ws"), "n"))
    # windows [22,1) [0,3) [2,5) [4,7) hold hours {0} {0,1,2} {2,3,4} {4,5}
    assert got == [(0, 3), (2, 3), (4, 2), (22, 1)]


def test_snapshots_blocked_plan_equals_brute_force(spark):
    import random

    rnd = random.Random(7)
    data = []
    for b in range(200):
        data.append((b, "hot"))  # a key present in every batch
        if rnd.random() < 0.05:
            data.append((b, "rare"))
        if b in (3, 150):
            data.append((b, "two"))  # a gap spanning many blocks
    df = spark.createDataFrame(data, "batch int, k string")
    want = {}
    for k in ("hot", "rare", "two"):
        mine = [b for b, kk in data if kk == k]
        total = 0
        for b in range(min(mine), 200):
            total += mine.count(b)
            want[(b, k)] = total
    for block in (4, 7, 4096):
        got = {(r.batch, r.k): r.total for r in total_snapshots(df, "k", "batch", block=block).collect()}
        assert got == want


def test_snapshots_reject_streams_with_a_pointer(spark):
    import pytest

    s = spark.readStream.format("rate").load().selectExpr("value % 3 as k", "value as batch")
    with pytest.raises(ValueError, match="level_totals_query"):
        total_snapshots(s, "k", "batch")


def test_snapshots_with_null_keys_and_weights(spark):
    data = [("a", 1, 2), (None, 1, 1), (None, 4, 5), ("a", 3, 1), ("b", None, 9)]
    df = spark.createDataFrame(data, "k string, b int, w long")
    count = {(r.b, r.k): r.total for r in total_snapshots(df, "k", "b").collect()}
    assert count == {(1, "a"): 1, (2, "a"): 1, (3, "a"): 2, (4, "a"): 2, (1, None): 1, (2, None): 1, (3, None): 1, (4, None): 2}
    spans = sorted(map(tuple, total_intervals(df, "k", "b", weight="w", block=2).collect()), key=str)
    assert spans == sorted([(1, 2, "a", 2), (3, 4, "a", 3), (1, 3, None, 1), (4, 4, None, 6)], key=str)
