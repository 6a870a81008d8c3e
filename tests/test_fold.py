"""Folding of additive ledgers: untouched parts, failed folds, readers' marks."""

import datetime as dt
import os
import shutil

import pytest
from conftest import rows, write_lines
from pyspark.sql import functions as F

from logwise.sinks import (
    append_batch,
    compact_months,
    contributions,
    drop_folded,
    fold,
    monthly_ledger,
    monthly_totals,
    read_batches,
    totals,
    write_contributions,
)
from logwise.sources import log_lines
from logwise.sources.storage import newest_mark, put_mark, take_back_marks
from logwise.streaming import (
    drain,
    level_ledger,
    level_totals,
    log_analysis_query,
    window_ledger,
    window_totals,
)
from logwise.streaming import logs as logs_module


def _files(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")
    }


def _month(spark, ledger, batch_id, month, count, word="w"):
    df = spark.createDataFrame([(word, dt.date(2018, month, 5), count)], "word string, date date, count long")
    write_contributions(contributions(df, batch_id), ledger, batch_id)


def test_untouched_months_are_not_rewritten(spark, tmp):
    ledger, comp = f"{tmp}/ledger", f"{tmp}/compacted"
    for b, m in enumerate([7, 8, 9]):
        _month(spark, ledger, b, m, b + 1)
    compact_months(spark, ledger, comp)
    before = _files(f"{comp}/totals")
    _month(spark, ledger, 3, 9, 10)
    compact_months(spark, ledger, comp)
    after = _files(f"{comp}/totals")
    assert {f: t for f, t in after.items() if f in before} == before  # nothing is touched
    new = set(after) - set(before)
    assert new and all("part=201809" in f for f in new)  # only the month with a new batch is written
    assert rows(monthly_totals(spark, ledger, compacted_path=comp).select("month", "count")) == [
        ("201807", 1), ("201808", 2), ("201809", 13)
    ]
    assert fold(spark, monthly_ledger(ledger), comp) is None  # nothing new, nothing written
    assert _files(f"{comp}/totals") == after


def test_compact_delete_add_compact_keeps_totals(spark, tmp):
    ledger, comp = f"{tmp}/ledger", f"{tmp}/compacted"
    total = lambda: rows(monthly_totals(spark, ledger, compacted_path=comp).select("month", "word", "count"))
    want = {}
    for b in range(8):
        _month(spark, ledger, b, 7 + b % 3, b + 1, word="ab"[b % 2])
        key = (f"20180{7 + b % 3}", "ab"[b % 2])
        want[key] = want.get(key, 0) + b + 1
        if b % 2:
            compact_months(spark, ledger, comp)
            drop_folded(spark, monthly_ledger(ledger), comp)
        assert total() == sorted((*k, v) for k, v in want.items())
    left = [d for d, _, _ in os.walk(ledger) if "batch_id=" in d]
    assert len(left) < 8  # folded batches are gone


@pytest.mark.parametrize("fault", ["write", "commit"])
def test_a_failed_fold_blocks_nothing(spark, tmp, monkeypatch, fault):
    from logwise.sinks import fold as package_fold  # noqa: F401
    import sys

    module = sys.modules["logwise.sinks.fold"]
    ledger, comp = f"{tmp}/ledger", f"{tmp}/compacted"
    _month(spark, ledger, 0, 8, 5)
    compact_months(spark, ledger, comp)
    _month(spark, ledger, 1, 8, 7)

    if fault == "commit":

        def broken(*args):
            raise OSError("store is gone")

        with monkeypatch.context() as m:
            m.setattr(module, "put_file", broken)
            with pytest.raises(OSError):
                compact_months(spark, ledger, comp)
    else:  # half of a fold's files, no commit
        os.makedirs(f"{comp}/totals/part=201808/fold=2")
        spark.createDataFrame([("w", dt.date(2018, 8, 5), 999)], "word string, date date, count long").write.mode("append").parquet(
            f"{comp}/totals/part=201808/fold=2"
        )
    read = lambda: rows(monthly_totals(spark, ledger, compacted_path=comp).select("count"))
    assert read() == [(12,)]
    compact_months(spark, ledger, comp)
    assert read() == [(12,)]
    assert not any("_SUCCESS" in f for f in os.listdir(f"{comp}/_commits"))
    for d, _, fs in os.walk(comp):  # clusters that write no success file
        for f in fs:
            if f == "_SUCCESS":
                os.remove(os.path.join(d, f))
    assert read() == [(12,)]
    drop_folded(spark, monthly_ledger(ledger), comp)
    assert read() == [(12,)]


def test_compact_latest_after_a_failed_version(spark, tmp):
    from logwise.streaming import compact_latest, latest_per_key

    schema = "k string, n bigint, batch_id bigint"
    append_batch(spark.createDataFrame([("a", 1)], "k string, n long"), f"{tmp}/t", 0)
    os.makedirs(f"{tmp}/c/version=1")  # what a failed compaction left
    for b in (1, 2):
        compact_latest(spark, f"{tmp}/t", schema, ["k"], ["n"], f"{tmp}/c")
        append_batch(spark.createDataFrame([("a", b + 1)], "k string, n long"), f"{tmp}/t", b)
        assert rows(latest_per_key(spark, f"{tmp}/t", schema, ["k"], ["n"], f"{tmp}/c")) == [("a", b + 1)]
    assert newest_mark(spark, f"{tmp}/c", "version") == 3


def _line(level, second):
    return f"[{level}]\tmain\tDate:20200606{second:06d}"


def test_levels_and_windows_fold(spark, tmp):
    out = f"{tmp}/out"
    ledgers = [level_ledger(f"{out}/levels"), window_ledger(f"{out}/windows", "log_level")]
    for n in range(4):
        # the last file holds a late line of the first minute
        lines = [_line("error", 100 * n + i) for i in range(5)] + [_line("info", 0 if n == 3 else 100 * n)]
        write_lines(f"{tmp}/logs", f"{n}.log", lines, mtime=1_600_000_000 + n)
        drain(log_analysis_query(log_lines(spark, f"{tmp}/logs", stream=True), out, f"{tmp}/ckpt", "4 seconds", "2 seconds"))
        plain = [rows(totals(spark, ledger)) for ledger in ledgers] if n == 0 else plain_after(spark, tmp)
        if n % 2 == 0:
            for i, ledger in enumerate(ledgers):
                assert fold(spark, ledger, f"{tmp}/fold{i}") is not None
                drop_folded(spark, ledger, f"{tmp}/fold{i}")
        got = [rows(totals(spark, ledger, f"{tmp}/fold{i}")) for i, ledger in enumerate(ledgers)]
        assert got == plain
    assert rows(level_totals(spark, f"{out}/levels", folded_path=f"{tmp}/fold0")) == [("[error]", 20), ("[info]", 4)]
    assert rows(window_totals(spark, f"{out}/windows", "log_level", folded_path=f"{tmp}/fold1")) == got[1]


def plain_after(spark, tmp):
    """Levels and windows over the log files themselves."""
    from logwise.plans.apps import log_analysis

    done = log_analysis(log_lines(spark, f"{tmp}/logs"), length="4 seconds", slide="2 seconds")
    return [rows(done.totals), rows(done.windows)]


def test_marks(spark, tmp):
    root = f"{tmp}/m"
    assert newest_mark(spark, root, "batch_id") is None
    take_back_marks(spark, root, "batch_id", 0)
    assert newest_mark(spark, root, "batch_id") == -1
    for n in (0, 1, 2):
        put_mark(spark, root, "batch_id", n)
    assert newest_mark(spark, root, "batch_id") == 2
    assert len([f for f in os.listdir(f"{root}/_finished") if f.startswith("batch_id=")]) == 1
    take_back_marks(spark, root, "batch_id", 2)  # batch 2 is written again
    assert newest_mark(spark, root, "batch_id") == 1


OUTPUTS = {"errors": "log_level string, method string, content string, event_ts timestamp, batch_id bigint",
           "quarantine": "value string, batch_id bigint",
           "levels": "log_level string, n bigint, batch_id bigint",
           "windows": "ws timestamp, we timestamp, log_level string, n bigint, batch_id bigint"}


@pytest.mark.parametrize("failing", range(1, 5))
def test_readers_see_all_outputs_of_a_batch_or_none(spark, tmp, monkeypatch, failing):
    """The batch fails after its ``failing``-th write; then it is replayed."""
    out, lines = f"{tmp}/out", log_lines(spark, _logs(tmp, 0), stream=True)
    start = lambda: drain(log_analysis_query(lines, out, f"{tmp}/ckpt", "4 seconds", "2 seconds"))
    start()
    read = lambda: {k: rows(read_batches(spark, f"{out}/{k}", s)) for k, s in OUTPUTS.items()}
    first = read()
    assert {r[-1] for v in first.values() for r in v} == {0} and all(first.values())
    _logs(tmp, 1)
    written = []

    def breaking(df, path, batch_id, *more):
        append_batch(df, path, batch_id, *more)
        written.append(path)
        if len(written) == failing:
            raise OSError("driver is gone")

    with monkeypatch.context() as m:
        m.setattr(logs_module, "append_batch", breaking)
        with pytest.raises(Exception, match="driver is gone"):
            start()
    assert len(written) == failing
    assert read() == first  # nothing of the second batch
    assert rows(level_totals(spark, f"{out}/levels")) == [("[error]", 2), ("short", 1)]
    start()
    both = read()
    assert {r[-1] for v in both.values() for r in v} == {0, 1}
    assert rows(level_totals(spark, f"{out}/levels")) == [("[error]", 4), ("short", 2)]
    assert spark.read.parquet(f"{out}/errors").where(F.col("batch_id") == 1).count() == 2
    shutil.rmtree(out)


def _logs(tmp, n):
    lines = [_line("error", 100 * n), _line("error", 100 * n + 1), "short"]
    write_lines(f"{tmp}/logs", f"{n}.log", lines, mtime=1_600_000_000 + n)
    return f"{tmp}/logs"
