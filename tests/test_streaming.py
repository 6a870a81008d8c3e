"""Streaming forms: golden G1 by micro-batches, stream == batch, restart, replay."""

import datetime as dt
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from logwise.operators import sliding_counts
from logwise.sinks import monthly_totals
from logwise.sources import RefreshingDictionary, log_lines, log_lines_from_events
from logwise.streaming import (
    comment_counts_query,
    drain,
    error_log_query,
    latest_per_key,
    level_snapshots,
    level_totals,
    level_totals_query,
    sliding_counts_query,
    window_totals,
)
from conftest import rows, write_lines

T0 = dt.datetime(2020, 6, 6, 21, 58, 30)


def _line(level, sec, method="main"):
    ts = (T0 + dt.timedelta(seconds=sec)).strftime("%Y%m%d%H%M%S")
    return f"[{level}]\t{method}\tDate:{ts}"


def _g1_files(folder):
    base = 1_600_000_000
    write_lines(folder, "b1.log", [_line("error", 0)] * 6, mtime=base)
    write_lines(folder, "b2.log", [_line("info", 2)] * 2, mtime=base + 10)
    write_lines(folder, "b3.log", [_line("error", 4)] * 3 + ["[warn]\tshort"], mtime=base + 20)


def test_g1_running_totals_per_micro_batch(spark, tmp):
    _g1_files(f"{tmp}/logs")
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log", max_files_per_trigger=1)
    levels = lines.select(F.get(F.split("value", "\t"), 0).alias("log_level"))
    drain(level_totals_query(levels, "log_level", f"{tmp}/out", f"{tmp}/ck", mode="complete"))
    ledger = spark.read.schema("log_level string, n bigint, batch_id bigint").parquet(f"{tmp}/out")
    errors = {r.batch_id: r.n for r in ledger.where("log_level = '[error]'").collect()}
    assert [errors[b] for b in sorted(errors)] == [6, 6, 9]  # every key in every batch


def test_g1_error_sink_and_quarantine(spark, tmp):
    _g1_files(f"{tmp}/logs")
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log", max_files_per_trigger=1)
    drain(error_log_query(lines, f"{tmp}/err", f"{tmp}/ck", quarantine_path=f"{tmp}/bad"))
    err = spark.read.schema(
        "log_level string, method string, content string, event_ts timestamp, batch_id bigint"
    ).parquet(f"{tmp}/err")
    assert {r.batch_id: r.c for r in err.groupBy("batch_id").agg(F.count("*").alias("c")).collect()} == {0: 6, 2: 3}
    bad = spark.read.schema("value string, batch_id bigint").parquet(f"{tmp}/bad")
    assert [r.value for r in bad.collect()] == ["[warn]\tshort"]


def test_g1_sliding_window_stream(spark, tmp):
    _g1_files(f"{tmp}/logs")
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log", max_files_per_trigger=1)
    from logwise.operators import log_records

    recs = log_records(lines)
    drain(sliding_counts_query(recs, "log_level", f"{tmp}/w", f"{tmp}/ck", "4 seconds", "2 seconds"))
    w = window_totals(spark, f"{tmp}/w", "log_level").where("log_level = '[error]'")
    got = sorted((r.we.replace(tzinfo=None) - T0).seconds for r in w.collect() for _ in range(r.n))
    # windows ending after batches 1..3 hold 6, 6, 3; the one ending at 8 s
    # (the next batch) still holds the last 3
    assert got == [2] * 6 + [4] * 6 + [6] * 3 + [8] * 3


def test_stream_equals_batch_over_event_files(spark, tmp):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    # one file per day, written in time order, streamed one file per batch
    (ev.withColumn("day", F.dayofmonth("ts")).repartition("day").write.partitionBy("day").parquet(f"{tmp}/ev"))
    days = sorted(int(d.split("=")[1]) for d in os.listdir(f"{tmp}/ev") if d.startswith("day="))
    for i, d in enumerate(days):
        for f in os.listdir(f"{tmp}/ev/day={d}"):
            os.utime(f"{tmp}/ev/day={d}/{f}", (1_600_000_000 + i, 1_600_000_000 + i))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true"
    ).option("pathGlobFilter", "*.parquet").parquet(f"{tmp}/ev")
    drain(
        sliding_counts_query(
            stream, "event_type", f"{tmp}/w", f"{tmp}/ck", "4 hours", "2 hours", time_col="ts"
        )
    )
    got = window_totals(spark, f"{tmp}/w", "event_type").select(F.col("ws").cast("timestamp_ntz"), F.col("we").cast("timestamp_ntz"), "event_type", "n")
    want = sliding_counts(ev, "ts", "event_type", "4 hours", "2 hours")
    assert rows(got) == rows(want)


def test_restart_continues_from_checkpoint(spark, tmp):
    base = 1_600_000_000
    write_lines(f"{tmp}/logs", "a.log", [_line("error", 0)] * 2 + [_line("info", 0)], mtime=base)
    lines = lambda: log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log")
    levels = lambda: lines().select(F.get(F.split("value", "\t"), 0).alias("log_level"))
    drain(level_totals_query(levels(), "log_level", f"{tmp}/out", f"{tmp}/ck"))
    write_lines(f"{tmp}/logs", "b.log", [_line("error", 9)] * 3, mtime=base + 5)
    drain(level_totals_query(levels(), "log_level", f"{tmp}/out", f"{tmp}/ck"))  # restart
    totals = latest_per_key(spark, f"{tmp}/out", "log_level string, n bigint, batch_id bigint", ["log_level"], ["n"])
    assert rows(totals) == [("[error]", 5), ("[info]", 1)]


def test_comment_stream_with_refreshing_dictionary(spark, tmp):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.select("text").write.parquet(f"{tmp}/docs")
    words = ["the", "und", "la", "widget"]
    dictionary = RefreshingDictionary(spark, lambda: spark.createDataFrame([(w,) for w in words], "word string"))
    comments = spark.readStream.schema("text string").parquet(f"{tmp}/docs").select(
        F.col("text").alias("value"), F.lit(dt.datetime(2024, 3, 5, 12)).cast("timestamp").alias("timestamp")
    )
    drain(comment_counts_query(comments, dictionary, f"{tmp}/ledger", f"{tmp}/ck"))
    totals = monthly_totals(spark, f"{tmp}/ledger")
    got = rows(totals.select("word", "n" if "n" in totals.columns else "count"))
    tokens = docs.select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("w"))
    want = rows(tokens.where(F.col("w").isin(words)).groupBy("w").agg(F.count("*")))
    assert got == want
    assert {r.month for r in totals.collect()} == {"202403"}
    assert dictionary.loads == 1


def test_error_stream_from_events_matches_filter(spark, tmp):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    log_lines_from_events(ev, keep=()).select("value").repartition(3).write.text(f"{tmp}/logs")
    stream = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.txt", max_files_per_trigger=1)
    drain(error_log_query(stream, f"{tmp}/out", f"{tmp}/ck", sql="select * from batch_rows where log_level='[error]'"))
    out = spark.read.schema(
        "log_level string, method string, content string, event_ts timestamp, batch_id bigint"
    ).parquet(f"{tmp}/out")
    assert out.count() == ev.where("event_type = 'error'").count()
    assert out.select("batch_id").distinct().count() == 3


def test_log_analysis_app_drains_and_reports_metrics(spark, tmp):
    from logwise.streaming import start_log_analysis

    _g1_files(f"{tmp}/logs")
    q = drain(
        start_log_analysis(
            spark, f"{tmp}/logs", f"{tmp}/out", f"{tmp}/ck", trigger=None, glob="*.log", max_files_per_trigger=1
        )
    )
    metrics = [p["observedMetrics"].get("log_lines") for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["lines"] for m in metrics) == 12 and sum(m["quarantined"] for m in metrics) == 1
    levels = f"{tmp}/out/levels"
    assert rows(level_totals(spark, levels)) == [("[error]", 9), ("[info]", 2), ("[warn]", 1)]
    assert rows(level_totals(spark, levels, through=0)) == [("[error]", 6)]
    # the worked example: running errors 6, 6, 9; windows hold 6, 6, 3
    errors = {r.batch_id: r.n for r in level_snapshots(spark, levels).where("log_level = '[error]'").collect()}
    assert [errors[b] for b in sorted(errors)] == [6, 6, 9]
    windows = window_totals(spark, f"{tmp}/out/windows", "log_level")
    ends = sorted((r.we.replace(tzinfo=None) - T0).seconds for r in windows.where("log_level = '[error]'").collect() for _ in range(r.n))
    assert ends == [2] * 6 + [4] * 6 + [6] * 3 + [8] * 3
    assert windows.agg(F.sum("n")).first()[0] == 2 * 12  # the incomplete line included
    err = spark.read.schema("log_level string, batch_id bigint").parquet(f"{tmp}/out/errors")
    assert rows(err.groupBy("batch_id").count()) == [(0, 6), (2, 3)]
    bad = spark.read.schema("value string, batch_id bigint").parquet(f"{tmp}/out/quarantine")
    assert bad.count() == 1


def test_arrival_time_windows(spark, tmp):
    write_lines(f"{tmp}/logs", "a.log", [_line("error", 0)] * 4 + [_line("info", 0)], mtime=1_600_000_000)
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log")
    from logwise.operators import log_records

    drain(sliding_counts_query(log_records(lines), "log_level", f"{tmp}/w", f"{tmp}/ck", "4 seconds", "2 seconds", time_col=None))
    w = spark.read.schema("ws timestamp, we timestamp, log_level string, n bigint, batch_id bigint").parquet(f"{tmp}/w")
    # arrival time = processing time: two windows of 4 s hold the batch, far from the 2020 event times
    got = w.where("log_level = '[error]'").collect()
    assert sorted(r.n for r in got) == [4, 4]
    assert all(r.ws.year > 2020 for r in got)


def test_failed_batch_replayed_after_restart_counts_once(spark, tmp, monkeypatch):
    import logwise.streaming.comments as comments_mod

    base = 1_600_000_000
    for i, texts in enumerate([["a b", "a"], ["a c", "b b"], ["c"]]):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.parquet(f"{tmp}/in/{i}")
        for root, _, files in os.walk(f"{tmp}/in/{i}"):
            for f in files:
                os.utime(os.path.join(root, f), (base + i, base + i))
    real_write = comments_mod.write_contributions
    state = {"failed": False}

    def flaky_write(rows, path, batch_id):
        real_write(rows, path, batch_id)
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("executor lost after the write")

    monkeypatch.setattr(comments_mod, "write_contributions", flaky_write)
    dictionary = RefreshingDictionary(spark, lambda: spark.createDataFrame([("a",), ("b",), ("c",)], "word string"))

    def stream():
        return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", "true"
        ).option("pathGlobFilter", "*.parquet").parquet(f"{tmp}/in").select(
            "value", F.lit(dt.datetime(2024, 1, 2)).cast("timestamp").alias("timestamp")
        )

    q = comment_counts_query(stream(), dictionary, f"{tmp}/ledger", f"{tmp}/ck")
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the injected failure
        pass
    assert q.exception() is not None and state["failed"]
    drain(comment_counts_query(stream(), dictionary, f"{tmp}/ledger", f"{tmp}/ck"))  # restart
    totals = rows(monthly_totals(spark, f"{tmp}/ledger").select("word", "count"))
    assert totals == [("a", 3), ("b", 2), ("c", 2)]


# Golden G3 (FIXTURES.md): lines per level in five log files named by their time.
G3_FILES = {
    "20200606215836": {"error": 4, "warn": 1, "info": 3, "debug": 2},
    "20200606215839": {"error": 1, "warn": 4, "info": 4, "debug": 1},
    "20200606215842": {"error": 5, "warn": 2, "info": 2, "debug": 1},
    "20200606215845": {"error": 5, "warn": 3, "info": 1, "debug": 1},
    "20200606215846": {"error": 1, "warn": 5, "info": 1, "debug": 3},
}
G3_WINDOWS = {  # window start second -> error, warn, info, debug
    34: (4, 1, 3, 2),
    36: (5, 5, 7, 3),
    38: (1, 4, 4, 1),
    40: (5, 2, 2, 1),
    42: (10, 5, 3, 2),
    44: (6, 8, 2, 4),
    46: (1, 5, 1, 3),
}


def test_g3_sample_logs_totals_and_windows(spark, tmp):
    methods = ["main", "calculate", "saveFile", "openFile"]
    for i, (stamp, counts) in enumerate(G3_FILES.items()):
        lines = [
            f"[{level}]\t{methods[j % 4]}\tDate:{stamp}"
            for level, n in counts.items()
            for j in range(n)
        ]
        write_lines(f"{tmp}/logs", f"{stamp}.log", lines, mtime=1_591_480_000 + i)
    drain(start_log_analysis_once(spark, tmp, ""))
    totals = level_totals(spark, f"{tmp}/out/levels")
    assert {r.log_level: r.n for r in totals.collect()} == {"[error]": 16, "[warn]": 15, "[info]": 11, "[debug]": 8}
    w = window_totals(spark, f"{tmp}/out/windows", "log_level")
    got = {}
    for r in w.collect():
        got.setdefault(r.ws.second, {})[r.log_level] = r.n
    want = {
        s: {f"[{lvl}]": n for lvl, n in zip(("error", "warn", "info", "debug"), counts) if n}
        for s, counts in G3_WINDOWS.items()
    }
    assert got == want
    errors = spark.read.schema(
        "log_level string, method string, content string, event_ts timestamp, batch_id bigint"
    ).parquet(f"{tmp}/out/errors")
    assert errors.count() == 16 and errors.select("batch_id").distinct().count() == 5


def test_file_sink_modes(spark, tmp):
    from logwise.operators import log_records

    _g1_files(f"{tmp}/logs")
    lines = lambda: log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log", max_files_per_trigger=1)
    drain(error_log_query(lines(), f"{tmp}/err", f"{tmp}/ck1", sql="select * from batch_rows where log_level='[error]'", sink="files"))
    err = spark.read.parquet(f"{tmp}/err")
    assert err.count() == 9 and set(err.columns) == {"log_level", "method", "content", "event_ts"}
    drain(
        sliding_counts_query(
            log_records(lines()), "log_level", f"{tmp}/w", f"{tmp}/ck2", "4 seconds", "2 seconds",
            watermark="0 seconds", sink="files",
        )
    )
    w = spark.read.parquet(f"{tmp}/w").where("log_level = '[error]'")
    # append mode writes a window once the watermark (the latest event time) passed its end
    got = sorted(((r.we.replace(tzinfo=None) - T0).seconds, r.n) for r in w.collect())
    assert got == [(2, 6), (4, 6)]


def test_state_partitions_apply_to_the_query_only(spark, tmp):
    _g1_files(f"{tmp}/logs")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log")
    levels = lines.select(F.get(F.split("value", "\t"), 0).alias("log_level"))
    drain(level_totals_query(levels, "log_level", f"{tmp}/out", f"{tmp}/ck", state_partitions=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = [d for d in os.listdir(f"{tmp}/ck/state/0") if d.isdigit()]
    assert len(state) == 3


def test_snapshot_at_last_batch_has_every_key(spark, tmp):
    from logwise.streaming import last_batch_id, snapshot_at

    _g1_files(f"{tmp}/logs")
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log", max_files_per_trigger=1)
    levels = lines.select(F.get(F.split("value", "\t"), 0).alias("log_level"))
    assert last_batch_id(spark, f"{tmp}/out") is None
    drain(level_totals_query(levels, "log_level", f"{tmp}/out", f"{tmp}/ck", mode="complete"))
    # a restart without new data does not move the newest batch
    drain(level_totals_query(levels, "log_level", f"{tmp}/out", f"{tmp}/ck", mode="complete"))
    last = last_batch_id(spark, f"{tmp}/out")
    assert last == 2
    snap = snapshot_at(spark, f"{tmp}/out", "log_level string, n bigint, batch_id bigint", last)
    # [info] had no rows in the last batch and is still there
    assert rows(snap) == [("[error]", 9), ("[info]", 2), ("[warn]", 1)]


def test_substring_stream_over_a_refreshing_dictionary(spark, tmp):
    base = 1_600_000_000
    texts = [["the cat", "a theme"], ["catalog", "dog"], ["other", "the"]]
    for i, batch in enumerate(texts):
        spark.createDataFrame([(t,) for t in batch], "value string").coalesce(1).write.parquet(f"{tmp}/in/{i}")
        for root, _, files in os.walk(f"{tmp}/in/{i}"):
            for f in files:
                os.utime(os.path.join(root, f), (base + i, base + i))
    words = ["the", "cat", "dog", "hem", "ot", "log", "her", "a", "x", "zz"]  # over the contains limit
    dictionary = RefreshingDictionary(spark, lambda: spark.createDataFrame([(w,) for w in words], "word string"))
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true"
    ).option("pathGlobFilter", "*.parquet").parquet(f"{tmp}/in").select(
        "value", F.lit(dt.datetime(2024, 5, 1)).cast("timestamp").alias("timestamp")
    )
    q = drain(comment_counts_query(stream, dictionary, f"{tmp}/ledger", f"{tmp}/ck", method="substrings"))
    assert len(q.recentProgress) >= 3 and dictionary.loads == 1
    got = rows(monthly_totals(spark, f"{tmp}/ledger").select("word", "count"))
    flat = [t for batch in texts for t in batch]
    want = sorted((w, sum(1 for t in flat if w in t)) for w in words if any(w in t for t in flat))
    assert got == want


def test_empty_dictionary_counts_nothing(spark):
    from logwise.operators import word_document_counts

    docs = spark.createDataFrame([("a b",)], "text string")
    for method in ("spaces", "dictionary", "substrings"):
        out = word_document_counts(docs, [], method=method)
        assert out.columns == ["word", "n"] and out.count() == 0


def test_console_sink_runs_on_running_totals(spark, tmp):
    from logwise.functions import ngrams
    from logwise.operators import count_by
    from logwise.streaming import console_query

    _g1_files(f"{tmp}/logs")
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log")
    levels = lines.select(F.get(F.split("value", "\t"), 0).alias("log_level"))
    q = drain(console_query(count_by(levels, "log_level"), f"{tmp}/ck", mode="complete"))
    assert q.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")
    assert spark.createDataFrame([("abcd",)], "t string").select(ngrams("t").alias("g")).first().g == ["abc", "bcd"]


def test_rocksdb_state_store_gives_the_same_totals(spark, tmp):
    _g1_files(f"{tmp}/logs")
    lines = log_lines(spark, f"{tmp}/logs", stream=True, glob="*.log", max_files_per_trigger=1)
    levels = lines.select(F.get(F.split("value", "\t"), 0).alias("log_level"))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    drain(level_totals_query(levels, "log_level", f"{tmp}/out", f"{tmp}/ck", state_partitions=2, state_store="rocksdb"))
    assert spark.conf.get(key, None) == before
    totals = latest_per_key(spark, f"{tmp}/out", "log_level string, n bigint, batch_id bigint", ["log_level"], ["n"])
    assert rows(totals) == [("[error]", 9), ("[info]", 2), ("[warn]", 1)]
    meta = open(f"{tmp}/ck/offsets/0").read()
    assert "RocksDBStateStoreProvider" in meta


def test_batch_time_dates_come_from_the_offset_log(spark, tmp):
    import json

    spark.createDataFrame([("狗 酒",), ("狗",)], "value string").write.parquet(f"{tmp}/in")
    dictionary = RefreshingDictionary(spark, lambda: spark.createDataFrame([("狗",), ("酒",)], "word string"))
    stream = spark.readStream.schema("value string").parquet(f"{tmp}/in")
    drain(comment_counts_query(stream, dictionary, f"{tmp}/ledger", f"{tmp}/ck", time_col=None))
    meta = json.loads(open(f"{tmp}/ck/offsets/0").read().splitlines()[1])
    batch_day = dt.datetime.fromtimestamp(meta["batchTimestampMs"] / 1000, dt.timezone.utc).date()
    got = rows(monthly_totals(spark, f"{tmp}/ledger").select("word", "date", "count"))
    assert got == [("狗", batch_day, 2), ("酒", batch_day, 1)]


def test_compact_latest_then_newer_batches(spark, tmp):
    from logwise.sinks import append_batch
    from logwise.streaming import compact_latest

    schema = "k string, n bigint, batch_id bigint"
    batches = [[("a", 1), ("b", 5)], [("a", 3)], [("c", 2)]]
    for i, b in enumerate(batches):
        append_batch(spark.createDataFrame(b, "k string, n bigint"), f"{tmp}/ledger", i)
    compact_latest(spark, f"{tmp}/ledger", schema, ["k"], ["n"], f"{tmp}/compacted")
    append_batch(spark.createDataFrame([("b", 7)], "k string, n bigint"), f"{tmp}/ledger", 3)  # after compaction
    want = rows(latest_per_key(spark, f"{tmp}/ledger", schema, ["k"], ["n"]))
    got = rows(latest_per_key(spark, f"{tmp}/ledger", schema, ["k"], ["n"], compacted_path=f"{tmp}/compacted"))
    assert got == want == [("a", 3), ("b", 7), ("c", 2)]


def test_stream_ignores_files_older_than_start(spark, tmp):
    write_lines(f"{tmp}/logs", "old.log", [_line("error", 0)] * 4, mtime=1_500_000_000)
    write_lines(f"{tmp}/logs", "new.log", [_line("error", 2)] * 2, mtime=1_700_000_000)
    lines = log_lines(
        spark, f"{tmp}/logs", stream=True, glob="*.log", ignore_existing_before=dt.datetime(2020, 1, 1)
    )
    drain(error_log_query(lines, f"{tmp}/out", f"{tmp}/ck", sink="files"))
    assert spark.read.parquet(f"{tmp}/out").count() == 2


def test_table_streams_over_a_folder_of_parts_equal_their_batch_twins(spark, tmp, duck, monkeypatch):
    """The three table-stream keys on tables of many part files, in several
    micro-batches, the oldest events last."""
    import __spark_entry__ as entry
    from logwise.plans import catalog
    from logwise.sources import table_stream

    small = "/root/testdata/sf0.001"
    for name, order in (("events", F.desc("ts")), ("documents", F.col("doc_id"))):
        df = spark.read.parquet(f"{small}/{name}.parquet")
        parts = [df.orderBy(order).offset(i * df.count() // 5).limit(df.count() // 5 + 1) for i in range(5)]
        whole = df.count()
        numbered = df.withColumn("_i", F.row_number().over(Window.orderBy(order)))
        for i in range(5):
            lo, hi = i * whole // 5, (i + 1) * whole // 5
            part = numbered.where((F.col("_i") > lo) & (F.col("_i") <= hi)).drop("_i").coalesce(1)
            part.write.mode("append").parquet(f"{tmp}/{name}.parquet")
            for f in os.listdir(f"{tmp}/{name}.parquet"):
                p = os.path.join(f"{tmp}/{name}.parquet", f)
                if f.startswith("part-") and os.path.getmtime(p) > 1_650_000_000:
                    os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{tmp}/benchmark.parquet")
    batches = []

    def one_file(spark_, d, name, max_files_per_trigger=1):
        batches.append(name)
        return table_stream(spark_, d, name, max_files_per_trigger)

    monkeypatch.setattr(catalog, "table_stream", one_file)
    con = duck(small)
    for key in ("level_totals_stream", "sliding_level_counts_stream", "comment_word_counts_stream"):
        got = entry.queries()[key](spark, tmp)
        cols = sorted(got.columns)
        cur = con.execute(entry.oracle_sql()[key])
        names = [x[0] for x in cur.description]
        want = sorted(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
        assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == want, key
    assert len(batches) == 3


def test_window_contributions_keep_late_and_malformed_lines(spark, tmp):
    base = 1_600_000_000
    write_lines(f"{tmp}/logs", "new.log", [_line("error", 4000)] * 5, mtime=base)
    write_lines(f"{tmp}/logs", "mid.log", ["[warn]\tshort", "", "[warn]\tm\tDate:2020"], mtime=base + 1)
    write_lines(f"{tmp}/logs", "old.log", [_line("error", 0)] * 7, mtime=base + 2)
    for attempt in range(2):  # a second run from the start gives the same windows
        q = drain(start_log_analysis_once(spark, tmp, attempt))
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    a, b = (rows(window_totals(spark, f"{tmp}/out{i}/windows", "log_level")) for i in range(2))
    assert a == b and sum(r[3] for r in a) == 2 * 15
    assert sum(r[3] for r in a if r[2] == "[warn]") == 2 * 2 and sum(r[3] for r in a if r[2] == "") == 2


def start_log_analysis_once(spark, tmp, i):
    from logwise.streaming import start_log_analysis

    return start_log_analysis(
        spark, f"{tmp}/logs", f"{tmp}/out{i}", f"{tmp}/ck{i}", trigger=None, glob="*.log", max_files_per_trigger=1
    )


def test_stateful_windows_need_an_explicit_watermark(spark, tmp):
    import pytest

    stream = spark.readStream.schema("ts timestamp, k string").parquet(tmp)
    with pytest.raises(ValueError):
        sliding_counts_query(stream, "k", f"{tmp}/o", f"{tmp}/c", "4 seconds", "2 seconds", time_col="ts", sink="updates")


def test_comment_pipeline_through_a_failing_service(spark, tmp):
    """Calls fail one, two and three times: the whole pipeline from comments
    to monthly totals, the lost comments on the error output. The joint call
    is one of the three sends of a comment."""
    import json

    def fetch(texts):
        path = f"{tmp}/calls"
        os.makedirs(path, exist_ok=True)
        out = []
        for t in texts:
            word = t.split(" ")[0]
            fails = {"once": 1, "twice": 2, "always": 9}.get(word, 0)
            log = f"{path}/{word}"
            seen = os.path.getsize(log) if os.path.exists(log) else 0
            if seen < fails:
                with open(log, "a") as f:
                    f.write("x")
                raise ConnectionError(word)
            code = 500 if word == "refused" else 200
            out.append((code, json.dumps({"ret": 0, "msg": "OK", "terms": t})))
        return out

    comments = ['once cat "q"', "twice cat dog", "always cat", "refused cat", "plain cat cat", "", "dog"]
    spark.createDataFrame([(c,) for c in comments], "value string").coalesce(1).write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema("value string").parquet(f"{tmp}/in").select(
        "value", F.lit(dt.datetime(2024, 5, 1)).cast("timestamp").alias("timestamp")
    )
    words = ["cat", "dog", "once"]
    dictionary = RefreshingDictionary(spark, lambda: spark.createDataFrame([(w,) for w in words], "word string"))
    drain(
        comment_counts_query(
            stream, dictionary, f"{tmp}/ledger", f"{tmp}/ck", fetch=fetch, error_path=f"{tmp}/lost", partitions=None
        )
    )
    assert rows(monthly_totals(spark, f"{tmp}/ledger").select("word", "count")) == [("cat", 2), ("dog", 1), ("once", 1)]
    lost = spark.read.parquet(f"{tmp}/lost").collect()
    assert sorted((r.code, r.attempts, r.error) for r in lost if r.code) == [(500, 2, None)]
    failed = sorted((r.attempts, r.error) for r in lost if r.code is None)
    assert failed == [(3, "ConnectionError: always"), (3, "ConnectionError: twice")]
