"""Dictionary refresh, retrying enrichment, response faults, replay-safe sinks,
time formatting and source options."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from logwise.functions import format_millis, format_response, format_seconds
from logwise.operators import accumulate, enrich_with_retry, failed_answers, parse_responses, valid_terms
from logwise.sinks import append_batch, contributions, monthly_totals, read_batches, write_contributions
from logwise.operators import Size
from logwise.sources import RefreshingDictionary, comments_from_table, kafka_options, load_words, log_lines
from conftest import rows, write_lines


# ------------------------------------------------------------------ dictionary


class Clock:
    def __init__(self, t=0):
        self.t = t

    def __call__(self):
        return self.t


def test_dictionary_reloads_only_after_ttl(spark, tmp):
    clock = Clock(1_000)
    state = {"words": ["a"]}
    d = RefreshingDictionary(
        spark, lambda: spark.createDataFrame([(w,) for w in state["words"]], "word string"), ttl_ms=300_000, clock=clock
    )
    assert [r.word for r in d.current().collect()] == ["a"]
    state["words"] = ["a", "b"]
    clock.t = 1_000 + 300_000  # exactly the TTL: not reloaded (strictly greater)
    assert d.current().count() == 1 and d.loads == 1
    clock.t += 1
    assert sorted(r.word for r in d.current().collect()) == ["a", "b"] and d.loads == 2
    assert d.size.rows == 2 and d.size.bytes == 2


def test_dictionary_snapshot_sees_new_files(spark, tmp):
    spark.createDataFrame([("x",)], "word string").write.parquet(f"{tmp}/dict")
    clock = Clock(0)
    d = RefreshingDictionary(spark, lambda: load_words(spark, path=f"{tmp}/dict"), ttl_ms=10, clock=clock)
    assert d.current().count() == 1
    spark.createDataFrame([("y",), ("x",)], "word string").write.mode("append").parquet(f"{tmp}/dict")
    assert d.current().count() == 1  # same snapshot within the TTL
    clock.t = 11
    assert sorted(r.word for r in d.current().collect()) == ["x", "y"]  # distinct


def test_dictionary_reload_failure_modes(spark):
    clock = Clock(0)
    ok = {"fail": False}

    def loader():
        if ok["fail"]:
            raise OSError("database down")
        return spark.createDataFrame([("w",)], "word string")

    keep = RefreshingDictionary(spark, loader, ttl_ms=1, clock=clock, on_error="keep")
    empty = RefreshingDictionary(spark, loader, ttl_ms=1, clock=clock, on_error="empty")
    keep.current(), empty.current()
    ok["fail"], clock.t = True, 5
    assert keep.current().count() == 1
    assert empty.current().count() == 0
    with pytest.raises(OSError):
        RefreshingDictionary(spark, loader, clock=clock).current()  # first load raises


# ------------------------------------------------------------------ enrichment


def test_enrich_retries_on_exceptions_only(spark):
    calls = {}

    def fetch(texts):
        out = []
        for text in texts:
            calls[text] = calls.get(text, 0) + 1
            fails = {"once": 1, "twice": 2, "always": 99}.get(text, 0)
            if calls[text] <= fails:
                raise ConnectionError("reset")
            body = '{"ret":0, "msg":"OK", "terms":"' + text + ' x"}'
            out.append((500, "error") if text == "down" else (200, body))
        return out

    df = spark.createDataFrame([(t,) for t in ["ok", "once", "twice", "always", "down", "", None]], "value string")
    single = enrich_with_retry(df.coalesce(1), fetch, keep=("value",), batch=1)
    assert single.columns == ["value", "code", "body", "attempts", "error", "elapsed_ms"]
    out = {r.value: r for r in single.collect()}
    assert (out["ok"].code, out["ok"].attempts) == (200, 1)
    assert (out["once"].code, out["once"].attempts) == (200, 2)
    assert (out["twice"].code, out["twice"].attempts) == (200, 3)
    assert out["always"].code is None and out["always"].attempts == 3 and "reset" in out["always"].error
    assert (out["down"].code, out["down"].attempts) == (500, 1)  # a status is not retried
    assert out[""].attempts == 0 and out[None].attempts == 0
    # a failing call of several texts is repeated text by text; it counts as
    # one of the three sends of each of them, so "twice" has no third left
    several = enrich_with_retry(df.coalesce(1), fetch, keep=("value",))
    words = {r.value: sorted(r.terms) for r in valid_terms(several, keep=("value",)).collect()}
    assert words == {"ok": ["ok", "x"], "once": ["once", "x"]}
    lost = {r.value: (r.code, r.attempts) for r in failed_answers(several, keep=("value",)).collect()}
    assert lost == {"always": (None, 3), "twice": (None, 3), "down": (500, 2)}


def test_enrich_checks_the_number_of_answers(spark):
    df = spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1)
    out = enrich_with_retry(df, lambda texts: [(200, "x")] * (2 if len(texts) == 1 else 1)).collect()
    assert all(r.code is None and "answers" in r.error and r.attempts == 3 for r in out)


def test_response_faults(spark):
    cases = [
        (1, 200, '{"ret":0, "msg":"OK", "terms":"a b  a "}'),
        (2, 200, '{"ret":1, "msg":"fail", "terms":"a"}'),
        (3, 500, '{"ret":0, "msg":"OK", "terms":"a"}'),
        (4, 200, '{"ret":0, "msg":"OK", "terms":"a "b" c"}'),  # unescaped quote from the service
        (5, 200, "not json"),
        (6, 200, '{"ret":0, "msg":"OK"}'),
        (7, 200, '{"ret":"zero", "msg":"OK", "terms":"a"}'),
        (8, 200, None),
    ]
    df = spark.createDataFrame(cases, "id int, code int, body string")
    got = {r.id: (r.ok, sorted(r.terms)) for r in parse_responses(df, keep=("id",)).collect()}
    assert got[1] == (True, ["a", "b"])
    assert all(got[i] == (False, []) for i in range(2, 9))


def test_format_response_breaks_on_quotes(spark):
    df = spark.createDataFrame([("plain words",), ('say "hi"',)], "t string")
    bodies = df.select(F.lit(200).alias("code"), format_response("t").alias("body"))
    assert [r.ok for r in parse_responses(bodies).collect()] == [True, False]


# ------------------------------------------------------------------ sinks


def test_contributions_replay_is_idempotent(spark, tmp):
    def batch(n):
        return spark.createDataFrame(
            [("狗", dt.date(2018, 8, 5), n), ("酒", dt.date(2018, 8, 5), 1), ("狗", dt.date(2018, 11, 18), 2)],
            "word string, date date, count long",
        )

    path = f"{tmp}/ledger"
    write_contributions(contributions(batch(40), 0), path)
    write_contributions(contributions(batch(4), 1), path)
    write_contributions(contributions(batch(4), 1), path)  # replay of batch 1
    totals = rows(monthly_totals(spark, path).select("month", "word", "date", "count"))
    assert totals == [
        ("201808", "狗", dt.date(2018, 8, 5), 44),
        ("201808", "酒", dt.date(2018, 8, 5), 2),
        ("201811", "狗", dt.date(2018, 11, 18), 4),
    ]
    assert rows(monthly_totals(spark, path, months=["201811"]).select("count")) == [(4,)]


def test_append_batch_replay_and_empty_batch(spark, tmp):
    df = spark.createDataFrame([("[error]", "a")], "log_level string, method string")
    append_batch(df, f"{tmp}/t", 0)
    append_batch(df, f"{tmp}/t", 0)
    append_batch(df.limit(0), f"{tmp}/t", 1)
    schema = "log_level string, method string, batch_id bigint"
    assert rows(read_batches(spark, f"{tmp}/t", schema)) == [("[error]", "a", 0)]
    append_batch(df.limit(0), f"{tmp}/t", 0)  # a replay without rows clears what the first attempt wrote
    assert rows(read_batches(spark, f"{tmp}/t", schema)) == []
    assert rows(read_batches(spark, f"{tmp}/nothing-yet", schema)) == []


def test_accumulate_adds_and_inserts(spark):
    base = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2), ("b", dt.date(2024, 1, 1), 1)], "word string, date date, count long")
    delta = spark.createDataFrame([("a", dt.date(2024, 1, 1), 3), ("a", dt.date(2024, 1, 2), 1)], "word string, date date, count long")
    assert rows(accumulate(base, delta)) == [
        ("a", dt.date(2024, 1, 1), 5),
        ("a", dt.date(2024, 1, 2), 1),
        ("b", dt.date(2024, 1, 1), 1),
    ]


# ------------------------------------------------------------------ time formats, sources


def test_time_formats(spark):
    ms = int(dt.datetime(2018, 8, 5, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(ms, str(ms // 1000)), (None, "bad")], "ms long, s string")
    got = df.select(
        format_millis("ms", "yyyyMM").alias("m"),
        format_millis("ms", "yyyy-MM-dd").alias("d"),
        format_seconds("s", "yyyy-MM-dd").alias("d2"),
    ).collect()
    assert tuple(got[0]) == ("201808", "2018-08-05", "2018-08-05")
    assert tuple(got[1]) == (None, None, None)


def test_kafka_options_and_record_view(spark):
    opts = kafka_options("h1:9092,h2:9092", "comments", max_offsets_per_trigger=5)
    assert opts == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "comments",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5",
    }
    df = spark.createDataFrame([(7, "hello")], "doc_id long, text string")
    assert comments_from_table(df, key="doc_id").first().asDict() == {"key": "7", "value": "hello"}


def test_log_folder_batch_reader(spark, tmp):
    write_lines(f"{tmp}/logs", "a.log", ["[info]\tmain\tDate:20200606215836"], mtime=1_000_000)
    write_lines(f"{tmp}/logs", "b.log", ["[warn]\tmain\tDate:20200606215837"], mtime=2_000_000)
    write_lines(f"{tmp}/logs", "c.txt", ["ignored"])
    assert log_lines(spark, f"{tmp}/logs", glob="*.log").count() == 2
    newer = log_lines(spark, f"{tmp}/logs", glob="*.log", ignore_existing_before=dt.datetime(1970, 1, 20))
    assert [r.value for r in newer.collect()] == ["[warn]\tmain\tDate:20200606215837"]


def test_ledger_compaction_keeps_totals_and_late_batches(spark, tmp):
    from logwise.sinks import compact_months

    def batch(words):
        return spark.createDataFrame(
            [(w, dt.date(2018, m, d), c) for w, m, d, c in words], "word string, date date, count long"
        )

    ledger, comp = f"{tmp}/ledger", f"{tmp}/compacted"
    write_contributions(contributions(batch([("狗", 8, 5, 40), ("酒", 8, 19, 2)]), 0), ledger)
    write_contributions(contributions(batch([("狗", 8, 5, 4), ("狗", 11, 18, 1)]), 1), ledger)
    before = rows(monthly_totals(spark, ledger).select("month", "word", "date", "count"))
    compact_months(spark, ledger, comp, ["201808"])
    compact_months(spark, ledger, comp, ["201808"])  # again: same result
    assert rows(monthly_totals(spark, ledger, compacted_path=comp).select("month", "word", "date", "count")) == before
    # a late batch for the compacted month still counts, once
    write_contributions(contributions(batch([("狗", 8, 5, 1)]), 2), ledger)
    after = {(r.month, r.word, r.date): r["count"] for r in monthly_totals(spark, ledger, compacted_path=comp).collect()}
    assert after[("201808", "狗", dt.date(2018, 8, 5))] == 45
    assert after[("201811", "狗", dt.date(2018, 11, 18))] == 1


def _remove(folder):
    import shutil

    shutil.rmtree(folder)


def test_compaction_after_the_folded_partitions_are_gone(spark, tmp):
    from logwise.sinks import compact_months, drop_folded, monthly_ledger

    def write(batch_id, count, day=5, month=8):
        df = spark.createDataFrame([("w", dt.date(2018, month, day), count)], "word string, date date, count long")
        write_contributions(contributions(df, batch_id), ledger, batch_id)

    def total():
        return rows(monthly_totals(spark, ledger, compacted_path=comp).groupBy().sum("count"))

    ledger, comp = f"{tmp}/ledger", f"{tmp}/compacted"
    write(0, 5)
    write(1, 7, month=9)
    compact_months(spark, ledger, comp)
    for m in ("201808", "201809"):
        _remove(f"{ledger}/month={m}")
    assert total() == [(12,)]
    write(2, 1)
    assert total() == [(13,)]
    compact_months(spark, ledger, comp, ["201808"])
    assert total() == [(13,)]
    _remove(f"{ledger}/month=201808")
    drop_folded(spark, monthly_ledger(ledger), comp)
    compact_months(spark, ledger, comp)
    assert total() == [(13,)]
    # a compaction that did not finish is not read
    os.makedirs(f"{comp}/totals/part=201808/fold=9")
    assert total() == [(13,)]


def test_replay_that_leaves_a_month_clears_it(spark, tmp):
    def write(months):
        df = spark.createDataFrame([("w", dt.date(2018, m, 1), 1) for m in months], "word string, date date, count long")
        write_contributions(contributions(df, 3), f"{tmp}/l", 3)

    write([7, 8])
    write([8])
    assert rows(monthly_totals(spark, f"{tmp}/l").select("month", "count")) == [("201808", 1)]


def test_compact_latest_after_the_folded_partitions_are_gone(spark, tmp):
    from logwise.streaming import compact_latest, latest_per_key

    schema = "k string, n bigint, batch_id bigint"
    write = lambda b, data: append_batch(spark.createDataFrame(data, "k string, n long"), f"{tmp}/t", b)
    read = lambda: rows(latest_per_key(spark, f"{tmp}/t", schema, ["k"], ["n"], f"{tmp}/c"))
    write(0, [("a", 1), ("b", 1)])
    write(1, [("a", 2)])
    compact_latest(spark, f"{tmp}/t", schema, ["k"], ["n"], f"{tmp}/c")
    _remove(f"{tmp}/t/batch_id=0")
    _remove(f"{tmp}/t/batch_id=1")
    assert read() == [("a", 2), ("b", 1)]
    write(2, [("b", 5)])
    compact_latest(spark, f"{tmp}/t", schema, ["k"], ["n"], f"{tmp}/c")
    _remove(f"{tmp}/t/batch_id=2")
    assert read() == [("a", 2), ("b", 5)]


def test_empty_dictionary_is_pinned_for_replays(spark, tmp):
    state = {"fail": False, "now": 0}

    def loader():
        if state["fail"]:
            raise RuntimeError("down")
        return spark.createDataFrame([("a",)], "word string")

    make = lambda: RefreshingDictionary(
        spark, loader, ttl_ms=10, clock=lambda: state["now"], on_error="empty", store_path=f"{tmp}/d"
    )
    first = make()
    assert first.for_batch(0).size.rows == 1
    state |= {"fail": True, "now": 20}
    assert first.for_batch(1).size.rows == 0
    state |= {"fail": False, "now": 25}
    assert make().for_batch(1).size.rows == 0  # a new driver replays batch 1 with the same words


def test_sql_over_batch_leaves_the_callers_views_alone(spark):
    from logwise.operators import sql_over_batch

    spark.range(3).createOrReplaceTempView("batch_rows")
    out = sql_over_batch(spark.range(7), "select count(*) n from batch_rows")
    other = sql_over_batch(spark.range(2), "select count(*) n from batch_rows b where b.id >= 0")
    assert (out.first().n, other.first().n, spark.table("batch_rows").count()) == (7, 2, 3)
    assert len(spark.catalog.listTables()) == 1
    spark.catalog.dropTempView("batch_rows")


def test_enrich_reports_elapsed_time(spark):
    import time as _time

    def fetch(texts):
        _time.sleep(0.03 if "slow" in texts else 0)
        return [(200, '{"ret":0, "msg":"OK", "terms":"x"}') for _ in texts]

    df = spark.createDataFrame([("slow",), ("fast",), ("",)], "value string")
    out = {r.value: r.elapsed_ms for r in enrich_with_retry(df, fetch, keep=("value",), batch=1).collect()}
    assert out["slow"] >= 30 and out["fast"] < 30 and out[""] is None


def test_record_view_of_topic_shaped_rows(spark):
    from logwise.sources import record_view

    raw = spark.createDataFrame(
        [(bytearray(b"user_7"), bytearray("今天 天气".encode()), 2, 41, dt.datetime(2018, 8, 5, 9))],
        "key binary, value binary, partition int, offset long, timestamp timestamp",
    )
    r = record_view(raw).first()
    assert (r.key, r.value, r.partition, r.offset) == ("user_7", "今天 天气", 2, 41)


def test_pinned_snapshots_survive_reload_and_a_new_driver(spark, tmp):
    clock = Clock(0)
    state = {"words": ["a"]}

    def loader():
        return spark.createDataFrame([(w,) for w in state["words"]], "word string")

    def words(snap):
        return sorted(r.word for r in snap.words.collect())

    d = RefreshingDictionary(spark, loader, ttl_ms=10, clock=clock, store_path=f"{tmp}/dict")
    assert words(d.for_batch(0)) == ["a"] and words(d.for_batch(1)) == ["a"]
    state["words"], clock.t = ["a", "b"], 20  # source changed, TTL passed
    assert words(d.for_batch(2)) == ["a", "b"]
    assert d.loads == 2
    # a new driver replays batch 2, then goes on: it resumes the pinned snapshot
    state["words"] = ["z"]
    again = RefreshingDictionary(spark, loader, ttl_ms=10, clock=clock, store_path=f"{tmp}/dict")
    assert words(again.for_batch(2)) == ["a", "b"] and again.loads == 0
    assert words(again.for_batch(3)) == ["a", "b"]  # still within the TTL of that snapshot
    clock.t = 40
    assert words(again.for_batch(4)) == ["z"]  # TTL over: reloaded and pinned at batch 4
    third = RefreshingDictionary(spark, loader, ttl_ms=10, clock=clock, store_path=f"{tmp}/dict")
    assert words(third.for_batch(4)) == ["z"] and third.for_batch(4).size == Size(1, 1)
