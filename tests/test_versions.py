"""Dictionary versions as intervals, and comments matched as of their batch."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from logwise.operators import as_of_word_counts, match_as_of, version_intervals, word_document_counts
from logwise.operators import versions as versions_module
from logwise.sinks import read_contributions
from logwise.sources import RefreshingDictionary, stored_versions
from logwise.streaming import comment_counts_query, drain


def _frames(spark, series):
    """(versions, words) of {start: words}."""
    starts = spark.createDataFrame([(s,) for s in series], "valid_from bigint")
    words = [(s, w) for s, ws in series.items() for w in ws]
    return starts, spark.createDataFrame(words, "valid_from bigint, word string")


def test_intervals_of_words_that_stay_leave_and_come_back(spark):
    series = {0: ["a", "b", "a"], 3: ["a"], 7: [], 9: ["a", "c", "", None], 12: ["a", "b"]}
    got = rows(version_intervals(*_frames(spark, series)).select("word", "valid_from", "valid_to").na.fill(-1))
    assert got == [("a", 0, 7), ("a", 9, -1), ("b", 0, 3), ("b", 12, -1), ("c", 9, 12)]


def test_intervals_equal_the_versions_at_every_batch(spark):
    rnd = random.Random(1)
    words = [chr(97 + i) for i in range(8)]
    series = {s: rnd.sample(words, rnd.randrange(9)) for s in sorted(rnd.sample(range(40), 12))}
    intervals = version_intervals(*_frames(spark, series))
    all_rows = spark.range(45).withColumnRenamed("id", "b").crossJoin(spark.createDataFrame([(w,) for w in words], "word string"))
    got = set(rows(match_as_of(all_rows, intervals, "b").select("b", "word")))
    want = set()
    for b in range(45):
        valid = max((s for s in series if s <= b), default=None)
        want |= {(b, w) for w in (series[valid] if valid is not None else [])}
    assert got == want


TEXTS = ["aab aa b", "b ab aab", "a a a", "", None, "ab", "bb aa", "aaaa b ab"]


@pytest.mark.parametrize("method", ["spaces", "substrings", "dictionary"])
@pytest.mark.parametrize("limit", [None, 0])
def test_counts_equal_one_count_per_version(spark, monkeypatch, method, limit):
    if limit is not None:  # intervals too large to broadcast
        monkeypatch.setattr(versions_module, "broadcast_if_small", lambda df, *a: (df, False))
    series = {1: ["a", "ab"], 2: ["aa", "b"], 5: [], 6: ["a", "aa", "aab", "b"]}
    docs = spark.createDataFrame([(t, i % 8) for i, t in enumerate(TEXTS * 5)] + [("aa b", None)], "text string, batch bigint")
    got = rows(as_of_word_counts(docs, version_intervals(*_frames(spark, series)), "batch", method=method))
    want = []
    for b in range(8):
        valid = max((s for s in series if s <= b), default=None)
        if valid is not None and series[valid]:
            one = word_document_counts(docs.where(F.col("batch") == b), series[valid], method=method)
            want += [(r["word"], b, r["n"]) for r in one.collect()]
    assert got == sorted(want)


def test_no_versions_no_words(spark):
    docs = spark.createDataFrame([("a", 1)], "text string, batch bigint")
    for method in ("spaces", "dictionary"):
        assert as_of_word_counts(docs, version_intervals(*_frames(spark, {})), "batch", method=method).count() == 0


def test_the_intervals_of_a_stream_recount_its_ledger(spark, tmp):
    """Four batches, three versions of which one is empty, each batch by a new
    driver: the stored versions as intervals give the counts of the ledger."""
    batches = [["a b", "a"], ["a c", "b"], ["c", "c b"], ["a b c"]]
    series = {0: ["a", "b"], 1: ["a", "b"], 2: [], 3: ["c"]}
    for n, texts in enumerate(batches):
        spark.createDataFrame([(t,) for t in texts], "value string").write.mode("append").parquet(f"{tmp}/in")
        words = spark.createDataFrame([(w,) for w in series[n]], "word string")
        dictionary = RefreshingDictionary(
            spark, lambda words=words: words, ttl_ms=10, clock=lambda n=n: n // 2 * 100, store_path=f"{tmp}/store"
        )
        stream = spark.readStream.schema("value string").parquet(f"{tmp}/in").withColumn("timestamp", F.current_timestamp())
        drain(comment_counts_query(stream, dictionary, f"{tmp}/ledger", f"{tmp}/ckpt"))
    ledger = rows(read_contributions(spark, f"{tmp}/ledger").select("word", "batch_id", "count"))
    # batches 2 and 3 share the (empty) version loaded at batch 2
    assert ledger == [("a", 0, 2), ("a", 1, 1), ("b", 0, 1), ("b", 1, 1)]
    intervals = version_intervals(*stored_versions(spark, f"{tmp}/store"))
    docs = [(t, n) for n, texts in enumerate(batches) for t in texts]
    again = as_of_word_counts(spark.createDataFrame(docs, "text string, batch bigint"), intervals, "batch")
    assert rows(again) == ledger
    by_time = version_intervals(*stored_versions(spark, f"{tmp}/store", "loaded_at"))
    assert rows(by_time.select("word", "valid_from", "valid_to")) == [("a", 0, 100), ("b", 0, 100)]
    assert stored_versions(spark, f"{tmp}/none")[0].count() == 0
