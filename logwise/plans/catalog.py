"""Registered queries over the driver tables and their DuckDB oracles.

``events.event_type`` stands for the log level and ``documents.text`` for the
comments. Times are scaled from seconds to hours because ``events`` spans a
month: a 4 s / 2 s window becomes 4 h / 2 h. Every query reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwise.functions import (
    collapse_whitespace,
    epoch_millis,
    format_millis,
    format_seconds,
)
from logwise.functions.responses import HTTP_OK, RET_OK
from logwise.operators import (
    accumulate,
    as_of_word_counts,
    count_by,
    filter_levels,
    line_levels,
    log_records,
    non_empty,
    pane_counts,
    pane_length,
    sliding_counts,
    spread,
    sql_over_batch,
    total_snapshots,
    tumbling_counts,
    valid_terms,
    version_intervals,
    windows_of_panes,
    word_document_counts,
)
from logwise.operators.paths import WEIGHT_SCALE, best_path_counts
from logwise.operators.words import bucketed_word_counts
from logwise.operators.words import dictionary_words as distinct_words
from logwise.plans.apps import comment_word_counts
from logwise.session import scratch_path
from logwise.sinks.ledger import (
    compact_months,
    contributions,
    monthly_totals,
    read_contributions,
    write_contributions,
)
from logwise.settings import DICTIONARY_TTL_MS
from logwise.sources import (
    RefreshingDictionary,
    log_lines,
    log_lines_from_events,
    record_view,
    store_buckets,
    table,
    table_stream,
    write_log_files,
)
from logwise.sources.storage import is_folder, matching_folders
from logwise.streaming import (
    comment_counts_query,
    drain,
    error_log_query,
    keyed_state_query,
    last_batch_id,
    latest_per_key,
    latest_states,
    level_totals_query,
    pane_counts_query,
    pane_window_totals,
    sliding_counts_query,
    snapshot_at,
    window_totals,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed word lists of the checks.
WORD_LIST = ["the", "in", "is", "widget", "nicht", "des", "und", "la"]
SEGMENT_WORDS = ["tion", "the", "ent", "ation", "ch", "in", "und"]
SUBSTRING_WORDS = ["the", "in", "ch", "ü"]

ERROR_SQL = "select event_id, event_type, value from batch_rows where event_type = 'error'"
LOG_ERROR_SQL = "select * from batch_rows where log_level = '[error]'"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def _documents(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """Documents, projected first, spread over the cluster if the scan is narrow."""
    docs = table(spark, d, "documents")
    if cols:
        docs = docs.select(*cols)
    return spread(docs, "doc_id" if "doc_id" in docs.columns else None)


def _benchmark_words(spark: SparkSession, d: str) -> DataFrame:
    bench = table(spark, d, "benchmark")
    return distinct_words(bench.select(F.explode(F.split("text", " ")).alias("word")))


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


# ---------------------------------------------------------------- log analysis


def log_records_q(spark: SparkSession, d: str) -> DataFrame:
    lines = log_lines_from_events(spread(_events(spark, d), "event_id"))
    recs = log_records(lines)
    return recs.select("event_id", "log_level", "method", "content", _ntz("event_ts"))


def error_logs_q(spark: SparkSession, d: str) -> DataFrame:
    ev = filter_levels(_events(spark, d), ("error",), "event_type")
    return ev.select("event_id", "event_type", "value")


def error_logs_sql_q(spark: SparkSession, d: str) -> DataFrame:
    return sql_over_batch(_events(spark, d), ERROR_SQL)


def error_log_stream_q(spark: SparkSession, d: str) -> DataFrame:
    """Lines written as text files, read by the file stream, parsed, filtered by
    the SQL over the records and appended through the exactly-once file sink;
    the sink read back."""
    root = scratch_path(spark, "error_log_stream")
    lines = log_lines_from_events(_events(spark, d), keep=())
    write_log_files(spread(lines), f"{root}/logs")
    per_trigger = max(4, spark.sparkContext.defaultParallelism)
    stream = log_lines(spark, f"{root}/logs", stream=True, glob="*.txt", max_files_per_trigger=per_trigger)
    drain(error_log_query(stream, f"{root}/out", f"{root}/ckpt", sql=LOG_ERROR_SQL, sink="files"))
    out = spark.read.schema("log_level string, method string, content string, event_ts timestamp").parquet(
        f"{root}/out"
    )
    return out.select("log_level", "method", "content", _ntz("event_ts"))


def level_totals_q(spark: SparkSession, d: str) -> DataFrame:
    return count_by(_events(spark, d), "event_type", name="n")


def level_totals_from_lines_q(spark: SparkSession, d: str) -> DataFrame:
    """The counting path: first field of every rebuilt log line, no arity check."""
    ev = _events(spark, d).select("event_id", "event_type", "user_id", "ts")
    lines = log_lines_from_events(spread(ev, "event_id"), keep=())
    return count_by(line_levels(lines), "log_level", name="n")


def level_totals_stream_q(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "level_totals_stream")
    stream = table_stream(spark, d, "events")
    drain(
        level_totals_query(
            stream, "event_type", f"{root}/out", f"{root}/ckpt", mode="complete",
            state_partitions=spark.sparkContext.defaultParallelism,
        )
    )
    schema = "event_type string, n bigint, batch_id bigint"
    last = last_batch_id(spark, f"{root}/out")
    if last is None:  # nothing was processed
        return latest_per_key(spark, f"{root}/out", schema, ["event_type"], ["n"])
    return snapshot_at(spark, f"{root}/out", schema, last)  # complete mode: every key


def level_total_snapshots_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_type", F.to_date("ts").alias("batch"))
    return total_snapshots(ev, "event_type", "batch")


def sliding_level_counts_q(spark: SparkSession, d: str) -> DataFrame:
    return sliding_counts(_events(spark, d), "ts", "event_type", "4 hours", "2 hours")


def sliding_level_counts_stream_q(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "sliding_stream")
    stream = table_stream(spark, d, "events")
    drain(
        sliding_counts_query(
            stream, "event_type", f"{root}/out", f"{root}/ckpt", "4 hours", "2 hours", time_col="ts"
        )
    )
    totals = window_totals(spark, f"{root}/out", "event_type")
    return totals.select(_ntz("ws"), _ntz("we"), "event_type", "n")


def sliding_level_counts_3_2_q(spark: SparkSession, d: str) -> DataFrame:
    return sliding_counts(_events(spark, d), "ts", "event_type", "3 hours", "2 hours")


#: Window forms that one stream of panes serves: (length, slide) in hours.
PANE_FORMS = ((4, 2), (3, 2))


def pane_level_counts_stream_q(spark: SparkSession, d: str) -> DataFrame:
    """One stream of panes; the windows of every form read from it."""
    root = scratch_path(spark, "pane_stream")
    forms = [(f"{length} hours", f"{slide} hours") for length, slide in PANE_FORMS]
    stream = table_stream(spark, d, "events")
    drain(pane_counts_query(stream, "event_type", f"{root}/out", f"{root}/ckpt", forms, time_col="ts"))
    counts = None
    for (hours, _), (length, slide) in zip(PANE_FORMS, forms, strict=True):
        one = pane_window_totals(spark, f"{root}/out", "event_type", length, slide)
        one = one.select(F.lit(hours).cast("bigint").alias("hours"), _ntz("ws"), _ntz("we"), "event_type", "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def pane_level_counts_long_q(spark: SparkSession, d: str) -> DataFrame:
    """Windows a thousand slides long, without a row per event and window."""
    length, slide = "1000 hours", "1 hour"
    panes = pane_counts(_events(spark, d), "ts", "event_type", pane_length(spark, [(length, slide)]))
    return windows_of_panes(panes, "event_type", length, slide).select(_ntz("ws"), _ntz("we"), "event_type", "n")


def keyed_state_stream_q(spark: SparkSession, d: str) -> DataFrame:
    """Events per user by a state function over the stream of afternoon events,
    beginning with the morning's counts."""
    root = scratch_path(spark, "keyed_state")
    noon = 12
    morning = count_by(_events(spark, d).where(F.hour("ts") < noon), "user_id", name="state")
    morning.write.parquet(f"{root}/morning")
    morning = spark.read.schema(morning.schema).parquet(f"{root}/morning")
    stream = table_stream(spark, d, "events").where(F.hour("ts") >= noon).select("user_id", F.lit(1).alias("one"))
    drain(
        keyed_state_query(
            stream, "user_id", "one", lambda values, state: values.sum() + (state or 0),
            f"{root}/out", f"{root}/ckpt", partial=lambda values: values.sum(), start_from=morning,
            state_partitions=spark.sparkContext.defaultParallelism,
        )
    )
    states = latest_states(spark, f"{root}/out", "user_id", "bigint", start_from=morning)
    return states.withColumnRenamed("state", "n")


def tumbling_counts_q(spark: SparkSession, d: str) -> DataFrame:
    return tumbling_counts(_events(spark, d), "ts", "event_type", "3 hours")


# ---------------------------------------------------------------- word counts


def dictionary_words_q(spark: SparkSession, d: str) -> DataFrame:
    return _benchmark_words(spark, d)


def word_counts_q(spark: SparkSession, d: str) -> DataFrame:
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    return word_document_counts(docs, WORD_LIST, text="text", method="spaces")


def segment_spaces_counts_q(spark: SparkSession, d: str) -> DataFrame:
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    return word_document_counts(docs, _benchmark_words(spark, d), text="text", method="spaces")


def segment_dictionary_counts_q(spark: SparkSession, d: str) -> DataFrame:
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    return word_document_counts(docs, SEGMENT_WORDS, text="text", method="dictionary")


def segment_dictionary_frame_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Forward maximum matching against a frame dictionary, all benchmark words."""
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    return word_document_counts(docs, _benchmark_words(spark, d), text="text", method="dictionary")


def segment_best_path_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Words on the most likely path of each document, by the frequencies of
    the benchmark's words."""
    words = table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("word"))
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    return best_path_counts(docs, count_by(words, "word", name="count"), ("doc_id",))


def segment_document_words_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Forward maximum matching against every distinct word of the documents,
    a dictionary of many patterns. As no word holds a space and every token is
    a word, the words found are the tokens."""
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    words = distinct_words(docs.select(F.explode(F.split("text", " ")).alias("word")))
    return word_document_counts(docs, words, text="text", method="dictionary", key=("doc_id",))


def segment_ngrams_counts_q(spark: SparkSession, d: str) -> DataFrame:
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    return word_document_counts(docs, SUBSTRING_WORDS, text="text", method="substrings")


def segment_ngrams_dictionary_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Substring containment against a frame dictionary, all benchmark words:
    nested patterns within the limits of a regex, n-grams and a join beyond."""
    words = _benchmark_words(spark, d)
    docs = non_empty(_documents(spark, d, "doc_id", "text"), "text")
    return word_document_counts(docs, words, text="text", method="substrings")


def comment_word_counts_stream_q(spark: SparkSession, d: str) -> DataFrame:
    """Documents as a comment stream; dictionary reloaded by TTL; counts per
    (word, date) written to the monthly ledger; totals per word read back."""
    root = scratch_path(spark, "comment_stream")
    comments = table_stream(spark, d, "documents").select(
        F.col("text").alias("value"), F.current_timestamp().alias("timestamp")
    )
    dictionary = RefreshingDictionary(
        spark, lambda: _benchmark_words(spark, d), store_path=f"{root}/dictionary"
    )
    drain(comment_counts_query(comments, dictionary, f"{root}/ledger", f"{root}/ckpt"))
    totals = monthly_totals(spark, f"{root}/ledger")
    return totals.groupBy("word").agg(F.sum("count").alias("n"))


#: Buckets of a stored dictionary.
BUCKETS = 16


def segment_spaces_bucketed_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Space tokens with a dictionary stored in buckets of the word."""
    name = f"words_{uuid.uuid4().hex}"
    words = store_buckets(_benchmark_words(spark, d), scratch_path(spark, "bucketed_words"), name, BUCKETS)
    return bucketed_word_counts(non_empty(_documents(spark, d, "doc_id", "text"), "text"), words, BUCKETS)


def comment_records_q(spark: SparkSession, d: str) -> DataFrame:
    """Documents as messages of a topic (bytes, a partition per source), as
    the records that a reader of the topic sees."""
    messages = _documents(spark, d).select(
        F.encode(F.col("doc_id").cast("string"), "UTF-8").alias("key"),
        F.encode("text", "UTF-8").alias("value"),
        F.col("source").alias("partition"),
        F.col("doc_id").alias("offset"),
        F.col("n_chars").alias("timestamp"),
    )
    return record_view(messages)


#: Batches of the documents as comments: five sources each. A version of the
#: dictionary is valid from each of these batches on.
SOURCES_PER_BATCH = 5
VERSION_STARTS = (0, 1, 3)
SHORT_WORD = 4


def _comment_batches(spark: SparkSession, d: str) -> DataFrame:
    number = F.regexp_extract("source", r"(\d+)", 1)
    batch = F.floor(F.when(number == "", 0).otherwise(number.cast("bigint")) / SOURCES_PER_BATCH)
    return _documents(spark, d, "doc_id", "text", "source").select("doc_id", "text", batch.alias("batch"))


def _word_versions(spark: SparkSession, d: str) -> DataFrame:
    """(valid_from, word): the benchmark's short words, then all of its words,
    then the longer ones."""
    first, second, third = VERSION_STARTS
    short = F.char_length("word") <= SHORT_WORD
    starts = F.when(short, F.array(F.lit(first), F.lit(second))).otherwise(F.array(F.lit(second), F.lit(third)))
    return _benchmark_words(spark, d).select("word", F.explode(starts.cast("array<bigint>")).alias("valid_from"))


def dictionary_versions_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Comments per word and batch, each batch matched with the dictionary
    version valid at it."""
    words = _word_versions(spark, d)
    starts = spark.createDataFrame([(v,) for v in VERSION_STARTS], "valid_from bigint")
    intervals = version_intervals(starts, words)
    docs = non_empty(_comment_batches(spark, d), "text")
    return as_of_word_counts(docs, intervals, "batch", by=())


def dictionary_versions_stream_q(spark: SparkSession, d: str) -> DataFrame:
    """The same counts by the comment stream: batches arrive one after the
    other, the dictionary table changes between them, its time to live runs
    out before each, and each batch is processed by a query started anew. The
    contributions of each batch are read back from the ledger."""
    root = scratch_path(spark, "version_stream")
    words = _word_versions(spark, d)
    comments = _comment_batches(spark, d).select("batch", F.col("text").alias("value"))
    comments.write.partitionBy("batch").parquet(f"{root}/all")
    schema = "value string"
    for n in range(max((int(f.rsplit("=", 1)[1]) for f in matching_folders(spark, f"{root}/all/batch=*")), default=-1) + 1):
        if not is_folder(spark, f"{root}/all/batch={n}"):
            continue
        spark.read.schema(schema).parquet(f"{root}/all/batch={n}").write.mode("append").parquet(f"{root}/in")
        valid = max(v for v in VERSION_STARTS if v <= n)
        dictionary = RefreshingDictionary(
            spark,
            lambda valid=valid: words.where(F.col("valid_from") == valid),
            clock=lambda n=n: (n + 1) * (DICTIONARY_TTL_MS + 1),
            store_path=f"{root}/dictionary",
        )
        stream = spark.readStream.schema(schema).parquet(f"{root}/in").withColumn("timestamp", F.current_timestamp())
        drain(comment_counts_query(stream, dictionary, f"{root}/ledger", f"{root}/ckpt"))
    ledger = read_contributions(spark, f"{root}/ledger")
    return ledger.groupBy("word", F.col("batch_id").alias("batch")).agg(F.sum("count").alias("n"))


def monthly_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """(type, date) counts written to the contributions ledger as one batch per
    half day, the months compacted after the mornings and again after the
    afternoons, and the totals read back through the compacted table."""
    root = scratch_path(spark, "monthly_counts")
    afternoon = (F.hour("ts") >= 12).cast("int")
    ev = _events(spark, d).select(
        F.col("event_type").alias("word"),
        F.to_date("ts").alias("date"),
        (afternoon * 1_000_000 + F.unix_date(F.to_date("ts"))).alias("batch_id"),
    )
    counts = count_by(ev, "batch_id", "word", "date", name="count")
    for half in (F.col("batch_id") < 1_000_000, F.col("batch_id") >= 1_000_000):
        write_contributions(contributions(counts.where(half)), f"{root}/ledger")
        compact_months(spark, f"{root}/ledger", f"{root}/compacted")
    return monthly_totals(spark, f"{root}/ledger", compacted_path=f"{root}/compacted").select(
        "month", "date", "word", F.col("count").cast("bigint").alias("count")
    )


def accumulate_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """Morning events as the stored table, afternoon events as the new batch."""
    ev = _events(spark, d).select(
        F.col("event_type").alias("word"), F.to_date("ts").alias("date"), F.hour("ts").alias("h")
    )
    base = count_by(ev.where(F.col("h") < 12), "word", "date", name="count")
    delta = count_by(ev.where(F.col("h") >= 12), "word", "date", name="count")
    return accumulate(base, delta)


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, code, body): an answer for each document, terms being its
    words, in a body that escapes what JSON must escape."""
    terms = collapse_whitespace("text")
    return _documents(spark, d, "doc_id", "text").select(
        "doc_id",
        F.when(terms != "", F.lit(HTTP_OK)).otherwise(F.lit(404)).alias("code"),
        F.to_json(F.struct(F.lit(RET_OK).alias("ret"), F.lit("OK").alias("msg"), terms.alias("terms"))).alias("body"),
    )


def service_terms_q(spark: SparkSession, d: str) -> DataFrame:
    """Service answers of all documents parsed, validated and split."""
    ok = valid_terms(_answers(spark, d), keep=("doc_id",))
    return ok.select("doc_id", F.size("terms").cast("bigint").alias("n"))


def enriched_terms_q(spark: SparkSession, d: str) -> DataFrame:
    """The comment pipeline on service answers: every document's answer parsed
    and validated, its terms counted against the benchmark dictionary."""
    ok = valid_terms(_answers(spark, d), keep=("doc_id",))
    return word_document_counts(ok, _benchmark_words(spark, d), text="terms", method="terms")


def format_epochs_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select(
        "event_id",
        epoch_millis("ts").alias("ms"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("secs"),
    )
    return ev.select(
        "event_id",
        format_millis("ms", "yyyyMM").alias("m"),
        format_millis("ms", "yyyy-MM-dd").alias("d"),
        format_seconds("secs", "yyyy-MM-dd").alias("d2"),
    )


def comment_word_counts_q(spark: SparkSession, d: str) -> DataFrame:
    """The batch form of the comment application, counts per word and language
    (documents have no date to group by)."""
    comments = _documents(spark, d, "doc_id", "text", "lang").select(F.col("text").alias("value"), "lang")
    counts = comment_word_counts(comments, WORD_LIST, method="spaces", by=("lang",))
    return counts.withColumnRenamed("count", "n")


QUERIES: dict[str, Query] = {
    "log_records": log_records_q,
    "error_logs": error_logs_q,
    "error_logs_sql": error_logs_sql_q,
    "error_log_stream": error_log_stream_q,
    "level_totals": level_totals_q,
    "level_totals_from_lines": level_totals_from_lines_q,
    "level_totals_stream": level_totals_stream_q,
    "level_total_snapshots": level_total_snapshots_q,
    "sliding_level_counts": sliding_level_counts_q,
    "sliding_level_counts_stream": sliding_level_counts_stream_q,
    "sliding_level_counts_3_2": sliding_level_counts_3_2_q,
    "pane_level_counts_stream": pane_level_counts_stream_q,
    "pane_level_counts_long": pane_level_counts_long_q,
    "keyed_state_stream": keyed_state_stream_q,
    "tumbling_counts": tumbling_counts_q,
    "dictionary_words": dictionary_words_q,
    "word_counts": word_counts_q,
    "comment_word_counts": comment_word_counts_q,
    "segment_spaces_counts": segment_spaces_counts_q,
    "segment_spaces_bucketed_counts": segment_spaces_bucketed_counts_q,
    "comment_records": comment_records_q,
    "segment_dictionary_counts": segment_dictionary_counts_q,
    "segment_dictionary_frame_counts": segment_dictionary_frame_counts_q,
    "segment_best_path_counts": segment_best_path_counts_q,
    "segment_document_words_counts": segment_document_words_counts_q,
    "segment_ngrams_counts": segment_ngrams_counts_q,
    "segment_ngrams_dictionary_counts": segment_ngrams_dictionary_counts_q,
    "comment_word_counts_stream": comment_word_counts_stream_q,
    "dictionary_versions_counts": dictionary_versions_counts_q,
    "dictionary_versions_stream": dictionary_versions_stream_q,
    "monthly_counts": monthly_counts_q,
    "accumulate_counts": accumulate_counts_q,
    "service_terms": service_terms_q,
    "enriched_terms": enriched_terms_q,
    "format_epochs": format_epochs_q,
}


# ---------------------------------------------------------------- oracles

_WORD_IN = ", ".join(f"'{w}'" for w in WORD_LIST)

_BENCH_WORDS = (
    "select distinct word from (select unnest(string_split(text, ' ')) word from benchmark) "
    "where word <> ''"
)

_ERROR_EVENTS = "select event_id, event_type, value from events where event_type = 'error'"

_SLIDING = (
    "select ws, ws + interval {length} hour we, event_type, count(*) n from ("
    "select event_type, ts, unnest([time_bucket(interval 2 hour, ts), "
    "time_bucket(interval 2 hour, ts) - interval 2 hour]) ws from events"
    ") where ts < ws + interval {length} hour group by all"
)

_SPACE_COUNTS = (
    "select word, count(distinct doc_id) n from ("
    "select doc_id, unnest(string_split(text, ' ')) word from documents) "
    "where word <> '' and word in ({dictionary}) group by 1"
)

_TERMS = "select doc_id, trim(regexp_replace(text, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) terms from documents"

_SERVICE_TERMS = (
    "select doc_id, cast(len(list_filter(list_distinct(string_split(terms, ' ')), lambda x: x <> '')) as bigint) n "
    "from (" + _TERMS + ") where terms <> ''"
)

_VERSION_COUNTS = (
    "with b as (" + _BENCH_WORDS + "), i as ("
    f"select word, case when length(word) <= {SHORT_WORD} then {VERSION_STARTS[0]} else {VERSION_STARTS[1]} end valid_from, "
    f"case when length(word) <= {SHORT_WORD} then {VERSION_STARTS[2]} end valid_to from b), "
    "t as (select distinct doc_id, cast(floor(coalesce(try_cast(regexp_extract(source, '(\\d+)', 1) as bigint), 0) "
    f"/ {SOURCES_PER_BATCH}) as bigint) batch, unnest(string_split(text, ' ')) word from documents) "
    "select word, batch, count(*) n from t join i using (word) "
    "where batch >= valid_from and (valid_to is null or batch < valid_to) group by all"
)

ORACLES: dict[str, str] = {
    "log_records": (
        "select event_id, '[' || event_type || ']' log_level, 'u' || user_id as method, "
        "'Date:' || strftime(ts, '%Y%m%d%H%M%S') as content, date_trunc('second', ts) event_ts "
        "from events"
    ),
    "error_logs": _ERROR_EVENTS,
    "error_logs_sql": _ERROR_EVENTS,
    "error_log_stream": (
        "select '[error]' log_level, 'u' || user_id as method, "
        "'Date:' || strftime(ts, '%Y%m%d%H%M%S') as content, date_trunc('second', ts) event_ts "
        "from events where event_type = 'error'"
    ),
    "level_totals": "select event_type, count(*) n from events group by 1",
    "level_totals_stream": "select event_type, count(*) n from events group by 1",
    "level_totals_from_lines": "select '[' || event_type || ']' log_level, count(*) n from events group by 1",
    "level_total_snapshots": (
        "with d as (select cast(ts as date) batch, event_type, count(*) c from events group by all), "
        "r as (select batch, event_type, sum(c) over (partition by event_type order by batch) total, "
        "lead(batch) over (partition by event_type order by batch) nxt from d), "
        "g as (select cast(unnest(generate_series(min(batch), max(batch), interval 1 day)) as date) batch from d) "
        "select g.batch, r.event_type, cast(r.total as bigint) total from r join g "
        "on g.batch >= r.batch and (r.nxt is null or g.batch < r.nxt)"
    ),
    "sliding_level_counts": _SLIDING.format(length=4),
    "sliding_level_counts_stream": _SLIDING.format(length=4),
    "sliding_level_counts_3_2": _SLIDING.format(length=3),
    "pane_level_counts_stream": " union all ".join(
        f"select cast({length} as bigint) as hours, * from (" + _SLIDING.format(length=length) + ")" for length, _ in PANE_FORMS
    ),
    "pane_level_counts_long": (
        "with h as (select date_trunc('hour', ts) h, event_type, count(*) c from events group by all) "
        "select ws, ws + interval 1000 hour we, event_type, cast(sum(c) as bigint) n from ("
        "select event_type, c, unnest(generate_series(h - interval 999 hour, h, interval 1 hour)) ws from h) group by all"
    ),
    "keyed_state_stream": "select user_id, count(*) n from events group by 1",
    "tumbling_counts": (
        "select time_bucket(interval 3 hour, ts) ws, event_type, count(*) n from events group by all"
    ),
    "dictionary_words": _BENCH_WORDS,
    "word_counts": _SPACE_COUNTS.format(dictionary=_WORD_IN),
    "comment_word_counts": (
        "select word, lang, count(distinct doc_id) n from ("
        "select doc_id, lang, unnest(string_split(text, ' ')) word from documents) "
        f"where word in ({_WORD_IN}) group by all"
    ),
    "segment_spaces_counts": _SPACE_COUNTS.format(dictionary=_BENCH_WORDS),
    "segment_spaces_bucketed_counts": _SPACE_COUNTS.format(dictionary=_BENCH_WORDS),
    "comment_records": (
        "select cast(doc_id as varchar) as key, text as value, source as partition, doc_id as offset, "
        "n_chars as timestamp from documents"
    ),
    "comment_word_counts_stream": _SPACE_COUNTS.format(dictionary=_BENCH_WORDS),
    "segment_dictionary_counts": (
        "select word, count(*) n from (select distinct doc_id, "
        "unnest(regexp_extract_all(text, '(ation|tion|ent|the|und|ch|in)', 1)) word "
        "from documents) group by 1"
    ),
    "segment_dictionary_frame_counts": (
        "with b as (" + _BENCH_WORDS + "), p as (select '(' || string_agg(regexp_escape(word), '|' "
        "order by length(word) desc, word) || ')' as pat from b) "
        "select word, count(*) n from (select distinct doc_id, "
        "unnest(regexp_extract_all(text, pat, 1)) word from documents, p) group by 1"
    ),
    # the lattice from right to left: sums and paths of the positions that the
    # longest word reaches, the best option of each position in front
    "segment_best_path_counts": (
        "with recursive f as materialized (select word, count(*) c from (select unnest(string_split(text, ' ')) word "
        "from benchmark) where word <> '' group by 1), t as (select sum(c) total, max(length(word)) longest from f), "
        f"w as materialized (select word, cast(floor(ln(c::double / total) * {WEIGHT_SCALE} + 0.5) as bigint) w from f, t), "
        "p as materialized (select doc_id, unnest(list_distinct(regexp_extract_all(text, (select '[' || "
        "string_agg(regexp_escape(ch), '') || ']+' from (select distinct unnest(string_split(word, '')) ch from w))))) piece "
        "from documents), "
        "u as materialized (select distinct piece from p), "
        "s as (select piece, pos, unnest(range(1, least(longest, length(piece) - pos) + 1)) len from "
        "(select piece, unnest(range(length(piece))) pos from u), t), "
        "o as (select piece, pos, len, w, 1 k from s join w on word = substr(piece, pos + 1, len)), "
        "a as (select piece, pos, list({'w': w, 'len': len, 'k': k}) opts from (select * from o union all "
        f"select piece, pos, 1, cast(floor(ln(1.0::double / total) * {WEIGHT_SCALE} + 0.5) as bigint), 0 from s, t where len = 1 "
        "and not exists (select 1 from o where o.piece = s.piece and o.pos = s.pos and o.len = 1)) group by 1, 2), "
        "m as materialized (select * from a), "
        "r as (select piece, length(piece) pos, [0::bigint] sums, [[]::varchar[]] paths from u union all "
        "select piece, pos, list_prepend(best.s, sums)[1:longest], list_prepend(case when best.k = 1 then "
        "list_prepend(substr(piece, pos + 1, best.len), paths[best.len]) else paths[best.len] end, paths)[1:longest] from ("
        "select r.piece, m.pos, sums, paths, longest, list_max(list_transform(opts, "
        "lambda x: {'s': x.w + sums[x.len], 'len': x.len, 'k': x.k})) best "
        "from r join m on m.piece = r.piece and m.pos = r.pos - 1, t)) "
        "select word, count(distinct doc_id) n from (select doc_id, unnest(paths[1]) word from p join r using (piece) "
        "where pos = 0) group by 1"
    ),
    "segment_document_words_counts": (
        "select word, count(distinct doc_id) n from ("
        "select doc_id, unnest(string_split(text, ' ')) word from documents) where word <> '' group by 1"
    ),
    "segment_ngrams_counts": (
        "select word, count(*) n from documents join (values ('the'), ('in'), ('ch'), ('ü')) t(word) "
        "on contains(text, word) group by 1"
    ),
    "segment_ngrams_dictionary_counts": (
        "select t.word, count(*) n from documents d join ("
        + _BENCH_WORDS
        + ") t on contains(d.text, t.word) group by 1"
    ),
    "dictionary_versions_counts": _VERSION_COUNTS,
    "dictionary_versions_stream": _VERSION_COUNTS,
    "monthly_counts": (
        "select strftime(ts, '%Y%m') as month, cast(ts as date) date, event_type word, "
        "count(*) count from events group by all"
    ),
    "accumulate_counts": (
        "select event_type word, cast(ts as date) date, count(*) count from events group by all"
    ),
    "service_terms": _SERVICE_TERMS,
    "enriched_terms": (
        "select word, count(*) n from (select distinct doc_id, unnest(string_split(terms, ' ')) word "
        "from (" + _TERMS + ")) where word <> '' and word in (" + _BENCH_WORDS + ") group by 1"
    ),
    "format_epochs": (
        "select event_id, strftime(ts, '%Y%m') m, strftime(ts, '%Y-%m-%d') d, "
        "strftime(ts, '%Y-%m-%d') d2 from events"
    ),
}
