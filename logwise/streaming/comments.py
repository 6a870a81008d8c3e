"""Comment word counts as a Structured Streaming query.

Per micro-batch: refresh the dictionary if it is older than its time to live,
drop empty comments, find dictionary words (set per comment), count comments
per (word, date) and write the batch's contributions to the monthly ledger.
The ledger partition is keyed by the batch id that the checkpoint ties to the
source offsets, so a replayed batch replaces itself instead of adding twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logwise.operators.balance import spread
from logwise.operators.filters import non_empty
from logwise.operators.enrich import Fetch, enrich_with_retry, enrich_with_store
from logwise.operators.responses import failed_answers, valid_terms
from logwise.operators.words import PATTERN_MAX_BYTES, PATTERN_MAX_WORDS, word_document_counts
from logwise.sinks.ledger import contributions, write_contributions
from logwise.sinks.tables import append_batch
from logwise.sources.dictionary import RefreshingDictionary
from logwise.streaming.runner import start


def batch_word_counts(
    df: DataFrame,
    dictionary: RefreshingDictionary,
    method: str = "spaces",
    time_col: str | None = "timestamp",
    batch_time: dt.datetime | None = None,
    partitions: int | str | None = "auto",
    batch_id: int | None = None,
) -> DataFrame:
    """(word, date, count) for one batch of comments.

    The date comes from ``time_col`` (the message time) or, when it is None,
    from ``batch_time`` (the wall clock at processing, as a receiver would).
    With method ``terms`` the batch has an array column ``terms`` instead of
    ``value``. ``partitions``: a number repartitions the comments round-robin before
    segmentation; ``"auto"`` does so only when the batch has fewer partitions
    than the cluster has task slots; None never.
    """
    snap = dictionary.current_snapshot() if batch_id is None else dictionary.for_batch(batch_id)
    words = snap.words
    if method == "dictionary":
        # collected once per snapshot, if it is small enough for a pattern
        listed = snap.word_list(PATTERN_MAX_WORDS, PATTERN_MAX_BYTES)
        if listed is not None:
            words = listed
    text = "terms" if method == "terms" else "value"
    docs = df if method == "terms" else non_empty(df, "value")
    if partitions == "auto":
        docs = spread(docs)
    elif partitions:
        docs = docs.repartition(int(partitions))
    if time_col is not None:
        date = F.to_date(F.col(time_col))
    else:
        date = F.lit((batch_time or dt.datetime.now(dt.timezone.utc)).date())
    docs = docs.select(text, date.alias("date"))
    return word_document_counts(
        docs, words, text=text, method=method, name="count", size=snap.size, by=("date",)
    )


def comment_counts_query(
    comments: DataFrame,
    dictionary: RefreshingDictionary,
    ledger_path: str,
    checkpoint: str,
    method: str = "spaces",
    time_col: str | None = "timestamp",
    partitions: int | str | None = "auto",
    trigger: str | None = None,
    fetch: Fetch | None = None,
    error_path: str | None = None,
    answers_path: str | None = None,
) -> StreamingQuery:
    """Start the comment word count stream; totals via ``monthly_totals``.

    With ``fetch``, every comment is sent to a segmentation service (up to
    three tries) and the terms of its answer are counted (method ``terms``).
    Comments without a valid answer are appended to ``error_path``, one
    partition per batch, with their time and the answer or error. With
    ``answers_path`` answers are stored there: equal texts are sent once, and
    a replayed batch sends nothing that it has sent before.

    ``time_col=None`` dates each comment by the time of its micro-batch, as a
    receiver would. That time is ``current_timestamp()`` of the stream, which
    Spark records in the offset log per batch and reuses when a batch is
    replayed, so a replay after midnight still lands on the same date and
    month partition.

    A replayed batch uses the dictionary snapshot pinned for its batch id
    when the dictionary has a ``store_path``; without one it uses the
    snapshot current at replay time.
    """
    if time_col is None:
        comments = comments.withColumn("_batch_time", F.current_timestamp())
        time_col = "_batch_time"

    comments = comments.observe(
        "comments",
        F.count(F.lit(1)).alias("comments"),
        F.sum(F.when(F.coalesce(F.length("value"), F.lit(0)) == 0, 1).otherwise(0)).alias("empty"),
    )

    def count(df: DataFrame, batch_id: int, by_method: str, spread_to: int | str | None) -> None:
        counts = batch_word_counts(
            df,
            dictionary,
            method=by_method,
            time_col=time_col,
            partitions=spread_to,
            batch_id=batch_id,
        )
        write_contributions(contributions(counts, batch_id), ledger_path, batch_id)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        if fetch is None:
            count(df, batch_id, method, partitions)
            return
        sent = spread(df) if partitions == "auto" else df
        # two outputs read the answers: ask the service once
        if answers_path:
            answers = enrich_with_store(sent, fetch, answers_path, batch_id, keep=(time_col,)).persist()
        else:
            answers = enrich_with_retry(sent, fetch, keep=(time_col,)).persist()
        try:
            count(valid_terms(answers, keep=(time_col,)), batch_id, "terms", None)
            if error_path:
                append_batch(failed_answers(answers, keep=(time_col,)), error_path, batch_id)
        finally:
            answers.unpersist()

    return start(comments.writeStream.foreachBatch(per_batch), checkpoint, trigger)
