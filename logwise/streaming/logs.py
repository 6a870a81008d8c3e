"""Log analysis as Structured Streaming queries.

:func:`log_analysis_query` writes all outputs of the log application from one
scan; the other queries write one of them each. Counts that add up are written
per batch and summed by their readers, so they need no state and lose no late
line; running totals can also be kept in the state store. Every sink writes
one partition per batch id, so a replay after a failure replaces what the
failed attempt wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logwise.operators.counts import count_by, total_snapshots
from logwise.operators.filters import ERROR_LEVEL, filter_levels, sql_over_batch
from logwise.operators.parse import parse_log_lines, quarantine, timed_levels
from logwise.operators.panes import pane_counts, pane_length, windows_of_panes
from logwise.operators.windows import sliding_counts
from logwise.sinks.fold import Ledger, totals
from logwise.sinks.tables import append_batch, read_batches
from logwise.sources.storage import put_mark, take_back_marks
from logwise.streaming.runner import start

RECORD_OUT = ("log_level", "method", "content", "event_ts")


def error_log_query(
    lines: DataFrame,
    out_path: str,
    checkpoint: str,
    levels: Sequence[str] = (ERROR_LEVEL,),
    sql: str | None = None,
    quarantine_path: str | None = None,
    trigger: str | None = None,
    sink: str = "batches",
) -> StreamingQuery:
    """Parse each batch of ``value`` lines, keep the given levels, append.

    ``sql`` (optional) runs over the records, named ``batch_rows``, instead of
    the level filter, e.g. ``select * from batch_rows where
    log_level='[error]'``. Incomplete lines go to ``quarantine_path``.

    ``sink='batches'`` writes one partition per batch id from
    ``foreachBatch`` (a replay replaces its partition; needed for the
    quarantine, a second output of the same batch). ``sink='files'`` uses
    Spark's parquet file sink: exactly-once through its own commit log and no
    directory per micro-batch, the better choice for a stream that runs for
    months; read it with ``spark.read.parquet(out_path)``.
    """
    parsed = parse_log_lines(lines).observe(
        "log_lines",
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(F.col("n_fields") < 3, 1).otherwise(0)).alias("quarantined"),
    )
    if sink == "files":
        if quarantine_path:
            raise ValueError("quarantine_path needs sink='batches'")
        records = quarantine(parsed)[0].select(*RECORD_OUT)
        kept = sql_over_batch(records, sql) if sql else filter_levels(records, levels)
        writer = kept.writeStream.format("parquet").option("path", out_path).outputMode("append")
        return start(writer, checkpoint, trigger)
    if sink != "batches":
        raise ValueError(f"unknown sink {sink!r}")

    def per_batch(df: DataFrame, batch_id: int) -> None:
        # two sinks read the same batch: parse it once
        shared = df.persist() if quarantine_path else df
        try:
            good, bad = quarantine(shared)
            records = good.select(*RECORD_OUT)
            if sql:
                kept = sql_over_batch(records, sql)
            else:
                kept = filter_levels(records, levels)
            append_batch(kept, out_path, batch_id)
            if quarantine_path:
                append_batch(bad.select("value"), quarantine_path, batch_id)
        finally:
            if shared is not df:
                shared.unpersist()

    return start(parsed.writeStream.foreachBatch(per_batch), checkpoint, trigger)


def level_totals_query(
    stream: DataFrame,
    key: str,
    out_path: str,
    checkpoint: str,
    mode: str = "complete",
    trigger: str | None = None,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Running ``count(*)`` per key, never evicted.

    ``complete`` writes every known key after every batch (the snapshot series
    of a running count, also for keys without new rows); ``update`` writes only
    the keys a batch changed, for large key sets. Read the current totals with
    :func:`logwise.streaming.runner.latest_per_key`.
    """
    if mode not in ("complete", "update"):
        raise ValueError(f"unknown mode {mode!r}")
    counts = count_by(stream, key, name="n")
    writer = counts.writeStream.outputMode(mode).foreachBatch(
        lambda df, batch_id: append_batch(df, out_path, batch_id)
    )
    return start(
        writer, checkpoint, trigger, spark=stream.sparkSession,
        state_partitions=state_partitions, state_store=state_store,
    )


def sliding_counts_query(
    stream: DataFrame,
    key: str,
    out_path: str,
    checkpoint: str,
    length: str,
    slide: str,
    time_col: str | None = "event_ts",
    watermark: str | None = None,
    trigger: str | None = None,
    sink: str = "contributions",
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Counts per (window, key).

    ``sink='contributions'``: window counts are additive, so every batch
    writes the counts of its own rows as a partition and
    :func:`window_totals` sums them. There is no state and no watermark: a
    line counts in its window however late it comes, and a replayed batch
    replaces its partition.

    ``time_col=None`` uses arrival time (the batch time, which the offset log
    keeps for replays) instead of event time; so do rows whose time is NULL.

    The stateful forms drop rows older than ``watermark``, which must be given
    for them: ``sink='updates'`` writes the windows a batch changed (read with
    ``latest_per_key``); ``sink='files'`` writes each window once to Spark's
    parquet file sink when the watermark has passed its end.
    """
    if time_col is None:
        stream = stream.withColumn("_arrival", F.current_timestamp())
        time_col = "_arrival"
        watermark = watermark or "0 seconds"
    else:
        # rows without a time count at the time of their batch
        at = F.coalesce(F.col(time_col).cast("timestamp"), F.current_timestamp())
        stream = stream.withColumn(time_col, at)
    if sink == "contributions":

        def per_batch(df: DataFrame, batch_id: int) -> None:
            append_batch(sliding_counts(df, time_col, key, length, slide), out_path, batch_id)

        return start(stream.select(time_col, key).writeStream.foreachBatch(per_batch), checkpoint, trigger)
    if sink not in ("updates", "files"):
        raise ValueError(f"unknown sink {sink!r}")
    if watermark is None:
        raise ValueError(f"sink={sink!r} drops late rows; give its watermark")
    counts = sliding_counts(stream.withWatermark(time_col, watermark), time_col, key, length, slide)
    spark = stream.sparkSession
    if sink == "files":
        writer = counts.writeStream.format("parquet").option("path", out_path).outputMode("append")
    else:
        writer = counts.writeStream.outputMode("update").foreachBatch(
            lambda df, batch_id: append_batch(df, out_path, batch_id)
        )
    return start(
        writer, checkpoint, trigger, spark=spark, state_partitions=state_partitions, state_store=state_store
    )


def window_ledger(path: str, key: str, name: str = "n") -> Ledger:
    """The windows of a ``contributions`` sink as an additive ledger, folded by
    the day (UTC) a window starts on: new batches rewrite recent days only."""
    schema = f"ws timestamp, we timestamp, `{key}` string, `{name}` bigint, batch_id bigint"
    return Ledger(path, schema, ("ws", "we", key), name, "cast(floor(unix_seconds(ws) / 86400) as string)")


def window_totals(
    spark: SparkSession, path: str, key: str, name: str = "n", folded_path: str | None = None
) -> DataFrame:
    """(ws, we, key, n): the windows of a ``contributions`` sink, all batches;
    those folded by :func:`logwise.sinks.fold.fold` from ``folded_path``."""
    return totals(spark, window_ledger(path, key, name), folded_path)


def pane_counts_query(
    stream: DataFrame,
    key: str,
    out_path: str,
    checkpoint: str,
    windows: Sequence[tuple[str, str]],
    time_col: str = "event_ts",
    trigger: str | None = None,
) -> StreamingQuery:
    """Counts per (pane, key) for all the (length, slide) forms in ``windows``.

    Every batch writes the panes of its own rows, so there is no state and no
    late row is dropped; :func:`pane_window_totals` sums any of the forms from
    them. A row is in one pane, whatever the windows: unlike
    :func:`sliding_counts_query` it is not repeated length / slide times, and
    one table serves several forms. Rows without a time count at the time of
    their batch.
    """
    pane = pane_length(stream.sparkSession, windows)
    at = F.coalesce(F.col(time_col).cast("timestamp"), F.current_timestamp())
    rows = stream.select(F.col(key), at.alias("_at"))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        append_batch(pane_counts(df, "_at", key, pane), out_path, batch_id)

    return start(rows.writeStream.foreachBatch(per_batch), checkpoint, trigger)


def pane_ledger(path: str, key: str) -> Ledger:
    """The panes of :func:`pane_counts_query` as an additive ledger, folded by
    the day (UTC) a pane starts on."""
    schema = f"ps timestamp, pe timestamp, `{key}` string, n bigint, batch_id bigint"
    return Ledger(path, schema, ("ps", "pe", key), "n", "cast(floor(unix_seconds(ps) / 86400) as string)")


def pane_window_totals(
    spark: SparkSession, path: str, key: str, length: str, slide: str, folded_path: str | None = None
) -> DataFrame:
    """(ws, we, key, n): windows of one form over all batches of panes; those
    folded by :func:`logwise.sinks.fold.fold` from ``folded_path``."""
    return windows_of_panes(totals(spark, pane_ledger(path, key), folded_path), key, length, slide)


LEVEL_ROWS = "log_level string, n bigint, batch_id bigint"


def level_ledger(path: str) -> Ledger:
    """The level counts of :func:`log_analysis_query` as an additive ledger."""
    return Ledger(path, LEVEL_ROWS, ("log_level",), "n")


def level_totals(
    spark: SparkSession, path: str, through: int | None = None, folded_path: str | None = None
) -> DataFrame:
    """(log_level, n) over the batches of :func:`log_analysis_query`; with
    ``through`` up to that batch, which needs the batches themselves."""
    if through is None:
        return totals(spark, level_ledger(path), folded_path)
    rows = read_batches(spark, path, LEVEL_ROWS).where(F.col("batch_id") <= through)
    return rows.groupBy("log_level").agg(F.sum("n").alias("n"))


def level_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, log_level, n): the running count of every level after each
    batch of :func:`log_analysis_query`."""
    return total_snapshots(read_batches(spark, path, LEVEL_ROWS), "log_level", "batch_id", "n", weight="n")


def log_analysis_query(
    lines: DataFrame,
    out_dir: str,
    checkpoint: str,
    length: str,
    slide: str,
    levels: Sequence[str] = (ERROR_LEVEL,),
    sql: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """All outputs of the log application from one scan of the lines.

    Each batch is parsed once and kept while four partitions are written:
    ``errors`` (complete records of the given levels, or of ``sql`` over
    ``batch_rows``), ``quarantine`` (incomplete lines), ``levels`` (counts of
    every line's level) and ``windows`` (sliding counts of every line). The
    counts are contributions per batch, so a replay replaces them; read them
    with :func:`level_totals`, :func:`level_snapshots`, :func:`window_totals`
    and the rows with :func:`logwise.sinks.read_batches`. A mark below
    ``out_dir`` is set after the last of the four, and all these readers stop
    at it: they see all outputs of a batch or none.
    """
    spark = lines.sparkSession
    parsed = parse_log_lines(lines).observe(
        "log_lines",
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(F.col("n_fields") < 3, 1).otherwise(0)).alias("quarantined"),
    )

    def per_batch(df: DataFrame, batch_id: int) -> None:
        shared = df.persist()
        try:
            take_back_marks(spark, out_dir, "batch_id", batch_id)
            good, bad = quarantine(shared)
            records = good.select(*RECORD_OUT)
            kept = sql_over_batch(records, sql) if sql else filter_levels(records, levels)
            append_batch(kept, f"{out_dir}/errors", batch_id)
            append_batch(bad.select("value"), f"{out_dir}/quarantine", batch_id)
            timed = timed_levels(shared)
            append_batch(count_by(timed, "log_level"), f"{out_dir}/levels", batch_id)
            windows = sliding_counts(timed, "event_ts", "log_level", length, slide)
            append_batch(windows, f"{out_dir}/windows", batch_id)
            put_mark(spark, out_dir, "batch_id", batch_id)
        finally:
            shared.unpersist()

    return start(parsed.writeStream.foreachBatch(per_batch), checkpoint, trigger)
