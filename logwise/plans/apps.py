"""The two applications as batch plans over DataFrames.

The streaming forms in :mod:`logwise.streaming` run the same operators per
micro-batch; these batch forms replay a whole history at once and are what
the correctness checks compare.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwise.operators.counts import count_by
from logwise.operators.filters import ERROR_LEVEL, filter_levels, non_empty
from logwise.operators.parse import line_levels, parse_log_lines, quarantine, timed_levels
from logwise.operators.windows import sliding_counts
from logwise.operators.words import Dictionary, word_document_counts

from logwise.settings import LOG_BATCH, LOG_SLIDE, LOG_WINDOW  # noqa: F401


@dataclass
class LogAnalysis:
    records: DataFrame  # complete records (log_level, method, content, event_ts)
    errors: DataFrame  # records of the kept levels
    quarantined: DataFrame  # lines with fewer than three fields
    totals: DataFrame  # (log_level, n) over all lines, incomplete ones included
    windows: DataFrame  # (ws, we, log_level, n) sliding counts over all lines by event time


def log_analysis(
    lines: DataFrame,
    levels: Sequence[str] = (ERROR_LEVEL,),
    length: str = LOG_WINDOW,
    slide: str = LOG_SLIDE,
) -> LogAnalysis:
    """All outputs of the log application from a frame of ``value`` lines.

    Windows hold every line; one without a readable date counts at the time
    of its file (column ``file_time``), or now if the frame has none.
    """
    parsed = parse_log_lines(lines)
    good, bad = quarantine(parsed)
    records = good.select("log_level", "method", "content", "event_ts")
    return LogAnalysis(
        records=records,
        errors=filter_levels(records, levels),
        quarantined=bad.select("value"),
        totals=count_by(line_levels(lines), "log_level"),
        windows=sliding_counts(timed_levels(parsed), "event_ts", "log_level", length, slide),
    )


def comment_word_counts(
    comments: DataFrame,
    dictionary: Dictionary,
    method: str = "spaces",
    text: str = "value",
    date: str | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``(word, by..., [date,] count)``: comments containing each dictionary word."""
    docs = non_empty(comments, text)
    if date is not None:
        docs = docs.withColumn("date", F.to_date(F.col(date)))
        by = (*by, "date")
    return word_document_counts(docs, dictionary, text=text, method=method, name="count", by=by)
