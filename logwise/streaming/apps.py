"""The two applications started as Structured Streaming jobs.

``start_log_analysis`` watches a folder of log files and writes error records,
incomplete lines, counts per level and sliding counts per level;
``start_comment_word_counts`` runs the comment word count over any comment
stream. Restarting with the same checkpoint folder continues from the stored
offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logwise.operators.enrich import Fetch
from logwise.settings import COMMENT_BATCH, LOG_BATCH, LOG_SLIDE, LOG_WINDOW
from logwise.sources.dictionary import RefreshingDictionary
from logwise.sources.logs import log_lines
from logwise.streaming.comments import comment_counts_query
from logwise.streaming.logs import log_analysis_query


def start_log_analysis(
    spark: SparkSession,
    logs_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    trigger: str | None = LOG_BATCH,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    max_file_age: str | None = None,
) -> StreamingQuery:
    """Start the log application; ``trigger=None`` drains what is there and
    stops. One query lists, reads and parses the folder for all outputs. With
    ``archive_dir`` files that were read are moved there."""
    lines = log_lines(
        spark, logs_dir, stream=True, glob=glob, max_files_per_trigger=max_files_per_trigger,
        archive=archive_dir, max_file_age=max_file_age,
    )
    return log_analysis_query(lines, out_dir, f"{checkpoint_dir}/logs", LOG_WINDOW, LOG_SLIDE, trigger=trigger)


def start_comment_word_counts(
    comments: DataFrame,
    dictionary: RefreshingDictionary,
    ledger_dir: str,
    checkpoint_dir: str,
    trigger: str | None = COMMENT_BATCH,
    method: str = "spaces",
    time_col: str | None = "timestamp",
    fetch: Fetch | None = None,
    error_dir: str | None = None,
) -> StreamingQuery:
    """Start the comment word count; read totals with ``sinks.monthly_totals``.

    With ``fetch``, comments are sent to a segmentation service and its terms
    are counted; comments that got no valid answer go to ``error_dir``.
    """
    return comment_counts_query(
        comments, dictionary, ledger_dir, checkpoint_dir, method=method, time_col=time_col, trigger=trigger,
        fetch=fetch, error_path=error_dir,
    )
